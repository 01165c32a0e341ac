"""The library without its corpus subpackage: the entry module and the other queries stay."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_imports_without_the_corpus_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    shutil.rmtree(copy / "matchlake" / "llm")
    shutil.rmtree(copy / "tests" / "llm")
    kept_pipeline = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"],
        cwd=copy, capture_output=True, text=True, timeout=300,
    )
    assert kept_pipeline.returncode == 0, kept_pipeline.stderr
    (copy / "corpus_pipeline.py").unlink()
    done = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e, bench; q = e.queries(); "
         "print(len(q), any(k.startswith('op') or k == 'pipeline' for k in q))"],
        cwd=copy, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr
    count, corpus = done.stdout.split()
    assert corpus == "False"
    from parity import registry

    assert int(count) == len(registry.QUERIES)
    assert kept_pipeline.stdout.split() == [count, "False"]
