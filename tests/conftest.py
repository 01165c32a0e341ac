import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from matchlake.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(base / "warehouse"),
        "spark.checkpoint.dir": str(base / "scratch"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted plain tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def put_json(tmp_path):
    """Write documents into a file below the test's folder and return its path."""
    def put(name, *documents, indent=None, raw=None):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        text = raw if raw is not None else "\n".join(json.dumps(d, indent=indent) for d in documents)
        path.write_text(text, encoding="utf-8")
        return str(path)
    return put
