from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from matchlake.llm import decontaminate, fertility  # noqa: E402
from tests.llm import test_line_dedup as lines  # noqa: E402
from tests.llm import test_near_copies as near  # noqa: E402
from tests.llm import test_packing as packing  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tokenizer):
    """Each stage is held against a plain version of it, on what the stage before kept."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    columns = table.columns
    run = {}
    docs = table
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        run[name] = (before, docs)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    assert all(after.columns == columns for name, (_, after) in run.items() if name != "packing")
    pairs = lambda df: [(r.doc_id, r.text) for r in df.collect()]

    before, after = run["quality rules"]
    good = {r.doc_id for r in fertility.rate(before, tokenizer("piece_bpe_32k.model")).collect() if r.kept}
    assert {i for i, _ in pairs(after)} == good

    before, after = run["line dedup"]
    assert sorted(pairs(after)) == sorted((i, t) for i, t, _, _ in lines.by_hand(pairs(before), 40, 5))

    before, after = run["n-gram Jaccard join"]
    assert Counter(i for i, _ in pairs(after)) == Counter({c: 1 for _, c, _ in near.by_hand(pairs(before))})

    before, after = run["benchmark decontamination"]
    bad = {r.doc_id for r in decontaminate.leaks(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert bad and {i for i, _ in pairs(after)} == {i for i, _ in pairs(before)} - bad

    before, after = run["packing"]
    packing.check(after.collect(), pairs(before), tokenizer("word_bpe_49k.json"), 4096, with_ids=False)
    whole = corpus_pipeline.run(spark, SF)
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert {r.doc_id for r in whole.collect()} == {r.doc_id for r in after.collect()}
    assert sum(k is not None for k in map(key, whole.collect())) > 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_edge_rows(spark):
    long = " ".join(f"word{k % 977} of" for k in range(30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, long, None, None, 1), (3, long, "en", "s", 1), (3, long, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.collect()
