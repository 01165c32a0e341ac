import pytest
import xxhash

from matchlake.llm import sharding


def test_one_more_shard_takes_rows_only_into_itself(spark, docs, corpus):
    rows = sharding.assign_shards(docs(corpus), [1.0] * 24, [1.0] * 25).collect()
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert moved and all(r.grown_shard == 24 for r in moved)
    assert {r.lang for r in rows} == {"en"} and len(rows) == len(corpus)


def test_slots_are_gapless(spark, docs, corpus, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_BUCKETS", 5)
    rows = sharding.assign_shards(docs(corpus + corpus[:30]), [1.0] * 4).collect()
    for shard in range(4):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard is None for r in rows)


def test_shares_follow_the_weights(spark):
    many = spark.range(20_000).selectExpr("id as doc_id", "'' as text")
    counts = {r.shard: r["count"] for r in sharding.assign_shards(many, [1.0, 0.0, 3.0]).groupBy("shard").count().collect()}
    assert set(counts) == {0, 2} and 2.7 < counts[2] / counts[0] < 3.3


def test_a_heavier_shard_only_gains(spark):
    many = spark.range(5_000).selectExpr("id as doc_id", "'' as text")
    rows = sharding.assign_shards(many, [1.0, 1.0, 1.0], [1.0, 2.0, 1.0]).collect()
    assert all(r.shard == r.grown_shard or r.grown_shard == 1 for r in rows)


def test_the_draw_is_stable(spark):
    """The shard of a key is that of a separate implementation, so it never changes between versions."""
    import math

    def shard(key):
        def draw(k):
            first = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
            h = xxhash.xxh64_intdigest(k.to_bytes(4, "little"), first)
            return -math.log(((h >> 12) + 0.5) / 2**52)
        return min(range(24), key=draw)
    keys = [0, 1, -5, 2**40, 123456789]
    table = spark.createDataFrame([(k, "") for k in keys], "doc_id long, text string")
    got = {r.doc_id: r.shard for r in sharding.assign_shards(table, [1.0] * 24).collect()}
    assert got == {k: shard(k) for k in keys}


def test_nulls_repeats_and_empty_table(spark, docs):
    rows = sharding.assign_shards(docs([(None, None), (None, "x"), (3, ""), (3, ""), (3, None)]), [1.0, 1.0]).collect()
    assert len({r.shard for r in rows if r.doc_id is None}) == 1 and len({r.shard for r in rows if r.doc_id == 3}) == 1
    assert len({(r.shard, r.slot) for r in rows}) == 5
    assert sharding.assign_shards(docs([]), [1.0, 1.0]).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(docs([]), [0.0])


def test_query_against_brute_force(spark):
    import zlib

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = sharding.op5_sharding(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
