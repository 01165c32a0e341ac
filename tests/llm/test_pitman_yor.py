"""Pitman-Yor scoring: base columns against a brute force, a proper predictive distribution, the seat sampler."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import pitman_yor
from matchlake.llm.pitman_yor import END, Model, occurrences, score, tables
from matchlake.llm.seating import ONE_BY_ONE, dump, load, seat

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    (1, "The cat sat on the mat"), (2, "the cat sat on the hat"), (3, "A dog sat on the mat"),
    (4, "the cat ate the rat"), (5, None), (6, ""), (7, "The Cat sat"), (7, "The Cat sat"),
    (None, "no id here"), (10, "the mat sat on the cat"), (11, "ÄÖ upper kept as is"),
]


def tokens(text):
    return WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) + [END]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def test_base_columns_against_brute_force(spark):
    learn = [t for d, x in TEXTS if d is not None and not held(d) for t in tokens(x)]
    counts, total = Counter(learn), len(learn)
    expect = sorted((
        (d, held(d), len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), total,
         round(sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in tokens(x)), 9))
        for d, x in TEXTS
    ), key=str)
    docs = spark.createDataFrame([(d, x, 1, "a") for d, x in TEXTS], "doc_id long, text string, _key long, _w string")
    got = score(docs).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in got), key=str) == expect
    assert all(r.score < 0 for r in got)


def test_predictive_distribution_sums_to_one(spark):
    docs = spark.createDataFrame([(d, x) for d, x in TEXTS if d != 5], "doc_id long, text string")
    occ = occurrences(docs)
    model = Model(occ.where("_train"))
    for number in range(2):
        model.sweep(number)
    vocab = [r._w for r in occ.where("_train").select("_w").distinct().collect()] + ["unseen-word"]
    contexts = ["the cat", "  ", "zzz cat", "qqq qqq"]
    keys = spark.createDataFrame([(c, w) for c in contexts for w in vocab], "_ctx string, _w string")
    keys = keys.withColumn("_id", F.xxhash64("_ctx", "_w"))
    probs = model.predictive(keys).groupBy("_ctx").agg(F.sum("_prob").alias("total"), F.count("*").alias("n"))
    # the unknown word stands for all words outside the vocabulary: one share of the base
    for row in probs.collect():
        assert row.n == len(vocab)
        assert row.total == pytest.approx(1.0, abs=1e-9)


def test_seat_sampler_matches_the_process():
    rng = np.random.default_rng(7)
    customers, others, p, d, theta = 40, 5, 0.2, 0.7, 1.0
    fast = [tables(customers, others, p, d, theta, rng) for _ in range(4000)]
    slow = []
    for _ in range(4000):
        t = 1
        for k in range(1, customers):
            a = (theta + d * (others + t)) * p
            if rng.random() < a / (k - d * t + a):
                t += 1
        slow.append(t)
    assert np.mean(fast) == pytest.approx(np.mean(slow), rel=0.03)
    assert tables(1, 0, 0.5, d, theta, rng) == 1 and tables(0, 0, 0.5, d, theta, rng) == 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert score(docs).count() == 0


def zipf_texts(n_docs, n_words, seed=3):
    rng = np.random.default_rng(seed)
    return [(k, " ".join(f"w{x}" for x in rng.zipf(1.3, n_words) % 5000)) for k in range(n_docs)]


def test_written_tables_stay_near_the_size_of_the_tokens(spark, tmp_path, monkeypatch):
    """Every level of every sweep used to be written and joined as rows of strings."""
    made = iter(range(1000))
    monkeypatch.setattr(pitman_yor, "new_scratch", lambda _spark, label: f"file:{tmp_path}/{label}-{next(made)}")
    docs = spark.createDataFrame(zipf_texts(150, 400), "doc_id long, text string")
    assert score(docs).agg(F.sum("n_tokens")).first()[0] == 150 * 401
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < 25 * 150 * 401


def first_probabilities(pairs, keys):
    """Brute force: every word of a context has one table, as before the first sweep."""
    counts = [Counter(), Counter(), Counter(pairs)]
    for level in (2, 1):
        for ctx, w in counts[level]:
            counts[level - 1][(ctx[1:], w)] += 1
    base = 1 / (len({w for _, w in pairs}) + 1)

    def p(ctx, w):
        level, up = len(ctx), p(ctx[1:], w) if ctx else base
        d, theta = pitman_yor.DISCOUNT[level], pitman_yor.CONCENTRATION[level]
        own = [c for (x, _), c in counts[level].items() if x == ctx]
        c = counts[level][(ctx, w)]
        return (c - d * min(c, 1) + (theta + d * len(own)) * up) / (theta + sum(own))

    return [p(ctx, w) for ctx, w in keys]


@pytest.mark.parametrize("shard_tokens", [2_000_000, 12])
def test_probabilities_over_shards_against_brute_force(spark, monkeypatch, shard_tokens):
    """With 12 tokens a shard, frequent words' restaurants are spread over several shards."""
    monkeypatch.setattr(pitman_yor, "SHARD_TOKENS", shard_tokens)
    pairs = []
    for _, text in TEXTS:
        padded = ["", "", *tokens(text)]
        pairs += [(tuple(padded[k : k + 2]), padded[k + 2]) for k in range(len(padded) - 2)]
    words = sorted({w for _, w in pairs} | {"unseen-word"})
    keys = [((a, b), w) for a, b in [("the", "cat"), ("on", "the"), ("zzz", "the"), ("", ""), ("zzz", "cat"), ("q", "q")] for w in words]
    model = Model(spark.createDataFrame([(" ".join(c), w, 1) for c, w in pairs], "_ctx string, _w string, _k long"))
    asked = spark.createDataFrame([(" ".join(c), w, k) for k, (c, w) in enumerate(keys)], "_ctx string, _w string, _id long")
    got = [r._prob for r in model.predictive(asked).orderBy("_id").collect()]
    assert got == pytest.approx(first_probabilities(pairs, keys), rel=1e-9)
    for number in range(2):
        model.sweep(number)
    sums = Counter()
    for r in model.predictive(asked).collect():
        sums[r._ctx] += r._prob
    assert list(sums.values()) == pytest.approx([1.0] * 6, abs=1e-9)


def test_scores_over_shards_sum_up(spark, monkeypatch):
    docs = spark.createDataFrame([(d, x) for d, x in TEXTS], "doc_id long, text string")
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 9)]
    one = sorted(map(str, score(docs).select(*columns).collect()))
    monkeypatch.setattr(pitman_yor, "SHARD_TOKENS", 10)
    monkeypatch.setattr(pitman_yor, "DEAL_TOKENS", 5)
    layout = pitman_yor.layout_of(pitman_yor.heavy_words(docs, "text"), 3)
    assert layout.shards > 3 and len(layout.hot) and layout.ways.max() > 1
    assert sorted(map(str, score(docs).select(*columns).collect())) == one
    for order in (1, 2, 4):
        got = score(docs, order=order)
        assert sorted(map(str, got.select(*columns).collect())) == one and got.where("score < 0").count() == len(TEXTS)


def test_no_learning_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    got = score(docs).orderBy(F.desc("n_tokens")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]


def test_rows_seated_together_match_the_process():
    rng = np.random.default_rng(7)
    customers = np.array([0, 1, 2, 40, ONE_BY_ONE + 1] * 2000)
    got = seat(customers, np.full(len(customers), 5), np.full(len(customers), 0.2), 0.7, 1.0, rng).reshape(-1, 5)
    assert (got[:, 0] == 0).all() and (got[:, 1] == 1).all() and set(got[:, 2]) == {1, 2}
    for k in (2, 3, 4):
        slow = [tables(int(customers[k]), 5, 0.2, 0.7, 1.0, rng) for _ in range(2000)]
        assert got[:, k].mean() == pytest.approx(np.mean(slow), rel=0.03)


def test_packed_arrays_come_back():
    arrays = [np.array([0, 255, 256, 70_000]), np.zeros(0, dtype=np.int64), np.array([2**64 - 1, 5], dtype=np.uint64), np.array([-0.5, 1e300])]
    for a, b in zip(arrays, load(dump(*arrays)), strict=True):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()
