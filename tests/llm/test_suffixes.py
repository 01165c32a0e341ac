import random
from collections import defaultdict

import pytest

from matchlake.llm import suffixes
from matchlake.llm.suffixes import Matching, drop_repeats


def by_hand(pairs, length):
    """Rows of one doc_id are one document; a string is earlier by (doc_id, start)."""
    low = lambda i: float("-inf") if i is None else i
    first = defaultdict(lambda: (float("inf"), 0))
    data = [(i, (t or "").encode()) for i, t in pairs]
    for i, b in data:
        for p in range(len(b) - length + 1):
            first[b[p : p + length]] = min(first[b[p : p + length]], (low(i), p))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < (low(i), p):
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, kept, len(b), len(b) - len(kept), runs))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in df.collect()), key=repr)


def passages(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 7)))
    shared = [" ".join(word() for _ in range(rng.randint(10, 60))) for _ in range(6)]
    pairs = []
    for k in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.5:
                passage = rng.choice(shared)
                a = rng.randint(0, len(passage) // 2)
                parts.append(passage[a : a + rng.randint(20, 400)])
            else:
                parts.append(" ".join(word() for _ in range(rng.randint(1, 40))))
        pairs.append((k, " ".join(parts)))
    return pairs


EDGE = [
    (1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 101), (6, "ab" * 300), (None, "y" * 150), (None, "y" * 150), (7, "y" * 120),
    (8, "q" + "y" * 110), (8, "qq" + "y" * 110), (9, "é" * 80), (10, "é" * 80), (10, "é" * 80), (11, "w" * 3000),
]


@pytest.mark.parametrize("matching", [
    Matching(), Matching(held_bytes=200), Matching(common_in_batch=1), Matching(common_in_slice=1), Matching(held_bytes=500, common_in_batch=2, common_in_slice=3),
    Matching(length=40), Matching(length=32),
])
def test_against_all_strings(spark, docs, matching, monkeypatch):
    monkeypatch.setattr(suffixes.ragged, "CHUNK_BYTES", 1500)
    pairs = EDGE + [(i + 100, t) for i, t in passages(4, 60)]
    assert result(drop_repeats(docs(pairs), matching)) == by_hand(pairs, matching.length)


def test_corpus(spark, docs, corpus):
    assert result(drop_repeats(docs(corpus[:120]))) == by_hand(corpus[:120], 100)


def test_copies(spark, docs):
    text = " ".join(f"word{k}" for k in range(60))
    pairs = [(k, text) for k in range(40)]
    rows = {r.doc_id: r for r in drop_repeats(docs(pairs), Matching(held_bytes=1000)).collect()}
    assert rows[0].n_removed == 0 and all(rows[k].n_removed == len(text) and rows[k].n_spans == 1 for k in range(1, 40))


def test_columns_and_empty_table(spark, docs):
    row = drop_repeats(docs([(1, "a")])).first()
    assert (row.text, row._text, row.shard, bytes(row.kept)) == ("a", "x", "b", b"a")
    assert drop_repeats(docs([])).collect() == []


def test_levels_grow_geometrically():
    import numpy as np

    rng = np.random.default_rng(1)
    family = suffixes.Family()
    for k in range(64):
        n = 10
        columns = {c: rng.integers(0, 2**15, n).astype(t) for c, t in zip(suffixes.NAMES, suffixes.TYPES, strict=True)}
        columns["doc"] = np.full(n, k)
        family.add(suffixes.Suffixes(columns).ordered())
        sizes = [len(level) for level in family.levels]
        assert all(a > 2 * b for a, b in zip(sizes[:-1], sizes[1:], strict=True))
    assert len(family.levels) <= 7 and sum(map(len, family.levels)) == 640
