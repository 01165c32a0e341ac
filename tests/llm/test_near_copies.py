import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from matchlake.llm import near_copies as nc
from tests.llm.conftest import word_list


def shingles(text):
    words = word_list(text)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def by_hand(pairs, threshold=Fraction(4, 5)):
    sets = [shingles(t) for _, t in pairs]
    root, links = list(range(len(pairs))), [0] * len(pairs)
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)

    def top(k):
        while root[k] != k:
            k = root[k]
        return k
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j > i)
        for j, n in shared.items():
            if n >= threshold * (len(s) + len(sets[j]) - n):
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(pairs):
        ids[top(k)].append(i)
    least = {r: min((i for i in own if i is not None), default=None) for r, own in ids.items()}
    return Counter((i, least[top(k)], links[k]) for k, (i, _) in enumerate(pairs))


def result(df):
    return Counter((r.doc_id, r.class_id, r.n_links) for r in df.collect())


def variants(seed, families, each):
    rng, pairs = random.Random(seed), []
    for _ in range(families):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(40, 160))]
        for _ in range(each):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = f"w{rng.randint(0, 5000)}"
            pairs.append((len(pairs), " ".join(own)))
    return pairs


EDGE = [
    (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "a  b"), (6, "b a"), (7, "a b c d e"), (None, "a b c d e"), (8, "a b c d e"), (8, "a b c d e"),
    (9, "x " * 30_000), (8, "other text that shares the id of two rows"), (None, None), (10, "x x x x x"),
]


def test_edge_cases(spark, docs):
    assert result(nc.near_copies(docs(EDGE))) == by_hand(EDGE)
    assert nc.near_copies(docs([])).collect() == []


def test_families(spark, docs):
    pairs = variants(1, 25, 12)
    assert result(nc.near_copies(docs(pairs))) == by_hand(pairs)


def test_a_cluster_of_many_blocks(spark, docs):
    pairs = variants(2, 2, 60)
    got = result(nc.near_copies(docs(pairs), nc.Join(block_shingles=900)))
    assert got == by_hand(pairs)


def test_few_long_texts_leave_blocks_empty(spark, docs):
    for seed in range(3):
        pairs = variants(seed + 10, 2, 2) + variants(seed + 20, 1, 3)
        got = result(nc.near_copies(docs(pairs), nc.Join(block_shingles=30)))
        assert got == by_hand(pairs)


def test_corpus(spark, docs, corpus):
    assert result(nc.near_copies(docs(corpus))) == by_hand(corpus)


def test_keep_one(spark, docs, corpus):
    pairs = variants(3, 8, 5) + [(i + 1000 if i is not None else None, t) for i, t in EDGE]
    table = docs(pairs)
    kept = nc.keep_one(table)
    assert kept.columns == table.columns
    texts = {shingles(t) for _, t in pairs}
    classes = {c for _, c, _ in by_hand(pairs)}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == classes
    # the row that shares an id with another class's document may be the smaller version of it
    assert len(rows) == len(classes) and {shingles(r.text) for r in rows} <= texts


def test_keep_one_by_class_not_by_id(spark, docs):
    """Unlike texts under a null or repeated id all stay, one of each class; texts without words all stay."""
    unlike = [" ".join(f"t{k}w{n}" for n in range(30)) for k in range(6)]
    pairs = [(None, t) for t in unlike[:3]] + [(None, unlike[0]), (5, unlike[3]), (5, unlike[4]), (5, unlike[5]), (6, unlike[5])]
    pairs += [(None, None), (None, ""), (7, ""), (7, "")]
    kept = Counter((r.doc_id, r.text) for r in nc.keep_one(docs(pairs)).collect())
    want = [(None, t) for t in unlike[:3]] + [(5, t) for t in unlike[3:]] + [(None, None), (None, ""), (7, ""), (7, "")]
    assert kept == Counter(want)


def test_pruning_keeps_what_reaches_the_threshold():
    """The posterior bound by numbers, and no loss among pairs near the threshold."""
    join = nc.Join()
    least = nc.least_matches(join)
    assert all(a <= b for a, b in zip(least[:-1], least[1:], strict=True)) and least[-1] > 64
    rng = np.random.default_rng(5)
    lost = 0
    for _ in range(60):
        shared, own = rng.integers(0, 2**63, 400, dtype=np.uint64), rng.integers(0, 2**63, (2, 48), dtype=np.uint64)
        sets = [np.sort(np.r_[shared, o]) for o in own]
        found = dict(nc.linked(np.concatenate(sets), np.array([448, 448]), np.zeros(2), join))
        lost += not len(found.get(0, ()))
    assert lost == 0


def test_probability_of_the_bands():
    assert (1 - 0.8 ** nc.Join().band_rows) ** nc.Join().bands < 1e-5
    assert pytest.approx(float(nc.Join().threshold)) == 0.8
