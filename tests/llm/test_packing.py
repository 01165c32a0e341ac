import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from matchlake.llm import packing
from matchlake.llm.packing import Packing, best_cuts, pack_documents
from matchlake.llm.token_counts import library


def cost(position, penalty, chosen, limit):
    total = 0.0
    for i, j in zip(chosen[:-1], chosen[1:], strict=True):
        total += limit - (position[j] - position[i]) + penalty[j]
    return total


def least(position, penalty, limit):
    f = [0.0] + [float("inf")] * (len(position) - 1)
    for j in range(1, len(position)):
        for i in range(j):
            if position[j] - position[i] <= limit:
                f[j] = min(f[j], f[i] + limit - (position[j] - position[i]) + penalty[j])
    return f[-1]


def test_cuts_cost_the_least():
    rng = random.Random(3)
    for _ in range(200):
        n, limit = rng.randint(2, 30), rng.randint(6, 25)
        position = np.cumsum([0] + [rng.randint(1, 6) for _ in range(n)])
        penalty = np.array([0.0] + [rng.choice([0.0, 3.0, 9.0]) for _ in range(n)])
        cuts = best_cuts(position, penalty, limit)
        chosen = [int(np.searchsorted(position, c)) for c in cuts]
        assert cuts[0] == 0 and cuts[-1] == position[-1]
        assert cost(position, penalty, chosen, limit) == pytest.approx(least(position, penalty, limit))


def check(rows, pairs, path, limit, with_ids=True):
    tokens = defaultdict(list)
    for i, t in pairs:
        tokens[i].append([*library(path).encode(t or "", add_special_tokens=False).ids, 2])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(tokens)
    for i, own in pieces.items():
        rest = [list(t) for t in tokens[i]]
        assert sum(r.length for r in own) == sum(map(len, rest))
        for r in own:
            assert any(
                len(t) == r.doc_tokens and zlib.crc32(np.array(t[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
                and (not with_ids or t[r.start : r.start + r.length] == r.ids) for t in rest
            )
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limit
    return sequences


def test_corpus(spark, docs, corpus, tokenizer):
    path = tokenizer("word_bpe_49k.json")
    rows = pack_documents(docs(corpus), path).collect()
    sequences = check(rows, corpus, path, 4096)
    full = sum(r.length for r in rows)
    assert full / (4096 * len(sequences)) > 0.9


def test_small_windows_and_carried_ends(spark, docs, corpus, tokenizer):
    path = tokenizer("word_bpe_49k.json")
    p = Packing(limit=64, held_tokens=500, stretch=16)
    rows = pack_documents(docs(corpus).coalesce(1), path, p).collect()
    sequences = check(rows, corpus, path, 64)
    assert sum(r.length for r in rows) / (64 * len(sequences)) > 0.75


def test_order_is_kept(spark, docs, corpus, tokenizer):
    path = tokenizer("word_bpe_49k.json")
    rows = pack_documents(docs(corpus).coalesce(1), path, with_ids=False).collect()
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset))]
    assert list(dict.fromkeys(order)) == [i for i, _ in corpus]


def test_edge_cases(spark, docs, tokenizer):
    path = tokenizer("word_bpe_49k.json")
    pairs = [(None, None), (1, ""), (1, ""), (2, "no sentence end " * 9000), (3, "A b. C d! " * 10), (3, "other")]
    check(pack_documents(docs(pairs), path).collect(), pairs, path, 4096)
    assert pack_documents(docs([]), path).collect() == []


def test_query(spark, tokenizer, corpus):
    rows = packing.op2_packing(spark, "/root/testdata/sf0.001").collect()
    check(rows, corpus, tokenizer("word_bpe_49k.json"), 4096, with_ids=False)
