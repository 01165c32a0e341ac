"""Cross-tokenizer alignment against a brute force over whole texts, with pieces cut small."""

import hashlib
from collections import Counter

import pytest

from matchlake.llm import alignment
from matchlake.llm.alignment import SAFE_CUT, Words, align, compose, cut, vocabularies, words


@pytest.fixture(scope="module")
def paths(tokenizer):
    return tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")


def brute(rows, a_path, b_path):
    """Per row: the contract's columns from whole-text encodings, links counted over all rows."""
    vocab = vocabularies(a_path, b_path)
    per_row = []
    for doc, text in rows:
        if not text:
            per_row.append((doc, None))
            continue
        whole = " " + text
        a = vocab.a.encode(whole, add_special_tokens=False).ids
        b = vocab.b.encode(text)
        raw = whole.encode()
        if b"".join(vocab.a_bytes[i] for i in a) != raw or b"".join(vocab.b_bytes[i] for i in b) != raw:
            per_row.append((doc, None))
            continue
        a_end, b_end, pos = [], [], 0
        for i in a:
            pos += len(vocab.a_bytes[i]); a_end.append(pos)
        pos = 0
        for i in b:
            pos += len(vocab.b_bytes[i]); b_end.append(pos)
        common = sorted(set(a_end) & set(b_end))
        groups, links, i, j = [], [], 0, 0
        for e in common:
            ga, gb = [], []
            while i < len(a) and a_end[i] <= e:
                ga.append(a[i]); i += 1
            while j < len(b) and b_end[j] <= e:
                gb.append(b[j]); j += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            links.append((ga[-1], gb[-1]))
        per_row.append((doc, (len(a), len(b), len(groups), links, ";".join(groups))))
    counts = Counter(link for _, r in per_row if r for link in r[3])
    top = Counter()
    for (x, y), c in counts.items():
        top[y] = max(top[y], c)
    out = []
    for doc, r in per_row:
        if r is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, text = r
        out.append((doc, n_a, n_b, n_groups, len(links), sum(counts[k] == top[k[1]] for k in links),
                    sum(counts[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


TEXTS = [
    (1, "Hello world, this is a test of two vocabularies."),
    (2, "Hello world, this is a test of two vocabularies."),  # repeated text
    (2, "Hello world, this is a test of two vocabularies."),  # repeated row
    (None, "Null ids are rows of their own <|endoftext|> <s> too."),
    (3, None),
    (4, ""),
    (5, "  leading spaces and\ttabs\nand lines"),
    (6, "Ünïcödé wörds ünd 日本語のテキスト, numbers 12345 and symbols #$%."),
    (7, " ".join(f"word{i % 37}" for i in range(3000))),  # long: many pieces at a small size
]


def test_against_brute_force(spark, paths, rows):
    a_path, b_path = paths
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in TEXTS], "doc_id long, text string, _key string, _piece long")
    got = rows(align(docs, a_path, b_path, piece_chars=50))
    assert got == brute(TEXTS, a_path, b_path)


def test_pieces_compose_to_the_whole(paths):
    vocab = vocabularies(*paths)
    from matchlake.llm.alignment import fragment

    text = TEXTS[6][1] + " " + TEXTS[8][1][:2000]
    whole = cut(text, 1 << 30)
    assert whole == [" " + text]
    small = cut(text, 40)
    assert "".join(small) == " " + text and len(small) > 20
    frags = []
    for piece, (a, b, ok) in zip(small, vocab.encode(small)):
        frags.append({"_ok": ok} | fragment(vocab, a, b))
    left = frags[0]
    for f in frags[1:]:
        left = compose(left, f)
    (a, b, ok), = vocab.encode(whole)
    expect = {"_ok": ok} | fragment(vocab, a, b)
    # tree order: ((f0 f1) (f2 f3)) ... equals the left fold
    level = frags
    while len(level) > 1:
        level = [compose(level[i], level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    for got in (left, level[0]):
        assert {k: got[k] for k in ("_na", "_nb", "_ngroups", "_groups", "_pre_a", "_pre_b", "_ok")} == {
            k: expect[k] for k in ("_na", "_nb", "_ngroups", "_groups", "_pre_a", "_pre_b", "_ok")}


def test_empty_table(spark, paths):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align(docs, *paths).count() == 0


def test_stored_pieces_are_small(spark, paths):
    """A text of one piece is stored as a digest and its distinct links: no text of groups, no link twice."""
    docs = spark.createDataFrame([(0, 1, "to be or not to be " * 2000), (1, 2, None)], "_key long, _doc long, _text string")
    row, none = alignment.fragments(docs, *paths).orderBy("_key").collect()
    assert len(row._sha) == 64 and row._groups == row._pre_a == row._pre_b == ""
    assert len(set(zip(row._la, row._lb))) == len(row._la) < 10 and sum(row._lk) == row._ngroups + 1 > 10_000
    assert not none._ok and none._la == []


def test_shares_of_documents_and_pairs(spark, paths, rows, monkeypatch):
    monkeypatch.setattr(alignment, "SHARE_LINKS", 20)
    monkeypatch.setattr(alignment, "SHARE_PAIRS", 10)
    monkeypatch.setattr(alignment, "FANOUT", 4)
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    for piece_chars in (50, 1 << 18):
        assert rows(align(docs, *paths, piece_chars=piece_chars)) == brute(TEXTS, *paths)


def test_words_beside_white_space_and_forgotten_words(paths, monkeypatch):
    texts = [t for _, t in TEXTS if t] + [" a", "a ", "a  b", "a\n b", "a \tb c", "\u3000a b", "a\x85 b", "e\u0301 x \ufb01 y", "x" * 70_000 + " y", " ", "<s> </s> x"]
    for text in texts:
        assert words(text) == SAFE_CUT.split(text)
    vocab = vocabularies(*paths)
    monkeypatch.setattr(alignment, "REMEMBERED", 20)
    known = Words(vocab)
    for text in texts:
        known.learn(words(text))
        which = [known.number[w] for w in words(text)]
        (a, b, ok), = vocab.encode([" " + text])
        assert ok == all(known.counts[w][2] >= 0 for w in which), text
        if ok:
            whole = alignment.fragment(vocab, a, b)
            assert known.counts[which].sum(axis=0).tolist() == [len(a), len(b), whole["_ngroups"] + 1]
            assert ";".join(known.text[w] for w in which) == ";".join(
                x for x in (f"{whole['_pre_a']}|{whole['_pre_b']}", whole["_groups"]) if x)
