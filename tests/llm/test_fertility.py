import math
import random
import re
from collections import Counter

import pytest

from matchlake.llm import fertility
from tests.llm.conftest import word_list


def by_hand(text, model):
    text = text or ""
    words = word_list(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if word_list(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    ids = [i for w in words for i in model.encode(w)]
    entropy = -sum(v / len(ids) * math.log2(v / len(ids)) for v in Counter(ids).values())
    base = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))
    failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
    return base, failed, len(ids), sum(model.is_byte(i) for i in ids), entropy


@pytest.fixture(scope="module")
def model(tokenizer):
    return fertility.vocabulary(tokenizer("piece_bpe_32k.model")).model


EDGE = [
    (1, None), (2, ""), (3, " \n\t"), (4, "word"), (4, "word"), (None, "a b c d e f g h " * 9), (5, "x\x1cy é　z \x85 \n\n|#"),
    (6, "one\n\n one\none\n one\n\n"), (7, "日本語 " * 30), (8, "lorem ipsum " * 4000), (9, "\n".join("same line of text here" for _ in range(30))),
]


def test_measures(spark, docs, corpus, model, tokenizer):
    pairs = EDGE + corpus
    rows = fertility.rate(docs(pairs), tokenizer("piece_bpe_32k.model")).collect()
    got = Counter()
    for r in rows:
        base = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        got[(r.doc_id, base, r.base_failed, r.n_tokens, r.n_byte_tokens, round(r.entropy, 9))] += 1
        assert not (r.base_failed and r.kept) and r.kept == (r.reason is None)
    want = Counter()
    for i, t in pairs:
        base, failed, n, n_bytes, entropy = by_hand(t, model)
        want[(i, base, failed, n, n_bytes, round(entropy, 9))] += 1
    assert {k[:5] for k in got} == {k[:5] for k in want}
    assert all(any(abs(g[5] - w[5]) < 1e-6 and g[:5] == w[:5] for g in got) for w in want)


def test_bands_are_medians(spark):
    values = [1.0, 1.2, 1.4, 3.0, 9.0] * 3 + [2.0]
    points = spark.createDataFrame([("en", v) for v in values] + [("de", 5.0)], "_lang string, chars_per_token double")
    rows = {r._lang: r for r in fertility.bands(points, ["_lang"], "chars_per_token").collect()}
    ordered = sorted(values)
    middle = ordered[(len(ordered) + 1) // 2 - 1]
    far = sorted(abs(v - middle) for v in values)
    assert rows["en"].chars_per_token_median == pytest.approx(middle)
    assert rows["en"].chars_per_token_spread == pytest.approx(1.4826 * far[(len(far) + 1) // 2 - 1])
    assert rows["en"].chars_per_token_texts == len(values) and rows["de"].chars_per_token_median == 5.0


def test_what_is_unlike_its_language_goes(spark, tokenizer):
    import random

    rng = random.Random(1)
    vocabulary = "the of house water light stone river under morning people began through little another".split()
    clean = [(k, " ".join(rng.choices(vocabulary, k=120))) for k in range(300)]
    odd = [(1000, " ".join(rng.choices(["zqxj", "xqzk", "qqzx", "kkqz"], k=120))), (1001, " ".join(rng.choices(["ᚠᚢᚦ", "ᚱᚲ", "ᚷᚹᚺ"], k=120)))]
    table = spark.createDataFrame([(i, t, "en") for i, t in clean + odd], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in fertility.keep_good(table, tokenizer("piece_bpe_32k.model")).collect()}
    assert kept == {i for i, _ in clean}


def test_keep_good_keeps_rows_as_they_are(spark, docs, corpus, tokenizer):
    path = tokenizer("piece_bpe_32k.model")
    table = docs(EDGE + corpus + corpus[:3])
    kept = fertility.keep_good(table, path)
    assert kept.columns == table.columns
    good = Counter(r.doc_id for r in fertility.rate(table, path).where("kept").collect())
    assert Counter(r.doc_id for r in kept.collect()) == good


def test_null_language_and_empty_table(spark, docs, tokenizer):
    path = tokenizer("piece_bpe_32k.model")
    assert fertility.rate(docs([(1, "some words " * 30)], lang=None), path).count() == 1
    assert fertility.rate(docs([]), path).collect() == [] and fertility.keep_good(docs([]), path).collect() == []


def clean_texts(seed, n, vocabulary, lengths=(120, 120)):
    """Texts of unlike entropy: each has its own part of the vocabulary."""
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        own = rng.sample(vocabulary, rng.randint(len(vocabulary) // 2, len(vocabulary)))
        made.append(" ".join(rng.choices(own, k=rng.randint(*lengths))))
    return made


ENGLISH = "the of house water light stone river under morning people began through little another".split()


def rated(spark, path, rows):
    table = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    return {r.doc_id: r.reason for r in fertility.rate(table, path).collect()}


def test_copies_do_not_narrow_the_band(spark, tokenizer):
    clean = clean_texts(4, 250, ENGLISH)
    reasons = rated(spark, tokenizer("piece_bpe_32k.model"), [(t, "en") for t in clean + [clean[0]] * 400])
    assert set(reasons.values()) == {None}


def test_a_language_of_two_documents_has_no_band(spark, tokenizer):
    short, long = clean_texts(5, 1, ENGLISH, (25, 25)) + clean_texts(6, 1, ENGLISH + [f"{a}{b}" for a in ENGLISH for b in ENGLISH], (900, 900))
    reasons = rated(spark, tokenizer("piece_bpe_32k.model"), [(short, "xx"), (long, "xx")])
    assert set(reasons.values()) == {None}


def test_byte_fallback_is_measured_by_language(spark, tokenizer, model):
    """The vocabulary has few Amharic letters; an English text with a third of bytes is odd all the same."""
    amharic = clean_texts(7, 220, "ሰላም ለዓለም ሁሉ ዛሬ ጥሩ ቀን ነው እኛም ወደ ገበያ እንሄዳለን ውሃ ድንጋይ ብርሃን ወንዝ ቤት".split())
    english = clean_texts(8, 220, ENGLISH)
    words = english[0].split()
    odd = " ".join(w if k % 24 else "ᚠᚢᚦᚱ" for k, w in enumerate(words))
    share = [sum(map(model.is_byte, ids)) / len(ids) for ids in (model.encode(amharic[0]), model.encode(odd))]
    assert share[0] > 0.4 > share[1] > 0.2
    reasons = rated(spark, tokenizer("piece_bpe_32k.model"), [(t, "am") for t in amharic] + [(t, "en") for t in english] + [(odd, "en")])
    assert {k: r for k, r in reasons.items() if r} == {440: "byte fallback"}
