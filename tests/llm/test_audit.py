"""The filter audit against a brute force over every order, with nulls, copies and clashing columns."""

import re
from itertools import permutations

from matchlake.llm.audit import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def verdicts(rows):
    """Per row: (part, set of failed letters, good, toxic) as the docstring states them."""
    out = []
    for doc, text, lang, good, toxic in rows:
        t = text or ""
        words = WORD.findall(t)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in t) > 3 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if doc is not None and any(o is not None and o < doc and (ot or "") == t for o, ot, *_ in rows):
            fails.add("E")
        out.append((lang or "", fails, good, toxic))
    return out


def brute(rows):
    table = verdicts(rows)
    result = {}
    for part in {p for p, *_ in table}:
        mine = [v for v in table if v[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                before, upto = set(order[:step - 1]), set(order[:step])
                gone = [v for v in mine if letter in v[1] and not v[1] & before]
                result[(part, order, step)] = (
                    sum(1 for v in mine if not v[1] & upto), len(gone),
                    sum(1 for v in mine if letter in v[1] and v[1] & before),
                    sum(1 for v in mine if v[1] == {letter}),
                    sum(1 for v in gone if v[2]), sum(1 for v in gone if v[3]),
                )
        for letter in "ABCDE":
            total = sum(result[(part, o, o.index(letter) + 1)][1] for o in map("".join, permutations("ABCDE")))
            for order in map("".join, permutations("ABCDE")):
                key = (part, order, order.index(letter) + 1)
                result[key] = (*result[key], total)
    return result


def long_text(seed, n=250):
    return " ".join(f"w{seed}x{i}" for i in range(n))


ROWS = [
    (1, long_text(1), "en", True, False),
    (2, long_text(1), "en", False, True),            # copy of 1: fails E
    (2, long_text(1), "en", False, True),            # repeated row of 2
    (3, "short text", "en", True, True),             # A
    (4, " ".join(["same"] * 300), "fr", True, False),  # B
    (5, "ABC " * 260, "fr", None, None),             # B and C, unlabelled
    (6, long_text(6) + " #", None, False, False),    # D, null lang
    (None, long_text(1), "en", True, False),         # null id: never E
    (7, None, "", False, False),                     # null text, empty lang: A
    (8, "", "", False, True),                        # empty text equal to the null one: A and E
]


def make(spark, rows):
    docs = spark.createDataFrame(
        [(d, t, l, "src", 1, "x", "y") for d, t, l, *_ in rows],
        "doc_id long, text string, lang string, source string, _key long, A string, _part string",
    )
    labels = spark.createDataFrame(
        [(d, int(g), int(x)) for d, _, _, g, x in rows if g is not None and d is not None],
        "doc_id long, quality int, toxic int",
    ).dropDuplicates(["doc_id"])
    return docs, labels


def test_every_order_against_brute_force(spark):
    docs, labels = make(spark, ROWS)
    got = {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in audit(docs, labels).collect()
    }
    seen = {}
    for d, _, _, g, x in ROWS:
        if d is not None and g is not None:
            seen.setdefault(d, (g, x))
    labelled = [(d, t, l, *(seen.get(d, (False, False)) if d is not None else (False, False))) for d, t, l, *_ in ROWS]
    assert got == brute(labelled)
    assert len(got) == 3 * 600


def test_empty_table_gives_no_rows(spark):
    docs, labels = make(spark, ROWS)
    assert audit(docs.limit(0), labels).count() == 0


def test_without_labels_nothing_is_lost(spark):
    docs, _ = make(spark, ROWS)
    rows = audit(docs).collect()
    assert rows and all(r.good_lost == 0 and r.toxic_lost == 0 for r in rows)
