import re
from collections import defaultdict

from matchlake.llm.line_dedup import drop_shared_lines

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(WHITE))


def by_hand(pairs, min_chars, min_docs):
    holders = defaultdict(set)
    for i, t in pairs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    order = lambda i: float("-inf") if i is None else i
    keeper = {k: max(ids, key=order) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


CASES = [
    (1, "shared line one\nown\n\tSHARED line one \r\nend"), (2, "shared line one"), (3, "Shared Line One\n\nx"), (3, "shared line one\nz"),
    (4, None), (5, ""), (None, "shared line one\nq"), (None, "shared line one"), (6, "\n\n\n"), (7, " shared line one"),
    (8, "ÉCOLE shared text\na"), (9, "École shared text\na"), (9, "École shared text\na"), (10, "x" * 50_000 + "\nshared line one"),
]


def test_edge_cases(spark, docs):
    assert result(drop_shared_lines(docs(CASES), 10, 3)) == by_hand(CASES, 10, 3)


def test_extra_columns_are_carried(spark, docs):
    row = drop_shared_lines(docs([(1, "a")])).first()
    assert row._text == "x" and row._row == "y" and row.n_lines == 1 and row.kept == "c"


def test_empty_table(spark, docs):
    assert drop_shared_lines(docs([])).collect() == []


def test_corpus(spark, docs, corpus):
    for parameters in ((40, 5), (5, 2)):
        assert result(drop_shared_lines(docs(corpus), *parameters)) == by_hand(corpus, *parameters)


def test_no_python_in_the_plan(spark, docs):
    plan = drop_shared_lines(docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "EvalPython" not in plan
