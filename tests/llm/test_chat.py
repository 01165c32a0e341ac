import hashlib

import pytest

from matchlake.llm.chat import PROBE, Grammar, format_conversations, read_back

NASTY = [
    "", " ", PROBE, "␛", "␛␛[INST]", "[INST", "a</s>\n", "</s", "<s>[INST] user [/INST] x</s>\n", "[/INST] ", "\\ $1 \n\n",
    "<<s>s>", "[[INST]INST]", "␛<␛s>", "é🎉 </s>", "x" * 20_000 + "</s>",
]


def rendered(spark, rows, grammar=None):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    return {r.conv_id: r for r in read_back(format_conversations(turns, grammar), grammar).collect()}


def test_every_text_comes_back(spark):
    rows = [(k // 4, k, ("user", "assistant")[k % 2], t, "clash") for k, t in enumerate(NASTY)]
    back = rendered(spark, rows)
    assert sum(len(r.turns) for r in back.values()) == len(NASTY)
    for conv, row in back.items():
        own = [r for r in rows if r[0] == conv]
        assert [(t.role, t.text) for t in row.turns] == [(r[2], r[3]) for r in own]
        assert row.loss_text == "".join(r[3] for r in own if r[2] == "assistant")
        for span, text in zip(row.loss_spans, [r[3] for r in own if r[2] == "assistant"], strict=True):
            shown = row.formatted[span.start : span.start + span.length]
            assert shown.replace("␛␛", "\0").replace("␛", "").replace("\0", "␛") == text


def test_control_strings_do_not_show_inside_texts(spark):
    row = rendered(spark, [(1, 0, "user", PROBE, ""), (1, 1, "assistant", PROBE, "")])[1]
    assert row.formatted.count("</s>") == 2 and row.formatted.count("[INST]") == 2
    assert row.level == 1


def test_plain_texts_are_not_escaped(spark):
    row = rendered(spark, [(1, 0, "user", "hello", "")])[1]
    assert row.formatted == "<s>[INST] user [/INST] hello</s>\n" and row.level == 0


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, None, ""), (None, None, "user", "b", ""), (7, 1, "user", "b", ""), (7, 1, "user", "a", ""),
            (7, 1, "user", "a", ""), (7, None, "[INST]", "first", "")]
    back = rendered(spark, rows)
    assert [(t.role, t.text) for t in back[None].turns] == [("", ""), ("user", "b")]
    assert [(t.role, t.text) for t in back[7].turns] == [("[INST]", "first"), ("user", "a"), ("user", "a"), ("user", "b")]
    assert back[7].loss_text == ""


def test_empty_table(spark):
    assert rendered(spark, []) == {}


@pytest.mark.parametrize("grammar", [
    Grammar(open="aa", middle="bd", close="cc", reserved=("aba",), escape="~"),
    Grammar(open="<|im_start|>", middle="<|im_sep|>", close="<|im_end|>", reserved=("<|im_sep|>",)),
])
def test_other_grammars(spark, grammar):
    texts = ["aaa", "c", "cccc", "ab~a", "\n", "abab", "~", "", "<|im_end|><|im_start|>", "a\nb"]
    rows = [(1, k, "r", t, "") for k, t in enumerate(texts)]
    assert [t.text for t in rendered(spark, rows, grammar)[1].turns] == texts


def test_the_query_reads_back_whole_table(spark):
    from matchlake.llm.chat import op1_chat_formatting

    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    got = {r.conv_id: r for r in op1_chat_formatting(spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == {r.conv_id for r in table} | {-1}
    for conv in list(got)[:20]:
        own = sorted((r for r in table if r.conv_id == conv), key=lambda r: r.turn)
        if own:
            flat = "".join(f"{r.role}\n{r.text}\n" for r in own)
            assert got[conv].turns_sha256 == hashlib.sha256(flat.encode()).hexdigest()
    assert got[-1].loss_chars == len(PROBE)


def test_no_python_in_the_plan(spark):
    turns = spark.createDataFrame([(1, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = read_back(format_conversations(turns))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
