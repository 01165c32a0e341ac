from matchlake.llm.decontaminate import drop_leaks, leaks

QUESTION = "A farmer has 12 apples and gives 5 apples to his friend Peter who walks 3 miles every morning before work."
CHANGED = "A farmer has 40 apples and gives 7 apples to his friend Maria who walks 9 miles every morning before work."
TWISTED = "A farmer has 40 apples and gives 40 apples to his friend Maria who walks 9 miles every morning before work."
OTHER = "Nothing of the kind is said in this text about farms and fruit, it only goes on and on."


def bench(spark, items):
    return spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, doc_id string")


def found(spark, docs, pairs, items):
    return {(r.doc_id, r.item_id): r for r in leaks(docs(pairs), bench(spark, items)).collect()}


def test_kinds(spark, docs):
    pairs = [(1, QUESTION), (2, f"{OTHER} {CHANGED} {OTHER}"), (3, OTHER), (4, f"{OTHER}\n{QUESTION.upper()}"), (5, QUESTION[:40])]
    got = found(spark, docs, pairs, [(7, QUESTION), (8, OTHER + " more")])
    assert got[1, 7].kind == "exact" and got[1, 7].covered == got[1, 7].item_tokens
    assert got[2, 7].kind == "re-parameterised" and got[2, 7].changed_values >= 3
    assert (3, 8) in got and (3, 7) not in got and (5, 7) not in got


def test_contradictory_values_are_not_the_question(spark, docs):
    question = "Take 4 cups of flour and 4 cups of sugar then mix 4 cups of milk into it and wait for 9 hours."
    twisted = "Take 2 cups of flour and 3 cups of sugar then mix 5 cups of milk into it and wait for 9 hours."
    renamed = "Take 6 cups of flour and 6 cups of sugar then mix 6 cups of milk into it and wait for 1 hours."
    got = found(spark, docs, [(1, twisted), (2, renamed), (3, TWISTED)], [(0, question), (1, QUESTION)])
    assert set(got) == {(2, 0)}


def test_an_item_inside_a_sentence(spark, docs):
    item = "Seven small boats left that quiet harbour before noon."
    text = "he said that Seven small boats left that quiet harbour before noon. " + OTHER
    assert found(spark, docs, [(1, text), (2, item)], [(3, item)]).keys() == {(1, 3), (2, 3)}


def test_units_and_names(spark, docs):
    item = "the runner covered a distance of 10 km in the park near old Berlin while the other one rested at home."
    text = "the runner covered a distance of 6 miles in the park near old Paris while the other one rested at home."
    assert found(spark, docs, [(1, text)], [(1, item)])[1, 1].kind == "re-parameterised"


def test_edge_cases(spark, docs):
    pairs = [(1, None), (2, ""), (3, "| ## |"), (None, QUESTION), (4, QUESTION), (4, QUESTION), (4, OTHER), (5, "word " * 40_000 + QUESTION)]
    got = found(spark, docs, pairs, [(None, QUESTION), (1, None), (2, ""), (3, "too short")])
    assert set(got) == {(None, None), (4, None), (5, None)}
    assert found(spark, docs, pairs, []) == {} and found(spark, docs, [], [(1, QUESTION)]) == {}
    kept = drop_leaks(docs(pairs), bench(spark, [(1, QUESTION)]))
    assert kept.columns == docs(pairs).columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, None), (2, ""), (3, "| ## |"), (4, OTHER)] or len(kept.collect()) == 4


def test_copies_of_any_words(spark, docs):
    """Dense in names and numbers, shorter than a window, all in capitals; a changed name at a sentence's start."""
    dense = "Maria had 12 apples, Peter gave 3 to John and 4 to Anna."
    german = "Der Bauer bringt Äpfel, Birnen und Pflaumen mit Karren zum Markt in Köln am Rhein."
    named = "Peter has 12 apples and some Peter took. Peter ate 5 of them."
    renamed = "Maria has 40 apples and some Maria took. Maria ate 7 of them."
    items = [(1, dense), (2, "What is 17 * 23 + 4?"), (3, german), (4, QUESTION), (5, named)]
    pairs = [(1, f"{OTHER} {dense} {OTHER}"), (2, f"{OTHER} What is 17 * 23 + 4? {OTHER}"), (3, f"{OTHER}\n{german}"), (4, QUESTION.upper()), (5, renamed),
             (6, "Maria had 9 apples. What is 17 * 23 then?")]
    got = found(spark, docs, pairs, items)
    assert set(got) == {(k, k) for k in range(1, 6)}
    assert all(got[k, k].kind == "exact" for k in range(1, 5)) and got[5, 5].kind == "re-parameterised"


def test_corpus_against_word_windows(spark, corpus):
    """Items stand in the corpus word by word: any eight words of one name it."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    windows = {}
    for r in items.collect():
        words = r.text.split()
        for k in range(len(words) - 7):
            windows.setdefault(tuple(words[k : k + 8]), set()).add(r.item_id)
    want = set()
    for i, t in corpus:
        words = t.split()
        for k in range(len(words) - 7):
            want |= {(i, item) for item in windows.get(tuple(words[k : k + 8]), ())}
    assert {(r.doc_id, r.item_id) for r in leaks(table, items).collect()} == want
