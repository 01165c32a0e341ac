import textwrap

from matchlake.llm.licenses import TEMPLATES, Scan, candidates, find_licenses, plain_words, recognised

MIT = next(t for n, t in TEMPLATES if n == "MIT" and len(t) > 100)


def found(df):
    return sorted((r.doc_id, r.license) for r in df.collect())


def test_every_template_names_its_license(spark, docs):
    pairs = [(k, f"Before it.\n{t}\nAfter it.") for k, (_, t) in enumerate(TEMPLATES)]
    rows = find_licenses(docs(pairs)).collect()
    assert {(r.doc_id, r.license) for r in rows} == {(k, n) for k, (n, _) in enumerate(TEMPLATES)}
    assert all(r.words_missing == 0 and r.words_added == 0 for r in rows)


def test_small_changes_are_told(spark, docs):
    text = MIT.replace("free of charge", "without charge").replace("\n", " ")
    row = find_licenses(docs([(1, "Copyright (c) 2020 Someone\n" + text)])).first()
    assert row.license == "MIT" and 0 < row.words_missing < 4 and "charge" not in row.wording.split("+")[0] or row.words_added > 0


def test_near_names_are_told_apart(spark, docs):
    pairs = [
        (1, "Licensed under CC BY 4.0."), (2, "Licensed under CC BY-NC 4.0."), (3, "This work is licensed under the GNU General Public License, version 2."),
        (4, "Ask for a license before you drive."), (5, "They have the copyright of nothing at all."), (6, "Licensed under the Apache License, Version 1.1."),
    ]
    assert found(find_licenses(docs(pairs))) == [(1, "CC-BY-4.0"), (2, "CC-BY-NC-4.0"), (3, "GPL-2.0-only")]


def test_place_and_several_blocks(spark, docs):
    text = "é one two.\n" + "x y z.\n" * 5 + "Released under the MIT License.\n" + "a b.\n" * 6 + "Licensed under CC BY-NC 4.0.\nend"
    rows = find_licenses(docs([(1, text)])).collect()
    assert [text[r.start : r.end].strip() for r in sorted(rows, key=lambda r: r.start)] == ["Released under the MIT License.", "Licensed under CC BY-NC 4.0."]


def test_wrapped_comments_and_neighbours(spark, docs):
    """A header wrapped at any width behind comment signs; two texts one behind the other."""
    by_name = {n: max((t for m, t in TEMPLATES if m == n), key=len) for n, _ in TEMPLATES}
    wrap = lambda t, sign, width: "\n".join(f"{sign} {x}\n{sign}" for x in textwrap.wrap(t, width))
    pairs = [(k, f"int main;\n{wrap(MIT, sign, width)}\nint other;") for k, (sign, width) in enumerate([("//", 72), ("#", 40), (" *", 60)])]
    pairs.append((7, by_name["MIT"] + "\n\n" + by_name["BSD-3-Clause"]))
    pairs.append((8, by_name["MIT"] + "\n" + wrap(by_name["GPL-3.0-or-later"], "#", 72)))
    assert found(find_licenses(docs(pairs))) == [
        (0, "MIT"), (1, "MIT"), (2, "MIT"), (7, "BSD-3-Clause"), (7, "MIT"), (8, "GPL-3.0-or-later"), (8, "MIT")]


def test_edge_cases(spark, docs):
    pairs = [(1, None), (2, ""), (None, "Released under the MIT License."), (3, "Released under the MIT License."), (3, "Released under the MIT License."),
             (4, "licence " * 20_000)]
    assert sorted(found(find_licenses(docs(pairs).where("doc_id is not null")))) == [(3, "MIT"), (3, "MIT")]
    assert find_licenses(docs(pairs)).where("doc_id is null").count() == 1
    assert find_licenses(docs([])).collect() == []


def test_corpus(spark):
    """The notices of the corpus stand on lines of their own."""
    sf = "/root/testdata/sf0.01"
    notices = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    table = spark.read.parquet(f"{sf}/documents.parquet")
    want = sorted((r.doc_id, notices[x]) for r in table.collect() for x in (r.text or "").split("\n") if x in notices)
    assert found(find_licenses(table)) == want


def test_compression_chooses_and_ranks():
    """Candidates come by bytes saved; of overlapping confirmed places the one that saves more counts."""
    s = Scan()
    by_name = {n: max((t for m, t in TEMPLATES if m == n), key=len) for n, _ in TEMPLATES}
    words = plain_words("as told before " + by_name["BSD-3-Clause"] + " and so on")
    ranked = candidates(words, s)
    assert [f[0] for f in ranked] == sorted((f[0] for f in ranked), reverse=True)
    assert list(dict.fromkeys(TEMPLATES[f[1]][0] for f in ranked))[:2] == ["BSD-3-Clause", "BSD-2-Clause"]
    assert [told[0] for _, _, told in recognised(words, s)] == ["BSD-3-Clause"]
    assert candidates(plain_words("1 2 3 4 5 6 7 8 9"), s) == []


def test_long_and_repetitive_blocks():
    """A text beside hundreds of equal words is found, wherever it stands, and each copy once."""
    s, notice = Scan(), plain_words("Licensed under CC BY-NC 4.0.")
    for at in (0, 1, 300):
        words = ["tithre"] * at + plain_words("Anreti the atshin torestouti heshly") + notice + ["that"] * 200 + plain_words(MIT)
        assert [(a, told[0]) for a, _, told in recognised(words, s)] == [(at + 5, "CC-BY-NC-4.0"), (at + 5 + len(notice) + 200, "MIT")]


def test_words_that_tell_licenses_apart(spark, docs):
    gpl = next(t for n, t in TEMPLATES if n == "GPL-3.0-or-later")
    cc = "This work is licensed under a Creative Commons {} International License."
    work = "This work is licensed under the GNU {}."
    texts = [
        cc.format("Attribution-NonCommercial 4.0"), cc.format("Attribution-ShareAlike 4.0"), cc.format("Attribution 3.0"),
        work.format("Lesser General Public License, version 2.1"), work.format("General Public License, version 1"),
        gpl.replace("GNU General", "GNU Affero General"), gpl.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1"),
        "This file is not released under the MIT License.",
    ]
    assert found(find_licenses(docs(list(enumerate(texts))))) == []
    kept = [cc.format("Attribution 4.0"), "It is not.\nReleased under the MIT License.", gpl.replace("redistribute it", "give it away")]
    assert found(find_licenses(docs(list(enumerate(kept))))) == [(0, "CC-BY-4.0"), (1, "MIT"), (2, "GPL-3.0-or-later")]
