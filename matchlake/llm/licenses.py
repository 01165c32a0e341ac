"""License scans by conditional compression.

Sentences near a marker are candidate blocks. Every window of a block that could hold a template is compressed alone and
with the template as a raw zstandard dictionary: the templates that save enough bytes are candidates, the most saving
first. A candidate is confirmed word by word: its wording must be there up to a few differences, none of them in a word
that tells licenses apart. Where confirmed places overlap, the one whose template saves more of its bytes names the
license. A block may hold several.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import cache, lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm import ragged
from matchlake.llm.columns import isolate

# fixed values: public license texts and notices, by SPDX id; several texts may stand for one license
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
)
# fixed values: what any license block says somewhere
MARKERS = (
    "licen[sc]", "copyright", "redistribut", "permission is hereby", "permission to use", "public domain", "warrant",
    "creative commons", "free software", "source code form",
)
# a line break or a comment sign may stand between two words of a marker
MARKER = "(?i)" + "|".join(m.replace(" ", "[^a-zA-Z0-9]{1,40}") for m in MARKERS)
# fixed values: words by which licenses differ, so none may be missing or added; a version may not be missing
TELLING = frozenset((
    "not", "never", "lesser", "library", "affero", "gnu", "mozilla", "apache", "boost", "mit", "creative", "commons", "attribution",
    "noncommercial", "non-commercial", "sharealike", "share-alike", "noderivatives", "noderivs", "nc", "sa", "nd", "later",
))
NEGATIONS = frozenset(("not", "never", "isn", "aren", "wasn", "weren"))


@dataclass(frozen=True)
class Scan:
    """A template is a candidate where it saves at least `share` of the bytes that it saves on its own text; it wins if at
    most `missing` of its words are absent and the words put between them are at most that many again."""

    missing: float = 0.1
    level: int = 9
    share: float = 0.1


_WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")
_SENTENCE = re.compile(r"[^\n]+?(?:(?<=[.!?:;])[ \t]+(?=\S)|\n|$)|\n")
_MARKED = re.compile(MARKER)
_VERSION = re.compile(r"v?(\d+(?:\.\d+)*)")


def plain_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@cache
def _dictionaries(level: int) -> list[tuple[str, list[str], zstandard.ZstdCompressor]]:
    made = []
    for name, text in TEMPLATES:
        raw = zstandard.ZstdCompressionDict(" ".join(plain_words(text)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made.append((name, plain_words(text), zstandard.ZstdCompressor(level=level, dict_data=raw, write_content_size=False)))
    return made


@cache
def _packer(level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level, write_content_size=False)


@lru_cache(maxsize=20_000)
def alone(data: bytes, level: int) -> int:
    return len(_packer(level).compress(data))


@lru_cache(maxsize=20_000)
def saved_bytes(data: bytes, k: int, level: int) -> int:
    """Bytes of the compressed data that template `k` saves as dictionary."""
    return alone(data, level) - len(_dictionaries(level)[k][2].compress(data))


@cache
def _least(s: Scan) -> list[float]:
    """The bytes each template must save: a share of those on its own text."""
    return [max(1, s.share * saved_bytes(" ".join(t).encode(), k, s.level)) for k, (_, t, _) in enumerate(_dictionaries(s.level))]


def candidates(words: list[str], s: Scan) -> list[tuple[int, int, int, int]]:
    """(bytes saved, template, first word, word behind the last) of the windows where a template saves enough, the most first."""
    found = []
    for k, (_, template, _) in enumerate(_dictionaries(s.level)):
        allowed = int(s.missing * len(template))
        step = allowed + 1
        # one of these holds any place of the template with all words added
        size = len(template) + allowed + step
        for a in range(0, max(1, len(words) - len(template) - allowed + step), step):
            saved = saved_bytes(" ".join(words[a : a + size]).encode(), k, s.level)
            if saved >= _least(s)[k]:
                found.append((saved, k, a, min(a + size, len(words))))
    return sorted(found, key=lambda f: (-f[0], *f[1:]))


@cache
def longest_gap(s: Scan) -> int:
    """The most words without a marker in a row in any template, and the words that may be put between them."""
    longest = 0
    for _, text in TEMPLATES:
        edges = [0, *[e for m in _MARKED.finditer(text) for e in m.span()], len(text)]
        plain = max(len(plain_words(text[a:b])) for a, b in zip(edges[::2], edges[1::2], strict=True))
        longest = max(longest, plain + int(s.missing * len(plain_words(text))))
    return longest


def blocks(text: str, gap: int) -> list[list[tuple[int, int]]]:
    """Candidates: runs of sentences with words, as (start, end), in which at most `gap` words without a marker lie
    between two marked sentences; sentences of `gap` words more stand on both sides."""
    units, sizes = [], []
    for m in _SENTENCE.finditer(text):
        if n := len(plain_words(m.group())):
            units.append(m.span())
            sizes.append(n)
    spans = [m.span() for m in _MARKED.finditer(text)]
    marked, at = [], 0
    for k, (a, b) in enumerate(units):
        while at < len(spans) and spans[at][1] <= a:
            at += 1
        if at < len(spans) and spans[at][0] < b:
            marked.append(k)
    upto = [0]
    for n in sizes:
        upto.append(upto[-1] + n)
    runs: list[list[int]] = []
    for k in marked:
        if runs and upto[k] - upto[runs[-1][1] + 1] <= gap:
            runs[-1][1] = k
        else:
            runs.append([k, k])
    found, before = [], 0
    for n, (a, b) in enumerate(runs):
        after = runs[n + 1][0] if n + 1 < len(runs) else len(units)
        first, last = a, b
        while first > before and upto[a] - upto[first] < gap:
            first -= 1
        while last + 1 < after and upto[last + 1] - upto[b + 1] < gap:
            last += 1
        found.append(units[first : last + 1])
        before = b + 1
    return found


def versions(words: list[str]) -> set[str]:
    return {m[1] for m in map(_VERSION.fullmatch, words) if m}


def tells(template: list[str], words: list[str], inner: list[tuple[str, int, int, int, int]]) -> bool:
    """The differences hold a telling word, or a version of the template is nowhere in the place."""
    other = template[: inner[0][1]] + template[inner[-1][2] :]
    for o in inner:
        if o[0] != "equal":
            other = other + template[o[1] : o[2]] + words[o[3] : o[4]]
    return any(not TELLING.isdisjoint((w, *w.split("-"))) for w in other) or not versions(template) <= versions(words[inner[0][3] : inner[-1][4]])


def aligned(template: list[str], words: list[str], allowed: int) -> tuple[int, int, int, int, str] | None:
    """(first word, word behind the last, words missing, words added, the differences) of the template in `words`."""
    steps = SequenceMatcher(None, template, words, autojunk=False).get_opcodes()
    same = [n for n, o in enumerate(steps) if o[0] == "equal"]
    best = None
    # equal words far from the rest are not the template's
    for x, a in enumerate(same):
        for b in same[x:]:
            inner = steps[a : b + 1]
            kept = sum(o[2] - o[1] for o in inner if o[0] == "equal")
            added = sum(o[4] - o[3] for o in inner if o[0] != "equal")
            if (len(template) - kept <= allowed and added <= allowed and (best is None or kept > best[0])
                    and not tells(template, words, inner)):
                best = (kept, added, inner)
    if best is None:
        return None
    kept, added, inner = best
    told = [(template[: inner[0][1]], [])]
    told += [(template[o[1] : o[2]], words[o[3] : o[4]]) for o in inner if o[0] != "equal"]
    told.append((template[inner[-1][2] :], []))
    return (inner[0][3], inner[-1][4], len(template) - kept, added,
            "; ".join(f"-{' '.join(t)} +{' '.join(w)}" for t, w in told if t or w))


@lru_cache(maxsize=20_000)
def confirmed(words: tuple[str, ...], k: int, s: Scan) -> tuple[int, int, int, tuple[float, int, int, str]] | None:
    """(first word, word behind the last, bytes saved, (share of the compressed size saved, words missing, words added, the
    differences))."""
    _, template, _ = _dictionaries(s.level)[k]
    allowed = int(s.missing * len(template))
    # with more of its words absent, no alignment can confirm it
    if (Counter(words) & Counter(template)).total() < len(template) - allowed:
        return None
    place = aligned(template, list(words), allowed)
    if place is None:
        return None
    data = " ".join(words[place[0] : place[1]]).encode()
    saved = saved_bytes(data, k, s.level)
    return (*place[:2], saved, (round(saved / alone(data, s.level), 6), *place[2:])) if saved > 0 else None


def recognised(words: list[str], s: Scan) -> list[tuple[int, int, tuple[str, float, int, int, str]]]:
    """(first word, word behind the last, (license, share of the compressed size saved, words missing, words added, the
    differences)) for each license text in the words; where two overlap, the one that saves more bytes counts."""
    found = []
    for _, k, at, end in candidates(words, s):
        if told := confirmed(tuple(words[at:end]), k, s):
            found.append((-told[2], told[3][1], at + told[0], at + told[1], (_dictionaries(s.level)[k][0], *told[3])))
    chosen: list[tuple[int, int, tuple[str, float, int, int, str]]] = []
    for _, _, a, b, told in sorted(found):
        if all(b <= c or d <= a for c, d, _ in chosen):
            chosen.append((a, b, told))
    return sorted(chosen)


def scanned(text: str, s: Scan) -> list[tuple[int, int, tuple[str, float, int, int, str]]]:
    """Licenses with the start of the first and the end of the last sentence they stand in."""
    found = []
    for units in blocks(text, longest_gap(s)):
        words, unit = [], []
        for n, (a, b) in enumerate(units):
            own = plain_words(text[a:b])
            words += own
            unit += [n] * len(own)
        for a, b, told in recognised(words, s):
            before = [w for w, n in zip(words[max(0, a - 3) : a], unit[max(0, a - 3) : a], strict=True) if n == unit[a]]
            if NEGATIONS.isdisjoint(before):
                found.append((units[unit[a]][0], units[unit[b - 1]][1], told))
    return found


FOUND = (("license", T.StringType()), ("start", T.LongType()), ("end", T.LongType()), ("saved", T.DoubleType()),
         ("words_missing", T.LongType()), ("words_added", T.LongType()), ("wording", T.StringType()))


def find_licenses(
    docs: DataFrame, scan: Scan | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per license block: doc_id, license (SPDX id), start and end (code points of the text), saved,
    words_missing, words_added, wording (the differences; empty where the wording is exact).

    - Null and empty texts and texts without a marker give no rows, nor does a license that its sentence negates just before. Null and repeated doc_ids and repeated
      rows are scanned like any other. Other columns are left aside. An empty table gives no rows.

    Texts without a marker are dropped by a plain SQL filter before anything goes to Python. No shuffle; a
    task remembers a bounded number of distinct blocks.
    """
    s = scan or Scan()
    work = isolate(docs, doc=doc_id, text=text).where(F.col("_text").rlike(MARKER)).select("_doc", "_text")
    schema = T.StructType([T.StructField(doc_id, work.schema["_doc"].dataType), *[T.StructField(n, t) for n, t in FOUND]])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, len(batch) * ragged.CHUNK_BYTES // max(1, batch.nbytes))
            for k in range(0, len(batch), step):
                part = batch.slice(k, step)
                rows, own = [], []
                for n, whole in enumerate(part.column(1).to_pylist()):
                    for start, end, told in scanned(whole, s):
                        own.append(n)
                        rows.append((told[0], start, end, *told[1:]))
                columns = list(zip(*rows, strict=True)) or [()] * len(FOUND)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(own, pa.int64())),
                    *[pa.array(c, {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64()}[t.simpleString()])
                      for c, (_, t) in zip(columns, FOUND, strict=True)],
                ], names=schema.names)

    return work.mapInArrow(look, schema)


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
