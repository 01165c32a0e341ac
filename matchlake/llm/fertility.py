"""Quality rules from tokeniser fertility: how a public vocabulary takes a text apart.

A text that its vocabulary breaks into unusually short pieces, falls back to bytes for, or
repeats few pieces of, is unlike its language. The usual range is a band per language, taken from
all distinct texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from matchlake.llm import ragged
from matchlake.llm.columns import isolate, restore, settle

REMEMBERED = 600_000
# parts of the texts of one language and size
SALTS = 64


@dataclass(frozen=True)
class Bands:
    """Distances from a group's median in robust standard deviations (1.4826 times the median
    absolute deviation, at least `least_spread`)."""

    width: float = 6.0
    least_spread: float = 0.02
    # a size class with fewer distinct texts takes its language's band
    least_texts: int = 200
    # a language with fewer distinct texts has no band, and nothing of it is rejected by one
    least_language: int = 30


class Vocabulary:
    """Tokens of words by a sentencepiece model; a word is taken by itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids = np.zeros(0, dtype=np.uint16)
        self.first = np.zeros(1, dtype=np.int64)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        unknown = list(set(words) - self.number.keys())
        if len(self.number) + len(unknown) > REMEMBERED:
            self.forget()
            unknown = list(set(words))
        if unknown:
            encoded = self.model.encode([w.decode("utf-8", "replace") for w in unknown], num_threads=1)
            base = len(self.number)
            self.number.update(zip(unknown, range(base, base + len(unknown)), strict=True))
            lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
            self.ids = np.r_[self.ids, np.fromiter((i for e in encoded for i in e), dtype=np.uint16, count=int(lengths.sum()))]
            self.first = np.r_[self.first, self.first[-1] + np.cumsum(lengths)]
        which = np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))
        sizes = np.diff(self.first)[which]
        return ragged.gather(self.ids, self.first[which], sizes), sizes


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def repeats(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(later, any): flags of entries equal to an earlier one, or to any other one, of their text."""
    keys = ragged.mixed(hashes ^ (text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    later, every = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    later[order] = same[:-1]
    every[order] = same[:-1] | same[1:]
    return later, every


def measures(data: np.ndarray, offsets: np.ndarray, path: str) -> dict[str, np.ndarray]:
    """The base measures and the token measures of each text."""
    starts, ends, first = ragged.words(data, offsets)
    n = len(offsets) - 1
    code_point = (data & 0xC0) != 0x80
    hashes = ragged.SliceHash(data)
    # lines: a text begins one, and so does every byte behind a line break
    breaks = np.flatnonzero(data == 0x0A) + 1
    text_of_break = np.searchsorted(offsets, breaks - 1, side="right") - 1
    line_text = np.r_[np.arange(n), text_of_break]
    line_start = np.r_[offsets[:-1], breaks]
    order = np.lexsort((line_start, line_text))
    line_text, line_start = line_text[order], line_start[order]
    next_start = np.r_[line_start[1:], len(data) + 1]
    line_end = np.minimum(next_start - 1, offsets[line_text + 1])
    line_end[np.r_[line_text[1:] != line_text[:-1], True]] = offsets[line_text + 1][np.r_[line_text[1:] != line_text[:-1], True]]
    with_word = np.searchsorted(starts, line_start) < np.searchsorted(starts, line_end)
    line_text, line_start, line_end = line_text[with_word], line_start[with_word], line_end[with_word]
    dup_line, _ = repeats(line_text, hashes(line_start, line_end))
    # windows of eight words
    window_hash, at = ragged.windows(hashes(starts, ends), first, 8)
    text_of_word = np.repeat(np.arange(n), np.diff(first))
    _, twice = repeats(text_of_word[at], window_hash)
    change = np.zeros(len(starts) + 9, dtype=np.int64)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + 8, -1)
    covered = np.cumsum(change)[: len(starts)] > 0
    # tokens
    raw = data.tobytes()
    words = [w for k in range(n) for w in raw[offsets[k] : offsets[k + 1]].split()]
    model = vocabulary(path)
    ids, sizes = model(words)
    sums = np.r_[0, np.cumsum(sizes)]
    token_first = sums[first]
    n_tokens = np.diff(token_first)
    key = (np.repeat(np.arange(n, dtype=np.uint64), n_tokens) << np.uint64(16)) | ids
    key.sort()
    run = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.r_[run, len(key)]).astype(np.float64)
    part = np.bincount((key[run] >> np.uint64(16)).astype(np.int64), weights=count * np.log2(count), minlength=n)
    total = np.maximum(n_tokens, 1)
    return {
        "n_words": np.diff(first),
        "word_chars": per_text(code_point & ~ragged.WHITE_BYTE[data], offsets),
        "n_symbols": per_text(SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(line_text[dup_line], minlength=n),
        "n_repeat_words": per_text(covered, first),
        "n_tokens": n_tokens,
        "n_byte_tokens": per_text(model.is_byte[ids], token_first),
        "entropy": np.where(n_tokens > 0, np.log2(total) - part / total, 0.0),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens")


def measured(docs: DataFrame, path: str) -> DataFrame:
    """The measures of the column `_text`; all other columns are carried."""
    keys = [f for f in docs.schema.fields if f.name != "_text"]
    schema = T.StructType([
        *keys, *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("entropy", T.DoubleType()),
    ])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = batch.drop_columns(["_text"])
            for rows, data, offsets in ragged.chunks(batch, "_text"):
                found = measures(data, offsets, path)
                part = others.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(found[c].astype(np.int64)) for c in COUNTS], pa.array(found["entropy"])],
                    names=[*part.schema.names, *COUNTS, "entropy"],
                )

    return docs.mapInArrow(measure, schema)


def _median(histogram: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The lower weighted median of `value` for each key."""
    upto = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    ranked = histogram.withColumn("_upto", F.sum("_n").over(upto)).withColumn("_all", F.sum("_n").over(whole))
    return ranked.where(2 * F.col("_upto") >= F.col("_all")).groupBy(*keys).agg(
        F.min(value).alias(name), F.max("_all").alias("_all")
    )


def bands(points: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, <value>_median, <value>_spread, <value>_texts) over all rows.

    Values are counted in steps of 0.001, so exact medians come from tables of a few thousand
    rows per group, merged in each task before anything moves.
    """
    histogram = points.groupBy(*keys, F.round(F.col(value) * 1000).cast("long").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    middle = _median(histogram, keys, "_v", "_middle").drop("_all")
    far = histogram.join(middle, keys).groupBy(*keys, F.abs(F.col("_v") - F.col("_middle")).alias("_far")).agg(F.sum("_n").alias("_n"))
    spread = _median(far, keys, "_far", "_spread")
    return middle.join(spread, keys).select(
        *keys, (F.col("_middle") / 1000).alias(f"{value}_median"),
        (F.col("_spread") * 1.4826 / 1000).alias(f"{value}_spread"), F.col("_all").alias(f"{value}_texts"),
    )


def limits(points: DataFrame, value: str, rules: Bands) -> DataFrame:
    """The band of each language and size class; where a class has few texts, its language's; null where that has few too."""
    known = F.col(f"{value}_texts") >= rules.least_language
    wide = bands(points, ["_lang"], value).select(
        "_lang", F.when(known, F.col(f"{value}_median")).alias("_m"), F.when(known, F.col(f"{value}_spread")).alias("_s")
    )
    enough = F.col(f"{value}_texts") >= rules.least_texts
    return bands(points, ["_lang", "_class"], value).join(wide, "_lang").select(
        "_lang", "_class",
        F.when(enough, F.col(f"{value}_median")).otherwise(F.col("_m")).alias(f"{value}_median"),
        F.when(enough, F.col(f"{value}_spread")).otherwise(F.col("_s")).alias(f"{value}_spread"),
    )


def size_class(tokens: Column) -> Column:
    """Half octaves of the number of tokens: entropy depends on it."""
    return F.floor(2 * F.log2(F.greatest(tokens, F.lit(1)))).cast("int")


BANDED = ("byte_share", "chars_per_token", "entropy")


def judge(features: DataFrame, rules: Bands) -> DataFrame:
    """`features` (with _lang and the measures) with base_failed, reason and kept added."""
    full = features.withColumns({
        "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        "_lang": F.coalesce("_lang", F.lit("")),
        "_class": size_class(F.col("n_tokens")),
        "chars_per_token": F.col("word_chars") / F.greatest(F.col("n_tokens"), F.lit(1)),
        "byte_share": F.col("n_byte_tokens") / F.greatest(F.col("n_tokens"), F.lit(1)),
    })
    # a text counts once in its language, however many copies it has
    points = settle(full.where(~F.col("base_failed")).groupBy("_lang", "_version").agg(
        *[F.min(c).alias(c) for c in ("_class", *BANDED)]
    ))
    table = reduce(lambda a, b: a.join(b, ["_lang", "_class"]), [limits(points, value, rules) for value in BANDED])
    # most texts may be of one language: each part of them meets its own copy of the small table
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = full.withColumn("_salt", F.pmod(F.xxhash64("_doc", "_version"), F.lit(SALTS)).cast("int"))
    joined = salted.join(table.withColumn("_salt", salts), ["_lang", "_class", "_salt"], "left")

    def outside(value: str) -> Column:
        spread = F.greatest(F.col(f"{value}_spread"), F.lit(rules.least_spread))
        return F.coalesce(F.abs(F.col(value) - F.col(f"{value}_median")) > rules.width * spread, F.lit(False))

    reason = (
        F.when(F.col("base_failed"), "base").when(outside("byte_share"), "byte fallback")
        .when(outside("chars_per_token"), "characters per token").when(outside("entropy"), "token entropy")
    )
    return joined.withColumn("reason", reason).withColumn("kept", F.col("reason").isNull())


RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens",
    "chars_per_token", "entropy", "base_failed", "reason", "kept",
)


def rate(
    docs: DataFrame, path: str, rules: Bands | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """One row per row of `docs`: doc_id, version (a hash of the text) and the columns RESULTS.

    - Null or empty text: no words, so base_failed and not kept.
    - Null lang: a group of its own. A null or repeated doc_id and repeated rows are rated as they
      are. Other columns are left aside. An empty table gives no rows.
    - Groups of texts share one band, but no group meets in a task: only distinct texts' measures and
      counts of values move.
    - Copies of a text count once in the bands. A language (or null lang) with fewer than 30 distinct texts that pass
      the base rules (`least_language`) has no band: only the base rules reject its texts.

    The measures are computed once and kept in the checkpoint folder, as the bands need all of them.
    """
    work = isolate(docs, doc=doc_id, text=text, lang=lang).select(
        "_doc", "_lang", F.xxhash64("_text").alias("_version"), "_text"
    )
    rated = judge(settle(measured(work, path)), rules or Bands())
    return rated.select(F.col("_doc").alias(doc_id), F.col("_version").alias("version"), *RESULTS)


def keep_good(docs: DataFrame, path: str, rules: Bands | None = None) -> DataFrame:
    """The rows of `docs` that `rate` keeps, unchanged."""
    bad = rate(docs, path, rules).where(~F.col("kept")).select(
        F.col("doc_id").alias("_bad"), F.col("version").alias("_bad_version")
    ).distinct()
    work = isolate(docs, doc="doc_id", text="text").withColumn("_version", F.xxhash64("_text"))
    good = work.join(
        bad, F.col("_doc").eqNullSafe(F.col("_bad")) & (F.col("_version") == F.col("_bad_version")), "left_anti"
    )
    return restore(good, docs.columns, {"doc": "doc_id", "text": "text"})


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return rate(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("version")
