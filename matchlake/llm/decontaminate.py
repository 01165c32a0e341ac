"""Benchmark decontamination by templates.

Numbers, names and units become typed placeholders. Windows of the template are hashed and joined
with those of the benchmark, and what stood in the placeholders is compared: one consistent
replacement of values all through a passage is a re-parameterised question, a contradictory one is not.
Beside them windows of the words as they are, in lower case, find copies whatever they consist of.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm import ragged
from matchlake.llm.columns import isolate, restore, settle

# fixed values: words that are units behind a number
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "ft", "yard", "yards", "mile", "miles",
    "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms", "ounce", "ounces", "oz", "pound", "pounds", "lb", "lbs",
    "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons",
    "second", "seconds", "s", "minute", "minutes", "min", "hour", "hours", "h", "day", "days", "week", "weeks",
    "month", "months", "year", "years",
    "dollar", "dollars", "usd", "euro", "euros", "eur", "cent", "cents", "percent",
    "meter", "meters", "metre", "metres", "kmh", "mph", "degrees", "celsius", "fahrenheit", "watt", "watts", "volt", "volts",
)
LITERAL, NUMBER, UNIT, NAME = range(4)


@dataclass(frozen=True)
class Templates:
    """A template window is `window` tokens with at least `literals` that are no placeholders; an exact one is any
    `window` tokens, or the whole of a shorter item. An item is found when exact windows and template windows
    with consistent placeholders cover `covered` of its tokens, or all of a shorter item."""

    window: int = 8
    literals: int = 5
    covered: int = 13
    # windows are looked up in a bit map of this size first, whatever the size of the benchmark
    map_bits: int = 24


_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_SENTENCE_END = np.zeros(256, dtype=bool)
_SENTENCE_END[list(b".!?:")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _capital(data: np.ndarray) -> np.ndarray:
    """Bytes that begin a capital letter A-Z or À-Þ."""
    found = (data >= 0x41) & (data <= 0x5A)
    two = np.zeros(len(data), dtype=bool)
    two[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    return found | two


def tokens(
    data: np.ndarray, offsets: np.ndarray, quoted: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(template hash, value hash, type, capitalised at a sentence's start, first token of each text) for the tokens of a run of texts.

    A token is a word without its punctuation, in lower case; a word of punctuation only is none. A decimal
    point stays. Digits without letters are a number; a word of UNITS behind a number is a unit; a
    capitalised word that begins neither a sentence nor a line is a name. Digits run into letters are literal.
    `quoted` texts are read as they look inside another sentence: their first word may be a name.
    """
    starts, ends, _ = ragged.words(data, offsets)
    digit, letter, capital = _DIGIT[data], _LETTER[data], _capital(data)
    keep = digit | letter
    if len(data) > 2:
        keep[1:-1] |= (data[1:-1] == 0x2E) & digit[:-2] & digit[2:]
    lower = _LOWER[data]
    second = np.zeros(len(data), dtype=bool)
    second[1:] = capital[:-1] & (data[:-1] == 0xC3)
    lower[second] += 0x20
    kept_before = np.r_[0, np.cumsum(keep)]
    breaks_before = np.r_[0, np.cumsum(data == 0x0A)]
    text = np.searchsorted(offsets, starts, side="right") - 1
    opens = np.ones(len(starts), dtype=bool)
    opens[1:] = (
        (text[1:] != text[:-1]) | _SENTENCE_END[data[ends[:-1] - 1]] | (breaks_before[starts[1:]] > breaks_before[ends[:-1]])
    )
    if quoted:
        opens &= np.r_[False, text[1:] == text[:-1]] if len(text) else opens
    a, b = kept_before[starts], kept_before[ends]
    real = b > a
    a, b, text, opens = a[real], b[real], text[real], opens[real]
    value = ragged.SliceHash(lower[keep])(a, b)
    sums = lambda flags: np.r_[0, np.cumsum(flags[keep])]
    digits, letters = sums(digit), sums(letter)
    number = (digits[b] > digits[a]) & (letters[b] == letters[a])
    kind = np.full(len(a), LITERAL, dtype=np.int8)
    kind[capital[keep][a] & ~opens] = NAME
    kind[number] = NUMBER
    behind = np.zeros(len(a), dtype=bool)
    behind[1:] = number[:-1] & (text[1:] == text[:-1])
    kind[behind & np.isin(value, unit_hashes())] = UNIT
    opening = capital[keep][a] & opens
    return templates_of(value, kind), value, kind, opening, np.searchsorted(text, np.arange(len(offsets)))


def templates_of(value: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return np.where(kind == LITERAL, value, ragged.mixed(kind.astype(np.uint64) + np.uint64(0xABCDEF)))


def unit_hashes() -> np.ndarray:
    data = np.frombuffer("".join(UNITS).encode(), dtype=np.uint8)
    ends = np.cumsum([len(u) for u in UNITS])
    return ragged.SliceHash(data)(np.r_[0, ends[:-1]], ends)


def promoted(value: np.ndarray, kind: np.ndarray, opening: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Other readings of `kind`: capitalised words that open a sentence are names where the same word is a name of their text.

    All of them, the even and the odd ones: with `kind` itself, any choice among two in one window.
    """
    own = ragged.mixed(value ^ ragged.mixed(np.repeat(np.arange(1, len(first), dtype=np.uint64), np.diff(first))))
    chosen = np.flatnonzero(opening & (kind == LITERAL))
    chosen = chosen[np.isin(own[chosen], own[kind == NAME])]
    found = []
    for part in (chosen, chosen[::2], chosen[1::2]):
        if len(part):
            found.append(kind.copy())
            found[-1][part] = NAME
    return found


def exact_windows(value: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """As ragged.windows; the hashes differ from those of templates and of other sizes."""
    hashes, at = ragged.windows(value, first, size)
    return ragged.mixed(hashes ^ np.uint64(0x5851F42D4C957F2D + size)), at


def template_windows(
    work: DataFrame, t: Templates, bits: np.ndarray | None = None, readings: tuple[bool, ...] = (False,),
    sizes: tuple[int, ...] | None = None,
) -> DataFrame:
    """Template windows and exact windows (with empty _slots): _doc, _version, _at, _hash, _slots, _tokens for each window of the texts in `work`.

    _slots has a value hash for each token, 0 for a literal; _tokens is the text's number of tokens.
    With `bits` only windows that the bit map holds come out. `readings` are the values of `quoted` to use.
    Exact windows have the given `sizes`; without them, `t.window` or the whole of a shorter text. Of one that
    is shorter than `t.window` only the first in a text comes out.
    """
    schema = T.StructType([
        work.schema["_doc"], T.StructField("_version", T.LongType()), T.StructField("_at", T.IntegerType()),
        T.StructField("_hash", T.LongType()), T.StructField("_slots", T.ArrayType(T.LongType(), False)),
        T.StructField("_tokens", T.IntegerType()),
    ])
    shared = work.sparkSession.sparkContext.broadcast(bits) if bits is not None else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (rows, data, offsets), quoted in product(ragged.chunks(batch, "_text"), readings):
                value, kind, opening, first = tokens(data, offsets, quoted)[1:]
                own = batch.slice(rows.start, rows.stop - rows.start)
                for other in [kind, *promoted(value, kind, opening, first)]:
                    changed = np.r_[0, np.cumsum(other != kind)]
                    hashes, at = ragged.windows(templates_of(value, other), first, t.window)
                    literal = np.r_[0, np.cumsum(other == LITERAL)]
                    wanted = held(hashes) & (literal[at + t.window] - literal[at] >= t.literals)
                    if other is not kind:
                        wanted &= changed[at + t.window] > changed[at]
                    slots = np.where(other == LITERAL, np.uint64(0), value | np.uint64(1))
                    yield rows_of(own, first, hashes[wanted], at[wanted], slots)
                if quoted:
                    continue
                n_tokens = np.diff(first)
                for size in sizes if sizes is not None else range(1, t.window + 1):
                    hashes, at = exact_windows(value, first, size)
                    wanted = held(hashes)
                    text = np.searchsorted(first, at, side="right") - 1
                    if sizes is None and size < t.window:
                        wanted &= n_tokens[text] == size
                    hashes, at, text = hashes[wanted], at[wanted], text[wanted]
                    if size < t.window and len(at):
                        once = np.unique(ragged.mixed(hashes ^ ragged.mixed(text.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
                        hashes, at = hashes[once], at[once]
                    yield rows_of(own, first, hashes, at, None)

    def held(hashes: np.ndarray) -> np.ndarray:
        if shared is None:
            return np.ones(len(hashes), dtype=bool)
        place = (hashes >> np.uint64(64 - t.map_bits)).astype(np.int64)
        return (shared.value[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0

    def rows_of(own: pa.RecordBatch, first: np.ndarray, hashes: np.ndarray, at: np.ndarray, slots: np.ndarray | None) -> pa.RecordBatch:
        text = np.searchsorted(first, at, side="right") - 1
        width = 0 if slots is None else t.window
        flat = np.zeros(0, dtype=np.int64) if slots is None else slots[at[:, None] + np.arange(t.window)].ravel().view(np.int64)
        part = own.take(pa.array(text, pa.int64()))
        return pa.RecordBatch.from_arrays([
            part.column(0), part.column(1), pa.array((at - first[text]).astype(np.int32)), pa.array(hashes.view(np.int64)),
            pa.ListArray.from_arrays(pa.array((np.arange(len(at) + 1) * width).astype(np.int32)), pa.array(flat)),
            pa.array(np.diff(first)[text].astype(np.int32)),
        ], names=schema.names)

    return work.select("_doc", "_version", "_text").mapInArrow(cut, schema)


def bit_map(windows: DataFrame, t: Templates) -> np.ndarray:
    """One bit per window hash, 2 ** map_bits bits in all: 2 MB at the driver, whatever the benchmark."""
    place = F.shiftrightunsigned("_hash", 64 - t.map_bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    found = windows.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    bits = np.zeros(1 << (t.map_bits - 6), dtype=np.uint64)
    table = found.toArrow()
    bits[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return bits


def consistent(pairs: Column) -> Column:
    """No value of one side stands for two of the other, either way."""
    return (F.size(pairs) == F.size(F.array_distinct(F.transform(pairs, lambda p: p["item"])))) & (
        F.size(pairs) == F.size(F.array_distinct(F.transform(pairs, lambda p: p["doc"]))))


def leaks(
    docs: DataFrame, benchmark: DataFrame, templates: Templates | None = None, doc_id: str = "doc_id",
    text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, version (a hash of the text), item_id,
    n_windows, covered, item_tokens, changed_values, kind ('exact' or 're-parameterised').

    - Windows of a document and an item at one distance from each other are taken together; they
      count if their placeholders map consistently both ways. covered counts the item's tokens in them.
    - Where the placeholders at a distance contradict each other, exact windows count alone. changed_values is that of
      the distance which covers most.
    - An item with fewer tokens than a window is found where all its tokens stand in a row, in any case of letters: an item
      of one word is found wherever that word stands. A text without tokens is never found and finds nothing.
    - A null doc_id or item_id is an id like any other. Repeated documents are found once; rows that
      share a doc_id are told apart by their texts. Other columns are left aside. Empty tables give no rows.

    Only windows that the bit map holds leave the tasks that read documents, so what is shuffled is what
    was leaked, and chance hits. The join is on window hashes, of which the benchmark's side has few rows each.
    """
    t = templates or Templates()
    items = isolate(benchmark, doc=item_id, text=item_text).withColumn("_version", F.xxhash64("_text"))
    # a document may quote an item inside a sentence
    asked = settle(template_windows(items, t, readings=(False, True)))
    work = isolate(docs, doc=doc_id, text=text).withColumn("_version", F.xxhash64("_text"))
    exact = F.size("_slots") == 0
    # at most `window` numbers
    sizes = asked.where(exact).select(F.least("_tokens", F.lit(t.window)).alias("n")).distinct().collect()
    seen = template_windows(work, t, bit_map(asked, t), sizes=tuple(sorted(r.n for r in sizes)))
    asked = asked.select(
        F.col("_doc").alias("_item"), F.col("_version").alias("_item_version"), F.col("_at").alias("_item_at"), "_hash",
        F.col("_slots").alias("_item_slots"), F.col("_tokens").alias("_item_tokens"),
    )
    pairs = F.filter(
        F.zip_with("_item_slots", "_slots", lambda i, d: F.struct(i.alias("item"), d.alias("doc"))), lambda p: p["item"] != 0
    )
    whole = ["_doc", "_version", "_item", "_item_version", "_item_tokens"]
    lanes = seen.join(asked, "_hash").withColumn("_pairs", pairs).groupBy(*whole, F.col("_at") - F.col("_item_at")).agg(
        F.collect_set("_item_at").alias("_all"), F.collect_set(F.when(exact, F.col("_item_at"))).alias("_exact"),
        F.array_distinct(F.flatten(F.collect_set("_pairs"))).alias("_pairs"),
    )
    lanes = lanes.withColumn("_agree", consistent(F.col("_pairs"))).select(
        *whole, F.when(F.col("_agree"), F.col("_all")).otherwise(F.col("_exact")).alias("_places"),
        F.when(F.col("_agree"), F.size(F.filter("_pairs", lambda p: p["item"] != p["doc"]))).otherwise(0).alias("_changed"),
    ).where(F.size("_places") > 0)
    reached = lambda places: F.array_distinct(F.flatten(F.transform(
        places, lambda p: F.sequence(p, F.least(p + t.window, F.col("_item_tokens")) - 1))))
    found = lanes.withColumn("_cover", F.size(reached(F.col("_places")))).groupBy(*whole).agg(
        F.array_distinct(F.flatten(F.collect_set("_places"))).alias("_places"),
        F.min(F.struct((-F.col("_cover")).alias("cover"), F.col("_changed").alias("changed"))).alias("_most"),
    ).select(
        *whole, F.size("_places").cast("long").alias("n_windows"), F.size(reached(F.col("_places"))).cast("long").alias("covered"),
        F.col("_most.changed").cast("long").alias("changed_values"),
    ).where(F.col("covered") >= F.least(F.col("_item_tokens"), F.lit(t.covered)))
    return found.select(
        F.col("_doc").alias(doc_id), F.col("_version").alias("version"), F.col("_item").alias(item_id), "n_windows", "covered",
        F.col("_item_tokens").cast("long").alias("item_tokens"), "changed_values",
        F.when(F.col("changed_values") == 0, "exact").otherwise("re-parameterised").alias("kind"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, templates: Templates | None = None) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, unchanged."""
    bad = leaks(docs, benchmark, templates).select(
        F.col("doc_id").alias("_bad"), F.col("version").alias("_bad_version")
    ).distinct()
    work = isolate(docs, doc="doc_id", text="text").withColumn("_version", F.xxhash64("_text"))
    same = F.col("_doc").eqNullSafe(F.col("_bad")) & (F.col("_version") == F.col("_bad_version"))
    return restore(work.join(bad, same, "left_anti"), docs.columns, {"doc": "doc_id", "text": "text"})


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("version")
