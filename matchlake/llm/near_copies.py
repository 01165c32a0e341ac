"""N-gram Jaccard join with Bayesian pruning of candidates.

Documents with the same set of word shingles are one class. Classes that share a MinHash band form
candidate clusters. Inside a cluster, MinHash values are compared step by step; a pair goes as soon
as the posterior probability that its similarity reaches the threshold falls below a tolerance. What
is left is verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from matchlake.llm import ragged
from matchlake.llm.columns import WHITE, isolate, restore, settle
from matchlake.llm.components import components


@dataclass(frozen=True)
class Join:
    """At the threshold 0.8 the bands miss a pair with probability (1 - 0.8 ** 5) ** 32 = 3e-6."""

    shingle_words: int = 5
    threshold: Fraction = Fraction(4, 5)
    bands: int = 32
    band_rows: int = 5
    # pruning: values compared at a time, at most, and the posterior probability to drop a pair at
    step: int = 16
    values: int = 128
    tolerance: float = 1e-8
    # shingles of one block of a cluster
    block_shingles: int = 500_000


@cache
def factors(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)


def min_hashes(shingles: np.ndarray, starts: np.ndarray, seed: int, n: int) -> np.ndarray:
    """(documents, n) least values; document k has the shingles starts[k]:starts[k + 1], at least one."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    result = np.empty((len(starts), n), dtype=np.uint32)
    for k, (a, b) in enumerate(zip(*factors(seed, n), strict=True)):
        result[:, k] = np.minimum.reduceat(short * a + b, starts) if len(starts) else 0
    return result


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): the distinct shingles of each text, sorted.

    A text with fewer words than a shingle has one shingle of all its words; one without words has none.
    """
    starts, ends, first = ragged.words(data, offsets)
    hashes = ragged.SliceHash(data)(starts, ends)
    found, at = ragged.windows(hashes, first, size)
    n_words = np.diff(first)
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        whole = np.array([
            np.bitwise_xor.reduce(ragged.mixed(hashes[first[k] : first[k + 1]] + np.arange(1, n_words[k] + 1, dtype=np.uint64)))
            for k in short
        ], dtype=np.uint64)
        found, at = np.r_[found, whole], np.r_[at, first[short]]
    text = np.searchsorted(first, at, side="right") - 1
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    return found[new], np.bincount(text[new], minlength=len(offsets) - 1)


def set_names(shingles: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
    """16 bytes that name each set of shingles; None for the empty set."""
    starts = np.cumsum(counts) - counts
    full = np.flatnonzero(counts)
    halves = [
        np.add.reduceat(ragged.mixed(shingles * np.uint64(odd) + np.uint64(1)), starts[full]) if len(full) else np.zeros(0, np.uint64)
        for odd in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
    ]
    names: list[bytes | None] = [None] * len(counts)
    both = np.stack([ragged.mixed(h) for h in halves], axis=1).astype(">u8") if len(full) else None
    for k, row in enumerate(full.tolist()):
        names[row] = both[k].tobytes()
    return names


def signatures(work: DataFrame, join: Join) -> DataFrame:
    """_doc, _version, _set, _size, _bands for each row of `work`, which has _doc, _version and _text."""
    schema = T.StructType([
        work.schema["_doc"], T.StructField("_version", T.LongType()), T.StructField("_set", T.BinaryType()),
        T.StructField("_size", T.LongType()), T.StructField("_bands", T.ArrayType(T.LongType(), False)),
    ])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in ragged.chunks(batch, "_text"):
                shingles, counts = shingle_sets(data, offsets, join.shingle_words)
                full = counts > 0
                values = min_hashes(shingles, (np.cumsum(counts) - counts)[full], 1, join.bands * join.band_rows)
                keys = np.broadcast_to(np.arange(join.bands, dtype=np.uint64), (len(values), join.bands)).copy()
                for k in range(join.band_rows):
                    keys = ragged.mixed(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, k :: join.band_rows])
                lengths = np.where(full, join.bands, 0)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pa.array(keys.ravel().view(np.int64))
                )
                part = batch.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(set_names(shingles, counts), pa.binary()), pa.array(counts.astype(np.int64)), bands],
                    names=schema.names,
                )

    return work.select("_doc", "_version", "_text").mapInArrow(sign, schema)


@cache
def least_matches(join: Join) -> tuple[int, ...]:
    """After each step: fewer equal values than this, and the pair goes.

    With a uniform prior the similarity after m equal values of n is Beta(m + 1, n - m + 1), and the
    probability that it is at least t is that of at most m successes in n + 1 trials at t.
    """
    t, found = float(join.threshold), []
    for n in range(join.step, join.values + 1, join.step):
        below, m = 0.0, -1
        while below < join.tolerance:
            m += 1
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        found.append(m)
    return tuple(found)


def linked(
    shingles: np.ndarray, counts: np.ndarray, side: np.ndarray, join: Join
) -> Iterator[tuple[int, np.ndarray]]:
    """(i, all j > i linked to i). Where `side` has two values, only pairs of different sides are compared."""
    _, local = np.unique(shingles, return_inverse=True)
    starts = np.cumsum(counts) - counts
    values = min_hashes(shingles, starts, 2, join.values)
    marks = np.zeros(int(local.max()) + 1, dtype=np.uint8)
    crossed = side.min() != side.max()
    least, t = least_matches(join), join.threshold
    for i in range(len(counts) - 1):
        others = np.arange(i + 1, len(counts))
        if crossed:
            others = others[side[others] != side[i]]
        small, large = np.minimum(counts[others], counts[i]), np.maximum(counts[others], counts[i])
        others = others[small * t.denominator >= large * t.numerator]
        equal = np.zeros(len(others), dtype=np.int64)
        for k, needed in enumerate(least):
            if not len(others):
                break
            part = slice(k * join.step, (k + 1) * join.step)
            equal += (values[others, part] == values[i, part]).sum(axis=1)
            stay = equal >= needed
            others, equal = others[stay], equal[stay]
        if not len(others):
            continue
        own = local[starts[i] : starts[i] + counts[i]]
        marks[own] = 1
        shared = np.zeros(len(others), dtype=np.int64)
        # in parts of bounded size
        upto = np.cumsum(counts[others])
        for a, b in parts(upto, 4_000_000):
            chosen = others[a:b]
            hits = marks[ragged.gather(local, starts[chosen], counts[chosen])]
            shared[a:b] = np.add.reduceat(hits, np.cumsum(counts[chosen]) - counts[chosen], dtype=np.int64)
        marks[own] = 0
        union = counts[i] + counts[others] - shared
        yield i, others[shared * t.denominator >= union * t.numerator]


def parts(upto: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes (given as running sums) add up to `size` or a little more."""
    a = 0
    while a < len(upto):
        base = upto[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(upto, base + size, side="right")))
        yield a, b
        a = b


FOUND = T.StructType([
    T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType()), T.StructField("links", T.LongType()),
])

FOUND_ARROW = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])


def verify(join: Join):  # noqa: ANN201
    def cell(table: pa.Table) -> pa.Table:
        """Link counts of a cell's classes, and a star over each set of linked ones."""
        blocks = table.column("_block").to_numpy()
        low, high = table.column("_low")[0].as_py(), table.column("_high")[0].as_py()
        # one of the two blocks may be empty; pairs inside the other one belong to its own cell
        if low != high and blocks.min() == blocks.max():
            return FOUND_ARROW.empty_table()
        names, first = np.unique(np.array(table.column("_set").to_pylist(), dtype=object), return_index=True)
        table = table.take(pa.array(first))
        blobs = table.column("_shingles").to_pylist()
        counts = np.array([len(b) // 8 for b in blobs], dtype=np.int64)
        shingles = np.frombuffer(b"".join(blobs), dtype="<u8")
        copies = table.column("_copies").to_numpy()
        links = np.zeros(len(names), dtype=np.int64)
        root = list(range(len(names)))

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for i, others in linked(shingles, counts, table.column("_block").to_numpy(), join):
            links[i] += copies[others].sum()
            links[others] += copies[i]
            for j in others.tolist():
                one, other = top(i), top(j)
                root[max(one, other)] = min(one, other)
        # names are sorted, so each star's middle is its least name
        edges = [(k, top(k)) for k in range(len(names)) if top(k) != k]
        some = np.flatnonzero(links)
        return pa.table({
            "a": pa.array([names[k] for k in some] + [names[j] for j, _ in edges], pa.binary()),
            "b": pa.array([None] * len(some) + [names[i] for _, i in edges], pa.binary()),
            "links": pa.array(links[some].tolist() + [0] * len(edges), pa.int64()),
        })

    return cell


def shingle_rows(texts: DataFrame, join: Join) -> DataFrame:
    """_shingles (binary) for each row whose text has the set `_set`; the text goes, the rest is carried."""
    keys = [f for f in texts.schema.fields if f.name != "_text"]
    schema = T.StructType([*keys, T.StructField("_shingles", T.BinaryType())])
    names = [f.name for f in keys]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in ragged.chunks(batch, "_text"):
                shingles, counts = shingle_sets(data, offsets, join.shingle_words)
                part = batch.slice(rows.start, rows.stop - rows.start)
                ends = np.cumsum(counts)
                wanted = part.column("_set").to_pylist()
                # another row may share the doc_id
                own = [k for k, name in enumerate(set_names(shingles, counts)) if name == wanted[k]]
                blobs = [shingles[ends[k] - counts[k] : ends[k]].astype("<u8").tobytes() for k in own]
                chosen = part.take(pa.array(own, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*[chosen.column(n) for n in names], pa.array(blobs, pa.binary())], names=schema.names
                )

    return texts.mapInArrow(split, schema)


def near_copies(
    docs: DataFrame, join: Join | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, version (a hash of the text), class_id, n_links, n_copies.

    n_copies counts the rows with the same set of shingles, itself included. n_links counts the other rows
    with a similarity of at least the threshold, copies included. class_id is the least doc_id of all that
    are linked, directly or over others.

    - A text without words (or null, or empty) is linked to nothing: its class_id is its doc_id.
    - A text of one to four words has one shingle of all of them.
    - Repeated rows and rows that share a doc_id are documents of their own. A null doc_id is no class_id
      where another doc_id is there.
    - Other columns are left aside. An empty table gives no rows.

    Copies collapse into classes before anything is compared, by partial sums. A cluster of candidates
    is split into blocks of `block_shingles`, and each pair of blocks is one group, so a cluster of any size
    is compared in bounded groups; only sums and spanning edges leave them, never pairs.
    """
    return _classed(docs, join or Join(), doc_id, text).drop("_class_set")


def _classed(docs: DataFrame, j: Join, doc_id: str, text: str) -> DataFrame:
    """What near_copies gives, and _class_set: the set that names the class, null for a text without words."""
    work = isolate(docs, doc=doc_id, text=text).select("_doc", F.xxhash64("_text").alias("_version"), "_text")
    signed = settle(signatures(work, j))
    classes = settle(signed.where(F.col("_set").isNotNull()).groupBy("_set", "_bands", "_size").agg(
        F.min("_doc").alias("_least"), F.count(F.lit(1)).alias("_copies")
    ))
    banded = classes.select("_set", F.explode("_bands").alias("_band"))
    heads = banded.groupBy("_band").agg(F.min("_set").alias("_head"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    candidates = banded.join(heads, "_band").select(F.col("_set").alias("a"), F.col("_head").alias("b"))
    found_in = components(candidates)
    clusters = found_in.unionByName(found_in.select(F.col("root").alias("node"), "root").distinct())
    inside = classes.join(clusters, F.col("_set") == F.col("node")).select("_set", "_size", "_least", "_copies", "root")
    sizes = inside.groupBy("root").agg(F.ceil(F.sum("_size") / j.block_shingles).cast("int").alias("_blocks"))
    placed = inside.join(sizes, "root").withColumn("_block", F.pmod(F.xxhash64("_set"), F.col("_blocks")).cast("int"))
    texts = work.select(F.col("_doc"), "_text").join(
        placed.drop("_size"), F.col("_doc").eqNullSafe(F.col("_least"))
    ).select("_set", "_copies", "root", "_blocks", "_block", "_text")
    cells = shingle_rows(texts, j).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cells = cells.select(
        "root", F.least("_block", "_other").alias("_low"), F.greatest("_block", "_other").alias("_high"),
        "_set", "_copies", "_block", "_shingles",
    )
    found = settle(cells.groupBy("root", "_low", "_high").applyInArrow(verify(j), FOUND))
    links = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("_set")).agg(F.sum("links").alias("_links"))
    groups = components(found.where(F.col("b").isNotNull()).select("a", "b"))
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    named = groups.join(classes.select(F.col("_set").alias("node"), "_least"), "node")
    leaders = named.groupBy("root").agg(F.min("_least").alias("_leader"))
    of_group = named.join(leaders, "root").select(F.col("node").alias("_set"), "_leader", "root")
    told = classes.select("_set", "_least", "_copies").join(links, "_set", "left").join(of_group, "_set", "left").select(
        "_set", F.coalesce("root", "_set").alias("_class_set"), F.coalesce("_leader", "_least").alias("_class"),
        (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("_all_links"), "_copies",
    )
    result = signed.select("_doc", "_version", "_set").join(told, "_set", "left")
    return result.select(
        F.col("_doc").alias(doc_id), F.col("_version").alias("version"),
        F.when(F.col("_set").isNull(), F.col("_doc")).otherwise(F.col("_class")).alias("class_id"),
        F.coalesce("_all_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("_copies", F.lit(1)).cast("long").alias("n_copies"), "_class_set",
    )


def keep_one(docs: DataFrame, join: Join | None = None) -> DataFrame:
    """The rows of `docs` without all but one document of each class: one whose doc_id is least, and among
    those the one with the least version.

    Classes are told apart by their texts: unlike texts under one repeated or null doc_id all stay. Texts
    without words (or null, or empty) are no copies of anything and all stay.
    """
    keepers = _classed(docs, join or Join(), "doc_id", "text").where(
        F.col("_class_set").isNotNull() & F.col("doc_id").eqNullSafe(F.col("class_id"))
    ).groupBy("_class_set").agg(F.min("doc_id").alias("_keep"), F.min("version").alias("_keep_version")).drop("_class_set")
    work = isolate(docs, doc="doc_id", text="text").withColumn("_version", F.xxhash64("_text"))
    wordless = F.coalesce(F.btrim("_text", F.lit(WHITE)) == "", F.lit(True))
    same: Column = F.col("_doc").eqNullSafe(F.col("_keep")) & (F.col("_version") == F.col("_keep_version"))
    once = Window.partitionBy("_doc", "_version").orderBy("_doc")
    kept = work.where(~wordless).join(keepers, same, "left_semi").withColumn("_nth", F.row_number().over(once)).where("_nth = 1")
    kept = kept.drop("_nth").unionByName(work.where(wordless))
    return restore(kept, docs.columns, {"doc": "doc_id", "text": "text"})


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("version")
