"""Suffix-array dedup: bytes covered by a long string that also starts earlier are removed.

A logarithmic family of sorted suffix arrays is kept. Texts come in batches; each gets a suffix
array, which is merge-scanned against the arrays already there, and arrays of equal size merge, so
each suffix is merged a logarithmic number of times. The arrays are sparse: a suffix is taken where
the least hash of a 32-byte string in some window of `length` bytes lies. The choice depends on
the window's bytes alone, so two equal windows name suffixes at the same place in them, and no
match of `length` bytes is missed although only about one suffix in 35 is stored.

One family lives in each task that reads texts, and one in each task that takes a slice of the
suffixes from all of them. Suffixes with equal surroundings are settled by the merge. Those which only
share a beginning are few; the bytes around them are fetched, and they are settled window by
window. Those whose beginning is very common go through a Spark aggregate of window hashes instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm import ragged
from matchlake.llm.columns import isolate, restore
from matchlake.session import new_scratch

# bytes of a suffix that choose and sort it; a power of two
HEAD = 32
_BYTE32 = np.random.default_rng(7).integers(0, 2**32, 256, dtype=np.uint32)
NULL_DOC = -(2**63)
# begin: the first eight bytes; head: a hash of the first HEAD bytes; around: one of all bytes of the windows
NAMES = ("begin", "head", "around", "doc", "version", "place", "left", "more")
TYPES = ("u8", "u8", "u8", "i8", "i4", "i4", "u2", "u2")


@dataclass(frozen=True)
class Matching:
    length: int = 100
    # bytes of text whose suffixes a task merges before it sends them on
    held_bytes: int = 16 << 20
    # a beginning with more surroundings than this in one such batch, or in one slice, is very common
    common_in_batch: int = 64
    common_in_slice: int = 20_000


class Suffixes:
    """A sparse suffix array: columns sorted by the suffix, its surroundings, document and place.

    Suffixes are sorted by their first eight bytes and then by a hash of the first HEAD. doc, version and
    place say where the first window starts; `left` bytes later the suffix starts; `more` further windows
    start right behind the first.
    """

    def __init__(self, columns: dict[str, np.ndarray]) -> None:
        self.columns = columns

    def __len__(self) -> int:
        return len(self.columns["doc"])

    def __getitem__(self, name: str) -> np.ndarray:
        return self.columns[name]

    def take(self, rows: np.ndarray) -> Suffixes:
        return Suffixes({k: v[rows] for k, v in self.columns.items()})

    def ordered(self) -> Suffixes:
        c = self.columns
        return self.take(np.lexsort((c["version"], c["place"], c["doc"], c["around"], c["head"], c["begin"])))

    def runs(self, *names: str) -> np.ndarray:
        """Where a new value of these columns begins, in order."""
        new = np.zeros(len(self), dtype=bool)
        new[:1] = True
        for name in names:
            new[1:] |= self[name][1:] != self[name][:-1]
        return np.flatnonzero(new)


def joined(parts: list[Suffixes]) -> Suffixes:
    return Suffixes({k: np.concatenate([p[k] for p in parts]) for k in NAMES})


def scan(both: Suffixes) -> tuple[Suffixes, Suffixes]:
    """(stay, repeated) of a sorted array.

    Of suffixes with equal surroundings the earliest stays; what starts later is repeated. Equal
    places of two texts under one doc_id are not later than each other, so both stay.
    """
    if not len(both):
        return both, both
    starts = both.runs("begin", "head", "around")
    leader = np.repeat(starts, np.diff(np.r_[starts, len(both)]))
    later = (both["doc"] != both["doc"][leader]) | (both["place"] != both["place"][leader])
    twin = ~later & (both["version"] == both["version"][leader])
    twin[starts] = False
    return both.take(np.flatnonzero(~later & ~twin)), both.take(np.flatnonzero(later))


class Family:
    """Sorted arrays of falling size. A new one is merged with all that are not larger than it."""

    def __init__(self) -> None:
        self.levels: list[Suffixes] = []

    def add(self, batch: Suffixes) -> Suffixes:
        """Takes a sorted batch; returns what the merge scan shows to be repeated."""
        found = []
        batch, repeated = scan(batch)
        found.append(repeated)
        while self.levels and len(self.levels[-1]) <= 2 * len(batch):
            batch, repeated = scan(joined([self.levels.pop(), batch]).ordered())
            found.append(repeated)
        self.levels.append(batch)
        return joined(found)

    def close(self) -> tuple[Suffixes, Suffixes]:
        """(all that stay, repeated): the levels merged into one."""
        found = []
        while len(self.levels) > 1:
            one, other = self.levels.pop(), self.levels.pop()
            merged, repeated = scan(joined([one, other]).ordered())
            found.append(repeated)
            self.levels.append(merged)
        stay = self.levels.pop() if self.levels else empty()
        return stay, joined(found) if found else empty()


def empty() -> Suffixes:
    return Suffixes({k: np.zeros(0, dtype=t) for k, t in zip(NAMES, TYPES, strict=True)})


def sampled(
    data: np.ndarray, offsets: np.ndarray, docs: np.ndarray, versions: np.ndarray, length: int
) -> Suffixes:
    """The suffixes of a run of texts that windows of `length` bytes name, in text order."""
    lengths = np.diff(offsets)
    if not (lengths >= length).any():
        return empty()
    span = length - HEAD + 1
    hashed = _BYTE32[data]
    step, factor = 1, np.uint32(0x01000193)
    while step < HEAD:
        hashed = hashed[:-step] * factor + hashed[step:]
        factor = np.uint32(int(factor) ** 2 % 2**32)
        step *= 2
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x2C1B3C6D)
    hashed ^= hashed >> np.uint32(13)
    least = (hashed.astype(np.uint64) << np.uint64(32)) | np.arange(len(hashed), dtype=np.uint64)
    step = 1
    while 2 * step <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < span:
        least = np.minimum(least[: len(least) - (span - step)], least[span - step :])
    suffix = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # windows start where `length` bytes of the same text follow
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    long = lengths >= length
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - length + 1, -1)
    valid = np.cumsum(inside[: len(suffix)]).astype(bool)
    change = np.ones(len(suffix), dtype=bool)
    change[1:] = (suffix[1:] != suffix[:-1]) | ~valid[:-1]
    first = np.flatnonzero(valid & change)
    ends = np.ones(len(suffix), dtype=bool)
    ends[:-1] = change[1:] | ~valid[1:]
    last = np.flatnonzero(valid & ends)
    suffix = suffix[first]
    text = np.searchsorted(offsets, first, side="right") - 1
    left = suffix - first
    begin = np.ascontiguousarray(data[suffix[:, None] + np.arange(8)]).view(">u8")[:, 0]
    slice_hash = ragged.SliceHash(data)
    around = slice_hash(first, last + length)
    around = ragged.mixed(around ^ (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    values = (
        begin, slice_hash(suffix, suffix + HEAD), around, docs[text], versions[text], first - offsets[text], left, last - first,
    )
    return Suffixes({k: np.ascontiguousarray(v, dtype=t) for k, t, v in zip(NAMES, TYPES, values, strict=True)})


def window_hashes(left: np.ndarray, more: np.ndarray, context: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number of the window in its row, hash) of all windows; `context` has the rows' bytes in turn."""
    counts = more.astype(np.int64) + 1
    sizes = counts - 1 + length
    starts = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[row] + nth
    hashes = ragged.SliceHash(context)(at, at + length)
    return row, nth, ragged.mixed(hashes + (left[row].astype(np.int64) - nth).astype(np.uint64))


SENT = T.StructType([T.StructField("_slice", T.IntegerType()), T.StructField("_kind", T.IntegerType()), T.StructField("_data", T.BinaryType())])
INDEX, SPANS, OPEN, COMMON, CONTEXTS, WINDOWS = range(6)
SPAN_TYPES = ("i8", "i4", "i4", "i4")
# doc, version, place, left, more, head, whether its head is very common
OPEN_TYPES = ("i8", "i4", "i4", "u2", "u2", "u8", "u1")
# doc, version, place, hash of the window, head
WINDOW_TYPES = ("i8", "i4", "i4", "u8", "u8")
_MERGED_FIELDS = (
    ("_doc", T.LongType()), ("_version", T.IntegerType()), ("_start", T.IntegerType()), ("_end", T.IntegerType()),
    ("_left", T.IntegerType()), ("_more", T.IntegerType()), ("_head", T.LongType()), ("_common", T.BooleanType()),
)
# a span, or (with _head) a suffix that is still open
MERGED = T.StructType([T.StructField(n, t) for n, t in _MERGED_FIELDS])
# a span, or (with _hash) a window
SETTLED = T.StructType([
    *MERGED.fields[:4], T.StructField("_hash", T.LongType()), T.StructField("_head", T.LongType()),
])


def packed(arrays: list[np.ndarray], types: tuple[str, ...], extra: bytes = b"") -> bytes:
    """Columns and further bytes, compressed."""
    body = b"".join(np.ascontiguousarray(a, dtype=t).tobytes() for a, t in zip(arrays, types, strict=True))
    return len(arrays[0]).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(body + extra)


def unpacked(blob: bytes, types: tuple[str, ...]) -> tuple[list[np.ndarray], bytes]:
    n, body, at, arrays = int.from_bytes(blob[:8], "little"), zstandard.ZstdDecompressor().decompress(blob[8:]), 0, []
    for t in types:
        arrays.append(np.frombuffer(body, dtype=t, count=n, offset=at))
        at += n * np.dtype(t).itemsize
    return arrays, body[at:]


def sent(rows: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(rows), 64):
        part = rows[k : k + 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in part], t) for c, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=SENT.names
        )


def by_slice(slice_of: np.ndarray, kind: int, arrays: list[np.ndarray], types: tuple[str, ...]) -> list[tuple[int, int, bytes]]:
    """One packed row for each slice that has entries, which keep their order."""
    order = np.argsort(slice_of, kind="stable")
    ends = np.flatnonzero(np.r_[slice_of[order][1:] != slice_of[order][:-1], True]) + 1 if len(order) else []
    rows, a = [], 0
    for b in ends:
        rows.append((int(slice_of[order[a]]), kind, packed([x[order[a:b]] for x in arrays], types)))
        a = b
    return rows


def out(schema: T.StructType, **columns: np.ndarray) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    types = {f.name: t for f, t in zip(schema.fields, map(arrow_type, schema.fields), strict=True)}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], types[c]) if c in columns else pa.nulls(n, types[c]) for c in schema.names], names=schema.names
    )


def arrow_type(field: T.StructField) -> pa.DataType:
    return {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.BooleanType(): pa.bool_()}[field.dataType]


def out_spans(schema: T.StructType, columns: list[np.ndarray]) -> pa.RecordBatch:
    return out(schema, **dict(zip(("_doc", "_version", "_start", "_end"), columns, strict=True)))


def spans(s: Suffixes, length: int) -> list[np.ndarray]:
    """(doc, version, start, end) of what the repeated suffixes cover, overlaps of one text joined."""
    order = np.lexsort((s["place"], s["version"], s["doc"]))
    doc, version, start = s["doc"][order], s["version"][order], s["place"][order]
    end = start + s["more"][order].astype(np.int32) + length
    return joined_spans(doc, version, start.astype(np.int64), end.astype(np.int64))


def joined_spans(doc: np.ndarray, version: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Joins overlapping and touching spans, which come sorted by doc, version and start."""
    if not len(doc):
        return [np.zeros(0, dtype=t) for t in SPAN_TYPES]
    text = np.cumsum(np.r_[False, (doc[1:] != doc[:-1]) | (version[1:] != version[:-1])])
    reach = np.maximum.accumulate(text * (1 << 33) + end)
    new = np.r_[True, text[1:] * (1 << 33) + start[1:] > reach[:-1]]
    first = np.flatnonzero(new)
    last = np.r_[first[1:] - 1, len(doc) - 1]
    return [doc[first], version[first], start[first].astype(np.int32), (reach[last] - text[last] * (1 << 33)).astype(np.int32)]


class Sender:
    """The family of one task that reads texts."""

    def __init__(self, slices: int, m: Matching) -> None:
        self.slices, self.m = slices, m
        self.clear()

    def clear(self) -> None:
        self.family, self.repeated, self.bytes = Family(), [], 0

    def add(self, data: np.ndarray, offsets: np.ndarray, docs: np.ndarray, versions: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.repeated.append(self.family.add(sampled(data, offsets, docs, versions, self.m.length).ordered()))
        self.bytes += len(data)
        if self.bytes >= self.m.held_bytes:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.repeated:
            return
        stay, repeated = self.family.close()
        covered = spans(joined([*self.repeated, repeated]), self.m.length)
        rows = by_slice(self._of_text(covered[0], covered[1]), SPANS, covered, SPAN_TYPES)
        if len(stay):
            starts = stay.runs("begin", "head")
            sizes = np.diff(np.r_[starts, len(stay)])
            slice_of = (stay["head"] % np.uint64(self.slices)).astype(np.int64)
            # the slice hears that a head is very common, but its suffixes go elsewhere
            often = np.flatnonzero(np.repeat(sizes > self.m.common_in_batch, sizes))
            told = starts[sizes > self.m.common_in_batch]
            rows += by_slice(slice_of[told], COMMON, [stay["head"][told]], ("u8",))
            some = stay.take(often)
            rows += by_slice(
                self._of_text(some["doc"], some["version"]), OPEN,
                [*[some[c] for c in ("doc", "version", "place", "left", "more", "head")], np.ones(len(some), dtype="u1")], OPEN_TYPES,
            )
            rest = np.setdiff1d(np.arange(len(stay)), often, assume_unique=True)
            rows += by_slice(slice_of[rest], INDEX, [stay[c][rest] for c in NAMES], TYPES)
        self.clear()
        yield from sent(rows)

    def _of_text(self, docs: np.ndarray, versions: np.ndarray) -> np.ndarray:
        mixed = ragged.mixed(docs.astype(np.uint64) ^ versions.astype(np.uint64))
        return (mixed % np.uint64(self.slices)).astype(np.int64)


class Merger:
    """The family of one task that takes a slice of the suffixes."""

    def __init__(self, m: Matching) -> None:
        self.m, self.family = m, Family()
        self.common: list[np.ndarray] = []

    def take(self, kind: int, blob: bytes) -> Iterator[pa.RecordBatch]:
        if kind == SPANS:
            yield out_spans(MERGED, unpacked(blob, SPAN_TYPES)[0])
        elif kind == OPEN:
            yield self._open(*unpacked(blob, OPEN_TYPES)[0])
        elif kind == COMMON:
            self.common.append(unpacked(blob, ("u8",))[0][0])
        else:
            batch = Suffixes(dict(zip(NAMES, unpacked(blob, TYPES)[0], strict=True)))
            yield out_spans(MERGED, spans(self.family.add(batch), self.m.length))

    @staticmethod
    def _open(*columns: np.ndarray) -> pa.RecordBatch:
        doc, version, place, left, more, head, common = columns
        return out(
            MERGED, _doc=doc, _version=version, _start=place, _left=left.astype(np.int32), _more=more.astype(np.int32),
            _head=head.view(np.int64), _common=common.astype(bool),
        )

    def close(self) -> Iterator[pa.RecordBatch]:
        stay, repeated = self.family.close()
        yield out_spans(MERGED, spans(repeated, self.m.length))
        if not len(stay):
            return
        starts = stay.runs("begin", "head")
        sizes = np.diff(np.r_[starts, len(stay)])
        common = np.repeat(sizes > self.m.common_in_slice, sizes)
        if self.common:
            common |= np.isin(stay["head"], np.concatenate(self.common))
        some = np.flatnonzero(np.repeat(sizes > 1, sizes) | common)
        yield self._open(*[stay[c][some] for c in ("doc", "version", "place", "left", "more", "head")], common[some])


def fetched(keys: np.ndarray, texts: pa.Array, opened: pa.Array, slices: int, m: Matching) -> list[tuple[int, int, bytes]]:
    """Packed rows of one batch of texts: the bytes around open suffixes, or windows of very common ones."""
    lists = opened.offsets.to_numpy() - opened.offsets[0].as_py()
    flat = opened.flatten()
    own = np.repeat(np.arange(len(texts)), np.diff(lists))
    place, left, more = (flat.field(c).to_numpy().astype(np.int64) for c in ("_start", "_left", "_more"))
    head = flat.field("_head").to_numpy().view(np.uint64)
    common = flat.field("_common").to_numpy(zero_copy_only=False)
    whole = texts.cast(pa.large_string())
    bounds = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2], dtype=np.uint8)
    sizes = more + m.length
    doc, version = keys[0][own], keys[1][own]
    rows = []
    few = np.flatnonzero(~common)
    slice_of = (head % np.uint64(slices)).astype(np.int64)
    few = few[np.argsort(slice_of[few], kind="stable")]
    cuts = np.searchsorted(slice_of[few], np.arange(slices + 1))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        of = few[cuts[k] : cuts[k + 1]]
        context = ragged.gather(data, bounds[own[of]] + place[of], sizes[of])
        columns = [doc[of], version[of], place[of], left[of], more[of], head[of], np.zeros(len(of))]
        rows.append((k, CONTEXTS, packed(columns, OPEN_TYPES, context.tobytes())))
    many = np.flatnonzero(common)
    for a in range(0, len(many), 10_000):
        of = many[a : a + 10_000]
        context = ragged.gather(data, bounds[own[of]] + place[of], sizes[of])
        row, nth, hashes = window_hashes(left[of], more[of], context, m.length)
        columns = [doc[of][row], version[of][row], place[of][row] + nth, hashes, head[of][row]]
        rows.append((int(hashes[0] % np.uint64(slices)), WINDOWS, packed(columns, WINDOW_TYPES)))
    return rows


def settled(opened: list[list[np.ndarray]], contexts: list[bytes], m: Matching) -> Iterator[pa.RecordBatch]:
    """Spans of the windows that start later than an equal one, over all suffixes that share a head."""
    if not opened:
        return
    doc, version, place, left, more, head, _ = (np.concatenate(c) for c in zip(*opened, strict=True))
    sizes = more.astype(np.int64) + m.length
    context, starts = np.frombuffer(b"".join(contexts), dtype=np.uint8), np.cumsum(sizes) - sizes
    order = np.argsort(head, kind="stable")
    new_head = np.flatnonzero(np.r_[True, head[order][1:] != head[order][:-1]])
    # whole heads at a time, so many that their windows fit in memory
    before = np.r_[0, np.cumsum(more[order].astype(np.int64) + 1)]
    a = 0
    while a < len(order):
        fits = np.searchsorted(before[new_head], before[a] + 300_000, side="right") - 1
        b = int(new_head[fits]) if new_head[fits] > a else int(np.r_[new_head, len(order)][np.searchsorted(new_head, a, side="right")])
        if before[-1] - before[a] <= 300_000:
            b = len(order)
        rows = order[a:b]
        a = b
        row, nth, hashes = window_hashes(left[rows], more[rows], ragged.gather(context, starts[rows], sizes[rows]), m.length)
        d, v, p, h = doc[rows][row], version[rows][row], place[rows][row] + nth, head[rows][row]
        sort = np.lexsort((p, d, hashes, h))
        new = np.ones(len(sort), dtype=bool)
        new[1:] = (hashes[sort][1:] != hashes[sort][:-1]) | (h[sort][1:] != h[sort][:-1])
        leads = np.flatnonzero(new)
        leader = sort[np.repeat(leads, np.diff(np.r_[leads, len(sort)]))]
        later = sort[(d[sort] != d[leader]) | (p[sort] != p[leader])]
        later = later[np.lexsort((p[later], v[later], d[later]))]
        yield out_spans(SETTLED, joined_spans(d[later], v[later], p[later], p[later] + m.length))


def repeated_spans(docs: DataFrame, placed: DataFrame, matching: Matching | None = None) -> DataFrame:
    """(_doc, _version, _start, _end) of what is repeated in `docs`, which has the columns _doc (long, not
    null), _version and _text (not null) and any others. `placed` is `docs` partitioned by _doc and _version."""
    m = matching or Matching()
    slices = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(slices, m)
        for batch in batches:
            keys, versions = (batch.column(k).to_numpy() for k in (0, 1))
            for rows, data, offsets in ragged.chunks(batch, "_text"):
                yield from sender.add(data, offsets, keys[rows], versions[rows])
        yield from sender.flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(m)
        for batch in batches:
            for kind, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                yield from merger.take(kind, blob)
        yield from merger.close()

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, len(batch) * ragged.CHUNK_BYTES // max(1, batch.nbytes))
            for k in range(0, len(batch), step):
                part = batch.slice(k, step)
                yield from sent(fetched((part.column(0).to_numpy(), part.column(1).to_numpy()), part.column(2), part.column(3), slices, m))

    def settle_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, contexts = [], []
        for batch in batches:
            for kind, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if kind == CONTEXTS:
                    columns, context = unpacked(blob, OPEN_TYPES)
                    opened.append(columns)
                    contexts.append(context)
                else:
                    doc, version, place, hashes, head = unpacked(blob, WINDOW_TYPES)[0]
                    yield out(SETTLED, _doc=doc, _version=version, _start=place, _hash=hashes.view(np.int64), _head=head.view(np.int64))
        yield from settled(opened, contexts, m)

    work = docs.select("_doc", "_version", "_text")
    merged = work.mapInArrow(send, SENT).repartitionById(slices, F.col("_slice")).mapInArrow(merge, MERGED)
    # read twice below
    path = new_scratch(docs.sparkSession, "suffix-spans")
    merged.write.parquet(path)
    merged = docs.sparkSession.read.schema(MERGED).parquet(path)
    still = F.struct("_start", "_left", "_more", "_head", "_common")
    opened = merged.where(F.col("_head").isNotNull()).groupBy("_doc", "_version").agg(F.collect_list(still).alias("_open"))
    texts = placed.join(opened, ["_doc", "_version"]).select("_doc", "_version", "_text", "_open", *[c for c in docs.columns if c not in work.columns])
    done = texts.mapInArrow(fetch, SENT).repartitionById(slices, F.col("_slice")).mapInArrow(settle_, SETTLED)
    windows = done.where(F.col("_hash").isNotNull())
    place = F.struct("_doc", "_start")
    firsts = windows.groupBy("_hash", "_head").agg(F.min(place).alias("_first"))
    later = windows.join(firsts, ["_hash", "_head"]).where(place > F.col("_first")).select(
        "_doc", "_version", "_start", (F.col("_start") + m.length).alias("_end")
    )
    columns = ["_doc", "_version", "_start", "_end"]
    return merged.where(F.col("_head").isNull()).select(*columns).unionByName(
        done.where(F.col("_hash").isNull()).select(*columns)).unionByName(later)


def drop_repeats(
    docs: DataFrame, matching: Matching | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` with kept (binary: the bytes that stay), n_bytes, n_removed and n_spans added.

    A byte goes if a string of `length` bytes that covers it also starts earlier: in a smaller doc_id, or
    earlier in the same document. Strings are judged on the input, overlaps count, and no string
    reaches over the end of a document.

    - Null or empty text: no bytes. Null doc_id: one document, smaller than all others.
    - Rows that share a doc_id are one document: of two equal strings at the same place in two such rows
      neither is earlier, so repeated rows do not remove each other.
    - Extra columns are carried; columns named as a result are replaced. An empty table gives no rows.

    A task holds the suffixes of `held_bytes` of text; then a slice of all suffixes, as many slices as
    spark.sql.shuffle.partitions says. Copies collapse in the first family, so a group of copies sends one
    suffix per task and place. Texts are shuffled once, by document; both joins read that shuffle.
    """
    m = matching or Matching()
    work = isolate(docs, doc=doc_id, text=text)
    work = work.select(
        F.coalesce(F.col("_doc").cast("long"), F.lit(NULL_DOC)).alias("_doc"), F.hash("_text").alias("_version"),
        F.coalesce("_text", F.lit("")).alias("_text"), F.col("_doc").alias("_key"), F.col("_text").isNull().alias("_none"), "_row",
    )
    placed = work.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_doc", "_version")
    found = repeated_spans(work, placed, m).groupBy("_doc", "_version").agg(
        F.collect_set(F.struct("_start", "_end")).alias("_spans")
    )
    whole = F.encode("_text", "utf-8")
    # the other columns, with the id and the text as they came
    others = F.struct(F.col("_key"), F.when(~F.col("_none"), F.col("_text")).alias("_text"), F.col("_row"))
    cleaned = placed.join(found, ["_doc", "_version"], "left").select(
        others.alias("_whole_row"), whole.alias("_whole"), F.sort_array("_spans").alias("_spans")
    )
    schema = T.StructType([
        cleaned.schema["_whole_row"], T.StructField("_kept", T.BinaryType()), T.StructField("_n", T.LongType()), T.StructField("_k", T.LongType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, counts = [], [], []
            for data, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                pieces, done, runs = [], 0, 0
                for s in own or ():
                    if s["_start"] > done or not runs:
                        pieces.append(data[done : s["_start"]])
                        runs += 1
                    done = max(done, s["_end"])
                pieces.append(data[done:])
                kept.append(b"".join(pieces))
                sizes.append(len(data))
                counts.append(runs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=schema.names
            )

    done = cleaned.mapInArrow(cut, schema).select("_whole_row.*", "_kept", "_n", "_k")
    return restore(
        done, docs.columns, {"key": doc_id, "text": text}, kept=F.col("_kept"), n_bytes=F.col("_n"),
        n_removed=F.col("_n") - F.octet_length("_kept"), n_spans=F.col("_k"),
    )


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
