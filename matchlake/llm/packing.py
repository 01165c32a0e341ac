"""Packing documents into sequences, in order, with cuts chosen by dynamic programming.

A task reads its documents as one stream of ids. Candidate cuts are document ends, sentence ends
and, where a sentence is long, places inside it. The least sum of padding and penalties over all
ways to cut the stream into windows is found exactly: the cost of window (i, j] is
`limit - (p[j] - p[i])` plus the penalty of cut j, so f(j) is a constant of j plus the least
f(i) + p[i] in a sliding window, which a monotone queue keeps.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.ragged import CHUNK_BYTES
from matchlake.llm.word_ids import word_ids


@dataclass(frozen=True)
class Packing:
    """Penalties count in padding tokens."""

    limit: int = 4096
    end_id: int = 2
    sentence_penalty: float = 8.0
    inside_penalty: float = 96.0
    # a longer stretch without a sentence end gets candidates inside, this far apart
    stretch: int = 128
    # ids a task holds before it packs them; the last, open sequence goes on with the next ones
    held_tokens: int = 1_000_000


def candidates(ids: np.ndarray, ends: np.ndarray, sentence_end: np.ndarray, p: Packing) -> tuple[np.ndarray, np.ndarray]:
    """(positions, penalties) of the cuts that may be made; 0 and the stream's end are among them."""
    sentences = np.flatnonzero(sentence_end[np.minimum(ids, len(sentence_end) - 1)] & (ids < len(sentence_end))) + 1
    position = np.r_[0, ends, sentences]
    penalty = np.r_[0.0, np.zeros(len(ends)), np.full(len(sentences), p.sentence_penalty)]
    order = np.lexsort((penalty, position))
    position, penalty = position[order], penalty[order]
    once = np.r_[True, np.diff(position) > 0]
    position, penalty = position[once], penalty[once]
    gaps = np.diff(position)
    wide = np.flatnonzero(gaps > p.stretch)
    if len(wide):
        more = np.concatenate([np.arange(position[g] + p.stretch, position[g + 1], p.stretch) for g in wide])
        position = np.r_[position, more]
        penalty = np.r_[penalty, np.full(len(more), p.inside_penalty)]
        order = np.argsort(position, kind="stable")
        position, penalty = position[order], penalty[order]
    return position, penalty


def best_cuts(position: np.ndarray, penalty: np.ndarray, limit: int) -> np.ndarray:
    """The cuts of least total cost, first 0 and last the end. Ties take the earlier window start."""
    places, penalties = position.tolist(), penalty.tolist()
    n = len(places)
    came_from = [0] * n
    # entries (f(i) + p[i], i) with the value rising from left to right
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, n):
        place = places[j]
        oldest = place - limit
        while places[queue[0][1]] < oldest:
            queue.popleft()
        value, came_from[j] = queue[0]
        # f(j) + p[j] = limit + penalty + least, as the two p[j] cancel out
        value += limit + penalties[j]
        while queue and queue[-1][0] > value:
            queue.pop()
        queue.append((value, j))
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(came_from[cuts[-1]])
    return position[cuts[::-1]]


class Stream:
    """One task's documents, packed as they come."""

    def __init__(self, path: str, p: Packing, with_ids: bool) -> None:
        self.words, self.p, self.with_ids = word_ids(path), p, with_ids
        self.sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        self.ids: list[np.ndarray] = []
        # number of ids, ids before them in their document, row number, ids of the document
        self.parts: list[tuple[int, int, int, int]] = []
        self.keys: list[object] = []
        self.held = 0

    def add(self, keys: list[object], texts: list[str]) -> Iterator[pa.RecordBatch]:
        ids, lengths = self.words(texts)
        ends = np.cumsum(lengths)
        # the end id goes behind each document
        out = np.empty(len(ids) + len(texts), dtype=np.uint32)
        mask = np.zeros(len(out), dtype=bool)
        mask[ends + np.arange(len(texts))] = True
        out[mask], out[~mask] = self.p.end_id, ids
        self.ids.append(out)
        base = len(self.keys)
        self.keys += keys
        self.parts += [(n + 1, 0, base + k, n + 1) for k, n in enumerate(lengths.tolist())]
        self.held += len(out)
        if self.held >= self.p.held_tokens:
            yield self.pack(last=False)

    def pack(self, last: bool) -> pa.RecordBatch:
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, dtype=np.uint32)
        parts = np.array(self.parts, dtype=np.int64).reshape(-1, 4)
        part_ends = np.cumsum(parts[:, 0])
        cuts = best_cuts(*candidates(ids, part_ends, self.words.sentence_end, self.p), self.p.limit)
        if not last and len(cuts) > 2:
            cuts = cuts[:-1]
        stop = int(cuts[-1])
        part_starts = part_ends - parts[:, 0]
        starts = np.unique(np.r_[part_starts[part_starts < stop], cuts[:-1]])
        ends = np.r_[starts[1:], stop][: len(starts)]
        of = np.searchsorted(part_ends, starts, side="right")
        window = np.searchsorted(cuts, starts, side="right") - 1
        start = parts[of, 1] + starts - part_starts[of]
        data = ids.astype("<u4").tobytes()
        crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        keys = [self.keys[k] for k in parts[of, 2].tolist()]
        columns = [
            pa.array(keys, pa.int64()),
            pa.array(start), pa.array(ends - starts), pa.array(crc, pa.int64()), pa.array(parts[of, 3]),
            pa.array(self.sequence + window), pa.array(starts - cuts[window]),
        ]
        if self.with_ids:
            bounds = pa.array(np.r_[starts, stop].astype(np.int32))
            columns.append(pa.ListArray.from_arrays(bounds, pa.array(ids[:stop].astype(np.int32))))
        batch = pa.RecordBatch.from_arrays(columns, names=PIECES.names[: len(columns)])
        self.sequence += len(cuts) - 1
        left = np.flatnonzero(part_ends > stop)
        cut_off = np.maximum(stop - part_starts[left], 0)
        rest = parts[left].copy()
        rest[:, 0] -= cut_off
        rest[:, 1] += cut_off
        self.keys = [self.keys[k] for k in rest[:, 2].tolist()]
        rest[:, 2] = np.arange(len(rest))
        self.parts = [tuple(r) for r in rest.tolist()]
        self.ids = [ids[stop:]]
        self.held = len(ids) - stop
        return batch


PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
])


def pack_documents(
    docs: DataFrame, path: str, packing: Packing | None = None, with_ids: bool = True,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece of a document in a sequence: doc_id (long), start, length, ids_crc32,
    doc_tokens, sequence_id, offset and, unless `with_ids` is false, ids.

    - A document is its ids and the end id, so a null or empty text is one id.
    - Null and repeated doc_ids and repeated rows are packed like any other row. Columns other than
      doc_id and text are left aside. An empty table gives no rows.
    - A text of any length is cut over as many sequences as it needs.

    Documents keep the order in which a task reads them, so nothing is shuffled. Only the last
    sequence of a task is open. A task holds `held_tokens` ids, and the text it is reading.
    """
    p = packing or Packing()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(path, p, with_ids)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            step = max(1, len(texts) * CHUNK_BYTES // max(1, texts.nbytes))
            for k in range(0, len(texts), step):
                part = [t or "" for t in texts.slice(k, step).to_pylist()]
                yield from stream.add(keys.slice(k, step).to_pylist(), part)
        if stream.parts:
            yield stream.pack(last=True)

    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    ).mapInArrow(pack, PIECES if with_ids else T.StructType(PIECES.fields[:-1]))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
