"""Language-model scoring by a hierarchical Pitman-Yor model of word n-grams.

Every context of n - 1 words is a restaurant; a restaurant's parent is the restaurant of its context
without the first word, up to the empty context, whose parent is the uniform distribution over the
training vocabulary and one unknown word. A word's customers in a restaurant sit at tables, and each
table sends one customer of that word to the parent restaurant: contexts that end alike share their
parent's counts.

Seating is sampled by Gibbs: one (context, word) row at a time its customers are seated anew given
everything else (a block step of the Chinese restaurant process with the parent's predictive
probability), rows in parallel given the state of the step before, levels from the longest context to
the empty one, so that each parent's customers are its children's tables. Only the number of tables
of a row matters for the next steps. After BURN_IN sweeps, each of SAMPLES sweeps gives predictive
probabilities of every (context, word) of the table; their mean scores the texts.

The work is dealt by a context's last word: a shard holds all levels but the empty context for its
words, so a row, its parent and its restaurant meet in one task, and the occurrences are shuffled
once. What shards share goes through buckets after every sweep: the customers of the words in the
empty context, which are seated there, and the totals of the restaurants that end in a very
frequent word, whose rows are spread over several shards by the word that follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.columns import LOWER, UPPER
from matchlake.llm.ragged import chunks
from matchlake.llm.seating import Layout, Shard, contexts, deal, dump, hashes, load, rises, seat, tables, tokens
from matchlake.session import new_scratch

__all__ = ["END", "Model", "occurrences", "op11_lm_scoring", "score", "tables"]

WORD = "[^\\x20\\x09-\\x0D]+"
# a word has no ASCII white space, so neither the end token nor the padding before the first word is one
END, PAD = "\n", ""
ORDER = 3
# discount and concentration by context length 0, 1, 2, ...; the last pair holds for longer ones
DISCOUNT = (0.6, 0.7, 0.8)
CONCENTRATION = (1.0, 1.0, 1.0)
BURN_IN, SAMPLES = 2, 2
SEED = 20_241_202
HELD_OUT_MOD, HELD_OUT_REST = 7, 2
# tokens that a shard should hold, and tokens that a task deals out at a time
SHARD_TOKENS, DEAL_TOKENS = 1_700_000, 5_000_000
# the shards are priced in so many turns, so that only one turn's shuffle is on disk
PRICE_TURNS = 4
# a task reports the words that are at least this share of its tokens
HEAVY = 1 / 4000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# kinds of messages; `sweep` counts from 0, -1 is the state before the first
PIECE, DOCS, SHARD, SEEN, SEATS, UP, DOWN, TOTAL, SUMS = range(9)
MESSAGE = T.StructType([
    T.StructField("to", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("sweep", T.IntegerType()),
    T.StructField("src", T.LongType()), T.StructField("body", T.BinaryType()),
])
ARROW = pa.schema([("to", pa.int64()), ("kind", pa.int32()), ("sweep", pa.int32()), ("src", pa.int64()), ("body", pa.binary())])


def messages(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, ARROW.types, strict=True)], schema=ARROW)


def settle(df: DataFrame) -> DataFrame:
    """Messages written once as Parquet to the shared folder, a folder for each kind, and read again.

    The shuffles behind them are not needed after that; Spark is asked to remove their files.
    """
    spark = df.sparkSession
    path, was = new_scratch(spark, "pitman-yor"), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy("kind").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if was is None else spark.conf.set(CLEANUP, was)
    return spark.read.schema(MESSAGE).parquet(path).select(*MESSAGE.names)


def _param(values: tuple[float, ...], level: int) -> float:
    return values[min(level, len(values) - 1)]


def occurrences(docs: DataFrame, order: int = ORDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_key, _doc, _held, _train, _n, _ctx, _w, _k): each row's (context, word) pairs with their counts.

    A row's tokens: words of its text with A-Z in lower case (null: none), then the end token.
    """
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    words = F.concat(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), F.array(F.lit(END)))
    rest = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(HELD_OUT_MOD))
    keyed = docs.select(
        F.col(doc_id).alias("_doc"), words.alias("_words"),
        F.coalesce(rest == HELD_OUT_REST, F.lit(False)).alias("_held"),
        F.coalesce(rest != HELD_OUT_REST, F.lit(False)).alias("_train"),
    ).withColumn("_key", F.monotonically_increasing_id())
    # the padded words are a column of their own: an expression inside the lambda would be built anew per word
    keyed = keyed.withColumn("_padded", F.concat(F.array_repeat(F.lit(PAD), order - 1), F.col("_words")))
    padded = F.col("_padded")
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("_words") - 1),
        lambda i: F.struct(F.array_join(F.slice(padded, i + 1, order - 1), " ").alias("c"), F.get(padded, i + order - 1).alias("w")),
    )
    exploded = keyed.select("_key", "_doc", "_held", "_train", F.size("_words").alias("_n"), F.explode(pairs).alias("_p"))
    return exploded.groupBy("_key", "_doc", "_held", "_train", "_n", F.col("_p.c").alias("_ctx"), F.col("_p.w").alias("_w")).agg(
        F.count(F.lit(1)).alias("_k")
    )


def heavy_words(docs: DataFrame, text: str) -> DataFrame:
    """(_word, _n): hashes of words that are frequent among a task's tokens; null: all tokens."""
    end = hashes([END])[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in chunks(batch, text):
                flat, _ = tokens(data, offsets, end)
                names, counts = np.unique(flat, return_counts=True)
                many = counts >= HEAVY * len(flat)
                yield pa.record_batch({
                    "_word": pa.array([None, *names[many].view(np.int64).tolist()], pa.int64()),
                    "_n": pa.array([len(flat), *counts[many].tolist()], pa.int64()),
                })

    return docs.select(text).mapInArrow(run, "_word long, _n long").groupBy("_word").agg(F.sum("_n").alias("_n"))


def layout_of(counts: DataFrame, order: int) -> Layout:
    """Shards for as many tokens as `counts` (_word, _n) tells, frequent words spread by their share of a shard."""
    spread = SHARD_TOKENS // 2
    found = counts.where(F.col("_word").isNull() | (F.col("_n") > spread)).collect()
    shards = max(1, -(-sum(r._n for r in found if r._word is None) // SHARD_TOKENS))
    hot = sorted((np.int64(r._word).view(np.uint64), min(shards, -(-r._n // spread))) for r in found if r._word is not None)
    hot = hot if shards > 1 else []
    return Layout(order, shards, np.array([h for h, _ in hot], dtype=np.uint64), np.array([n for _, n in hot], dtype=np.uint64))


def _chunk_id(task: int, number: int) -> int:
    return (task << 32) + number


def _docs_body(docs: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as out:
        out.write_table(docs)
    return sink.getvalue().to_pybytes()


def text_pieces(docs: DataFrame, text: str, layout: Layout, source: int = 0) -> DataFrame:
    """Messages to the shards: the occurrences of every chunk of documents; and the chunk's other columns
    with `_n`, their numbers of tokens. A document learns where `_train` is true."""
    end, pad = hashes([END, PAD])
    other = [c for c in docs.columns if c != text]

    def dealt(chunk: int, held: list) -> pa.Table:
        names, ids = np.unique(np.concatenate([*(f for f, _, _ in held), [pad]]), return_inverse=True)
        ids, pad_id = ids[:-1].astype(np.int32), ids[-1]
        counts = np.concatenate([n for _, n, _ in held])
        rows = pa.Table.from_batches([b for _, _, b in held])
        learn = rows["_train"].combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        out = [(s, PIECE, -1, chunk, body) for s, body in deal(
            names, contexts(ids, counts, pad_id, layout.order), ids, doc, np.ones(len(ids), dtype=np.int8), learn, layout)]
        return messages([*out, (chunk % layout.shards, DOCS, -1, chunk, _docs_body(rows.append_column("_n", pa.array(counts))))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            kept = batch.select(other)
            for part, data, offsets in chunks(batch, text):
                flat, counts = tokens(data, offsets, end)
                held.append((flat, counts, kept.slice(part.start, part.stop - part.start)))
                size += len(flat)
                if size >= DEAL_TOKENS:
                    yield from dealt(_chunk_id(2 * task + source, number), held).to_batches()
                    held, size, number = [], 0, number + 1
        if held:
            yield from dealt(_chunk_id(2 * task + source, number), held).to_batches()

    return docs.mapInArrow(run, MESSAGE)


def row_pieces(rows: DataFrame, layout: Layout, source: int) -> DataFrame:
    """The same of rows (_ctx, _w, _k, _train): `_ctx` holds words separated by single spaces."""
    order = layout.order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            chunk, n = _chunk_id(2 * task + source, number), batch.num_rows
            split = [c.split(" ") for c in batch["_ctx"].to_pylist()]
            back = [[c[-k] if len(c) >= k else PAD for c in split] for k in range(1, order)]
            names, ids = np.unique(hashes([w for c in [*back, batch["_w"].to_pylist()] for w in c]), return_inverse=True)
            *ctx, word = ids.reshape(order, n)
            learn = batch["_train"].to_numpy(zero_copy_only=False).astype(np.int64)
            out = [(s, PIECE, -1, chunk, body) for s, body in deal(
                names, ctx, word, np.arange(n), batch["_k"].to_numpy(), learn, layout)]
            table = pa.Table.from_batches([batch]).append_column("_n", pa.array(np.ones(n, dtype=np.int64)))
            yield from messages([*out, (chunk % layout.shards, DOCS, -1, chunk, _docs_body(table))]).to_batches()

    return rows.mapInArrow(run, MESSAGE)


def _of(table: pa.Table, kind: int, sweep: int | None = None) -> list[tuple[int, bytes]]:
    """(src, body) of one kind, sorted by src."""
    wanted = pc.equal(table["kind"], kind)
    if sweep is not None:
        wanted = pc.and_(wanted, pc.equal(table["sweep"], sweep))
    table = table.filter(wanted)
    return sorted(zip(table["src"].to_pylist(), table["body"].to_pylist(), strict=True))


def _sliced(bucket: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Places of the keys of each bucket, in the order of the keys."""
    by = np.argsort(bucket, kind="stable")
    return np.split(by, np.searchsorted(bucket[by], np.arange(1, buckets)))


def _flat(arrays: list[np.ndarray], dtype: type) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, dtype=dtype)


def _room_sums(shard: Shard, seats: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Customers and tables that this shard has in the rooms it shares."""
    customers = shard.customers(seats)
    parts = [[shard.totals(k, v[k - 1])[shard.shared[k - 1]] for k in range(1, shard.depth + 1)] for v in (customers, seats)]
    return _flat(parts[0], np.int64), _flat(parts[1], np.int64)


class Totals:
    """What the buckets answered to a shard: per word customers, tables and learnt count of level 0, per shared room totals."""

    def __init__(self, shard: Shard, down: list[tuple[int, bytes]], shards: int) -> None:
        rooms = _flat(shard.shared_buckets, np.int64)
        self.word_at, self.room_at = _sliced(shard.buckets, shards), _sliced(rooms, shards)
        words = np.zeros((4, len(shard.buckets)), dtype=np.int64)
        shared = np.zeros((3, len(rooms)), dtype=np.int64)
        for bucket, body in down:
            answer = load(body)
            words[:, self.word_at[bucket]] = [np.cumsum(answer[0]), *answer[1:4]]
            shared[:, self.room_at[bucket]] = answer[4:]
        self.word, self.customers, self.tables, self.known = words
        self.room = shared[0]
        cuts = np.cumsum([len(s) for s in shard.shared])[:-1]
        self.room_customers, self.room_tables = np.split(shared[1], cuts), np.split(shared[2], cuts)


def _first_up(shard: Shard, hashed: tuple, seats: list[np.ndarray], index: int, shards: int) -> list[tuple]:
    (names, rooms, known), sums = hashed, shard.sums(seats)
    customers, seated = _room_sums(shard, seats)
    return [
        (b, UP, -1, index, dump(rises(names[w]), sums[w], known[w], rooms[r], customers[r], seated[r]))
        for b, (w, r) in enumerate(zip(_sliced(shard.buckets, shards), _sliced(_flat(shard.shared_buckets, np.int64), shards), strict=True))
        if len(w) or len(r)
    ]


def _next_up(shard: Shard, seats: list[np.ndarray], totals: Totals, sweep: int, index: int) -> list[tuple]:
    sums = shard.sums(seats)
    customers, seated = _room_sums(shard, seats)
    return [
        (b, UP, sweep, index, dump(rises(totals.word[w]), sums[w], totals.tables[w], totals.room[r], customers[r], seated[r]))
        for b, (w, r) in enumerate(zip(totals.word_at, totals.room_at, strict=True)) if len(w) or len(r)
    ]


def build_shards(pieces: DataFrame, layout: Layout) -> DataFrame:
    """The shards, their occurrences by chunk, first tables and first sums."""

    def run(table: pa.Table) -> pa.Table:
        index = table["to"][0].as_py()
        out = [(src, DOCS, -1, src, body) for src, body in _of(table, DOCS)]
        if found := _of(table, PIECE):
            del table
            shard, seen, hashed = Shard.build([b for _, b in found], layout)
            out += [(index, SEEN, -1, src, body) for (src, _), body in zip(found, seen, strict=True)]
            seats = shard.start()
            out += [(index, SHARD, -1, index, shard.dump()), (index, SEATS, -1, index, shard.dump_seats(seats))]
            out += _first_up(shard, hashed, seats, index, layout.shards)
        return messages(out)

    return pieces.groupBy("to").applyInArrow(run, MESSAGE)


def exchange(ups: DataFrame, sweep: int, before: tuple[int, int, int, int], first: bool) -> DataFrame:
    """Sums over all shards to every shard that sent some; level 0 is seated here, as the last level of a sweep."""
    d, theta = _param(DISCOUNT, 0), _param(CONCENTRATION, 0)

    def run(table: pa.Table) -> pa.Table:
        bucket = table["to"][0].as_py()
        found = [(src, load(body)) for src, body in _of(table, UP)]
        words, rooms = [len(x[0]) for _, x in found], [len(x[3]) for _, x in found]
        sums, third, customers, seated = (np.concatenate([x[k] for _, x in found]) for k in (1, 2, 4, 5))
        if first:
            names = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for _, x in found])
            word, room = (np.unique(k, return_inverse=True)[1] for k in (names, np.concatenate([x[3] for _, x in found])))
        else:
            word, room = np.concatenate([np.cumsum(x[0]) for _, x in found]), np.concatenate([x[3] for _, x in found])
        c0, cu, tu = (np.bincount(at, weights=v).astype(np.int64) for at, v in ((word, sums), (room, customers), (room, seated)))
        known = np.zeros(len(c0), dtype=np.int64)
        if first:
            known = np.bincount(word, weights=third).astype(np.int64)
            t0 = np.minimum(c0, 1)
        else:
            was = np.zeros(len(c0), dtype=np.int64)
            was[word] = third
            base = np.full(len(c0), 1.0 / (before[3] + 1))
            t0 = seat(c0, before[1] - was, base, d, theta, np.random.default_rng([SEED, sweep, 0, bucket]))
        out = [(bucket, TOTAL, sweep, bucket, dump(np.array([c0.sum(), t0.sum(), known.sum(), (known > 0).sum()])))]
        word_ends, room_ends = np.cumsum(words), np.cumsum(rooms)
        for k, (src, _) in enumerate(found):
            w, r = word[word_ends[k] - words[k] : word_ends[k]], room[room_ends[k] - rooms[k] : room_ends[k]]
            out.append((src, DOWN, sweep, bucket, dump(rises(w), c0[w], t0[w], known[w], r, cu[r], tu[r])))
        return messages(out)

    return ups.groupBy("to").applyInArrow(run, MESSAGE)


def probabilities(shard: Shard, seats: list[np.ndarray], totals: Totals, level0: tuple[int, int, int, int]) -> list[np.ndarray]:
    """Predictive probability of the rows of every level, 0 first."""
    customers0, tables0, _, vocabulary = level0
    d, theta = _param(DISCOUNT, 0), _param(CONCENTRATION, 0)
    out = [(totals.customers - d * totals.tables + (theta + d * tables0) / (vocabulary + 1)) / (theta + customers0)]
    customers = shard.customers(seats)
    for level in range(1, shard.depth + 1):
        d, theta = _param(DISCOUNT, level), _param(CONCENTRATION, level)
        room, c, t = shard.rooms[level - 1], customers[level - 1], seats[level - 1]
        cu, tu = shard.joined(level, c, totals.room_customers), shard.joined(level, t, totals.room_tables)
        out.append((c - d * t + (theta + d * tu[room]) * out[-1][shard.parents[level - 1]]) / (theta + cu[room]))
    return out


def sweep_shards(state: DataFrame, sweep: int, level0: tuple[int, int, int, int], shards: int) -> DataFrame:
    """One Gibbs sweep over the local levels, the deepest first, given the probabilities of the state before."""

    def run(table: pa.Table) -> pa.Table:
        index = table["to"][0].as_py()
        shard = Shard.load(_of(table, SHARD)[0][1])
        seats, totals = shard.load_seats(_of(table, SEATS)[0][1]), Totals(shard, _of(table, DOWN), shards)
        probs, customers, fresh = probabilities(shard, seats, totals, level0), shard.counts, list(seats)
        for level in range(shard.depth, 0, -1):
            room, was = shard.rooms[level - 1], seats[level - 1]
            others = shard.joined(level, was, totals.room_tables)[room] - was
            fresh[level - 1] = seat(customers, others, probs[level - 1][shard.parents[level - 1]], _param(DISCOUNT, level),
                                    _param(CONCENTRATION, level), np.random.default_rng([SEED, sweep, level, index]))
            customers = shard.lifted(level, fresh[level - 1])
        return messages([(index, SEATS, sweep, index, shard.dump_seats(fresh)), *_next_up(shard, fresh, totals, sweep, index)])

    return state.groupBy("to").applyInArrow(run, MESSAGE)


def price_shards(state: DataFrame, samples: dict[int, tuple[int, int, int, int]], first: tuple[int, int, int, int], shards: int) -> DataFrame:
    """To every chunk, per document: score, base score and known tokens of its occurrences in a shard."""

    def run(table: pa.Table) -> pa.Table:
        index = table["to"][0].as_py()
        shard = Shard.load(_of(table, SHARD)[0][1])
        known = Totals(shard, _of(table, DOWN, -1), shards).known
        mean = 0.0
        for sweep, level0 in samples.items():
            seats = shard.load_seats(_of(table, SEATS, sweep)[0][1])
            mean = mean + probabilities(shard, seats, Totals(shard, _of(table, DOWN, sweep), shards), level0)[-1] / len(samples)
        word = np.arange(len(shard.buckets))
        for parent in shard.parents:
            word = word[parent]
        logs = np.log10(mean)
        base = np.log10((known + 1) / float(first[2] + first[3] + 1))[word]
        is_known = (known > 0)[word]
        out = []
        for src, body in _of(table, SEEN):
            row, doc, times = load(body)
            row = np.cumsum(row)
            there, doc = np.unique(doc, return_inverse=True)
            sums = [np.bincount(doc, weights=times * x[row]) for x in (logs, base, is_known)]
            out.append((src, SUMS, -1, index, dump(rises(there), sums[0], sums[1], sums[2].astype(np.int64))))
        return messages(out)

    return state.groupBy("to").applyInArrow(run, MESSAGE)


def finish(sums: DataFrame, schema: T.StructType) -> DataFrame:
    """The documents of every chunk with _score, _base and _known."""

    def run(table: pa.Table) -> pa.Table:
        docs = pa.ipc.open_stream(_of(table, DOCS)[0][1]).read_all()
        score, base, known = np.zeros(len(docs)), np.zeros(len(docs)), np.zeros(len(docs), dtype=np.int64)
        for _, body in _of(table, SUMS):
            there, *more = load(body)
            there = np.cumsum(there)
            for total, x in zip((score, base, known), more, strict=True):
                total[there] += x
        for name, values in (("_score", score), ("_base", base), ("_known", known)):
            docs = docs.append_column(name, pa.array(values))
        return docs.select(schema.names)

    return sums.groupBy("to").applyInArrow(run, schema)


def sampled(pieces: DataFrame, layout: Layout, sweeps: int, samples: int, docs: T.StructType) -> tuple[DataFrame, int]:
    """The documents behind `pieces` scored by the mean of the last `samples` of `sweeps` sweeps, and the learnt tokens."""
    shards = layout.shards

    def seated(ups: DataFrame, sweep: int, before: tuple, first: bool = False) -> tuple[DataFrame, tuple]:
        down = settle(exchange(ups.where(F.col("kind") == UP), sweep, before, first))
        found = [load(bytes(r.body))[0] for r in down.where(F.col("kind") == TOTAL).select("body").collect()]
        # sums of one small row per bucket; words and learnt tokens are told by the first exchange only
        sums = [int(x) for x in np.sum(found, axis=0)] if found else [0] * 4
        return down.where(F.col("kind") == DOWN), (*sums[:2], *(sums if first else before)[2:])

    built = settle(build_shards(pieces, layout))
    fixed = built.where(F.col("kind") == SHARD)
    down, level0 = seated(built, -1, (0, 0, 0, 0), first=True)
    first, downs, kept, levels = level0, [down], [built.where(F.col("kind") == SEATS)], [level0]
    for sweep in range(sweeps):
        fresh = settle(sweep_shards(fixed.union(kept[-1]).union(downs[-1]), sweep, levels[-1], shards))
        down, level0 = seated(fresh, sweep, levels[-1])
        kept.append(fresh.where(F.col("kind") == SEATS))
        downs.append(down)
        levels.append(level0)
    chosen = range(sweeps - samples, sweeps)
    state = built.where(F.col("kind").isin(SHARD, SEEN)).union(downs[0])
    for sweep in chosen:
        state = state.union(kept[sweep + 1])
        if sweep >= 0:
            state = state.union(downs[sweep + 1])
    done = built.where(F.col("kind") == DOCS)
    for turn in range(min(PRICE_TURNS, shards)):
        own = state.where(F.col("to") % PRICE_TURNS == turn)
        done = done.union(settle(price_shards(own, {s: levels[s + 1] for s in chosen}, first, shards)))
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs), T.StructField("_n", T.LongType()), T.StructField("_score", T.DoubleType()),
                           T.StructField("_base", T.DoubleType()), T.StructField("_known", T.LongType())])
    return finish(done, schema), first[2]


class Model:
    """The model of training rows (_ctx, _w, _k); sweeps are run when probabilities are asked for."""

    def __init__(self, train: DataFrame, order: int = ORDER) -> None:
        self.order, self.sweeps = order, 0
        self.train = train.select("_ctx", "_w", F.col("_k").cast("long").alias("_k"), F.lit(True).alias("_train"))

    def sweep(self, number: int) -> None:
        """One more Gibbs sweep; they are numbered from 0."""
        if number != self.sweeps:
            raise ValueError(f"sweep {self.sweeps} is the next")
        self.sweeps += 1

    def predictive(self, keys: DataFrame) -> DataFrame:
        """(_ctx, _w, _id, _prob) for every key (_ctx, _w, _id) of the deepest level, seen in training or not."""
        asked = keys.select("_ctx", "_w", F.lit(1).cast("long").alias("_k"), F.lit(False).alias("_train"), F.col("_id"))
        train = self.train.withColumn("_id", F.lit(None).cast(asked.schema["_id"].dataType))
        total = F.sum("_k").alias("_n")
        counts = train.unionByName(asked).groupBy(F.element_at(F.split("_ctx", " "), -1).alias("_last")).agg(total)
        names = F.udf(lambda w: int(hashes([w]).view(np.int64)[0]), "long")
        counts = counts.groupBy(F.lit(None).cast("long").alias("_word")).agg(F.sum("_n").alias("_n")).unionByName(
            counts.where(F.col("_n") > SHARD_TOKENS // 2).select(names("_last").alias("_word"), "_n"))
        layout = layout_of(counts, self.order)
        pieces = row_pieces(train, layout, 0).union(row_pieces(asked, layout, 1))
        done, _ = sampled(pieces, layout, self.sweeps, 1, asked.schema)
        return done.where(~F.col("_train")).select("_ctx", "_w", "_id", F.pow(F.lit(10.0), F.col("_score")).alias("_prob"))


def score(docs: DataFrame, order: int = ORDER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    - Learning rows: crc32 of the doc_id's decimal text modulo 7 is not 2; held_out: it is 2. A null
      doc_id is neither: it is scored and not learnt from.
    - Tokens: words (maximal runs outside ASCII white space) of the text with A-Z lower-cased, null
      as none, then one end token. Long texts count whole. Repeated rows are scored and, when they
      learn, counted as often as they come.
    - base_score: sum of log10((c + 1) / (N + V + 1)) over tokens; c: the token's training count, N:
      training tokens, V: distinct training tokens. n_known: tokens with c > 0.
    - score: log10 of the model's mean predictive probability over samples, summed over tokens.
    - Other columns are left aside whatever their names. An empty table gives no rows; a table without
      learning rows scores with N = V = 0 and the uniform base.
    """
    rest = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(HELD_OUT_MOD))
    chosen = docs.select(
        F.col(doc_id).alias("_doc"), F.col(text).alias("_text"),
        F.coalesce(rest == HELD_OUT_REST, F.lit(False)).alias("_held"),
        F.coalesce(rest != HELD_OUT_REST, F.lit(False)).alias("_train"),
    )
    layout = layout_of(heavy_words(chosen, "_text"), order)
    fields = T.StructType([chosen.schema[c] for c in ("_doc", "_held", "_train")])
    done, total = sampled(text_pieces(chosen, "_text", layout), layout, BURN_IN + SAMPLES, SAMPLES, fields)
    return done.select(
        F.col("_doc").alias(doc_id), F.col("_held").alias("held_out"), F.col("_n").alias("n_tokens"),
        F.col("_known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        F.col("_base").alias("base_score"), F.col("_score").alias("score"),
    )


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens", "n_known",
                              "train_tokens", "base_score", "score")
