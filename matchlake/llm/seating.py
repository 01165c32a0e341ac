"""Array steps of the Pitman-Yor model: tokens, pieces of a shard, the shard's restaurants, seat sampling.

A word is known by a 64-bit hash of its bytes. Messages between tasks are byte strings of packed
arrays: integers in as few bytes as they need, byte by byte, compressed.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from matchlake.llm.ragged import SliceHash, mixed, words

LOWER_BYTE = np.arange(256, dtype=np.uint8)
LOWER_BYTE[65:91] += 32
# customers of a row that are seated one by one, for all rows at once; fuller rows jump from table to table
ONE_BY_ONE = 2048
_HEAD = struct.Struct("<2sQQ")
_CHAIN = np.uint64(0x9E3779B97F4A7C15)


def dump(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: uint64 and float64 as they are, integers (not negative) narrowed."""
    codec = pa.Codec("zstd", compression_level=3)
    parts = []
    for a in arrays:
        kind = "f" if a.dtype.kind == "f" else "h" if a.dtype == np.uint64 else "i"
        if kind == "i":
            a = a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        packed = codec.compress(planes, asbytes=True) if planes else b""
        parts += [_HEAD.pack(f"{kind}{a.itemsize}".encode(), len(a), len(packed)), packed]
    return b"".join(parts)


def load(body: bytes, most: int | None = None) -> list[np.ndarray]:
    """The arrays again, or the first `most` of them."""
    codec, out, at = pa.Codec("zstd"), [], 0
    while at < len(body) and len(out) != most:
        what, n, size = _HEAD.unpack_from(body, at)
        at += _HEAD.size
        kind, width = what[:1], int(what[1:])
        planes = codec.decompress(body[at : at + size], decompressed_size=n * width, asbytes=True) if n else b""
        at += size
        flat = np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(width, n).T)
        a = flat.view(f"{'f' if kind == b'f' else 'u'}{width}").reshape(n)
        out.append(a.astype(np.int64) if kind == b"i" else a)
    return out


def rises(a: np.ndarray) -> np.ndarray:
    """A sorted array as differences; np.cumsum undoes it."""
    return np.diff(a, prepend=a.dtype.type(0))


def hashes(texts: list[str]) -> np.ndarray:
    """64-bit hashes of whole strings."""
    raw = [t.encode() for t in texts]
    ends = np.cumsum(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return SliceHash(data)(np.r_[0, ends[:-1]], ends) if len(raw) else np.zeros(0, dtype=np.uint64)


def tokens(data: np.ndarray, offsets: np.ndarray, end: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, number of tokens of each text): lower-cased words, then the end token."""
    data = LOWER_BYTE[data]
    starts, ends, first = words(data, offsets)
    counts = np.diff(first)
    flat = np.full(len(starts) + len(counts), end, dtype=np.uint64)
    flat[np.arange(len(starts)) + np.repeat(np.arange(len(counts)), counts)] = SliceHash(data)(starts, ends)
    return flat, counts + 1


def contexts(ids: np.ndarray, counts: np.ndarray, pad: int, order: int) -> list[np.ndarray]:
    """The word before each token, the one before that, ...: `order` - 1 arrays; `pad` before a text's start."""
    place = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = []
    for back in range(1, order):
        before = np.full(len(ids), pad, dtype=ids.dtype)
        before[back:] = ids[:-back]
        before[place < back] = pad
        out.append(before)
    return out


@dataclass(frozen=True)
class Layout:
    """Which shard holds a (context, word): that of the context's last word; the frequent ones in
    `hot` (sorted hashes) are spread over `ways` shards by the word that follows."""

    order: int
    shards: int
    hot: np.ndarray
    ways: np.ndarray

    def ways_of(self, names: np.ndarray) -> np.ndarray:
        out = np.ones(len(names), dtype=np.uint64)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, names), len(self.hot) - 1)
            same = self.hot[at] == names
            out[same] = self.ways[at[same]]
        return out

    def shard_of(self, names: np.ndarray, last: np.ndarray, word: np.ndarray) -> np.ndarray:
        places = (mixed(names) % np.uint64(self.shards))[last]
        spread = names[word] % self.ways_of(names)[last]
        return ((places + spread) % np.uint64(self.shards)).astype(np.uint16 if self.shards < 2**16 else np.int64)


def sorted_pairs(n: int, order: int) -> bool:
    """Whether a piece of n words holds the last two context words as one sorted number."""
    return order > 2 and n**order < 2**63


def deal(names: np.ndarray, ctx: list[np.ndarray], word: np.ndarray, doc: np.ndarray, times: np.ndarray, learn: np.ndarray, layout: Layout):  # noqa: ANN201
    """(shard, bytes) of the occurrences: each context word from the last one back, word, document and count."""
    columns = [*ctx, word]
    shard = layout.shard_of(names, columns[0], word)
    by = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[by], np.arange(layout.shards + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        at = by[cuts[s] : cuts[s + 1]]
        own = [c[at] for c in columns]
        # small numbers for frequent words: by power of two of the count, then by hash
        counts = sum(np.bincount(c, minlength=len(names)) for c in own)
        used = np.flatnonzero(counts)
        used = used[np.argsort(-np.frexp(counts[used])[1], kind="stable")]
        local = np.empty(len(names), dtype=np.int64)
        local[used] = np.arange(len(used))
        own = [local[c] for c in own]
        n, key = len(used), own[0]
        for k, c in enumerate(own[1:], 2):
            if n**k < 2**63:
                key = key * n + c
        to = np.argsort(key, kind="stable")
        if sorted_pairs(n, len(own)):
            own[:2] = [own[0] * n + own[1]]
            own[0] = rises(own[0][to])
            own[1:] = [c[to] for c in own[1:]]
        else:
            own = [c[to] for c in own]
        yield int(s), dump(rises(names[used]), *own, doc[at][to], times[at][to], learn)


def _dense(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, places = np.unique(key, return_inverse=True)
    return distinct, places.astype(np.int32)


class Shard:
    """The restaurants of one shard. Level k has rows (context of k words, word), sorted by room; level 0's rows are
    the words, whose customers are counted over all shards, as are the rooms that other shards share: in `buckets`
    and `shared_buckets`, which the hash of a name decides. The hashes themselves are sent there once and not kept."""

    def __init__(self, buckets: np.ndarray, counts: np.ndarray, rooms: list, parents: list, shared: list, shared_buckets: list) -> None:
        self.buckets, self.counts = buckets, counts
        self.rooms, self.parents, self.shared, self.shared_buckets = rooms, parents, shared, shared_buckets

    @classmethod
    def build(cls, pieces: list[bytes], layout: Layout) -> tuple[Shard, list[bytes], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The shard; for each piece its occurrences: deepest row, document, count; the hashes of words and
        shared rooms, and the words' learnt counts."""
        order = layout.order
        names = [np.cumsum(load(p, 1)[0], dtype=np.uint64) for p in pieces]
        vocabulary = np.unique(np.concatenate(names))
        columns: list[list[np.ndarray]] = [[] for _ in range(order)]
        weights, sizes, loaded = [], [], []
        for piece, own in zip(pieces, names, strict=True):
            x = load(piece)
            # numbers of words, documents and rows of a shard fit 31 bits; only products of them do not
            to = np.searchsorted(vocabulary, own).astype(np.int32)
            if sorted_pairs(len(own), order):
                x[1:2] = np.divmod(np.cumsum(x[1]), len(own))
            for c in range(order):
                columns[c].append(to[x[1 + c]])
            doc, times, learn = x[1 + order :]
            weights.append(times * learn[doc])
            sizes.append(len(doc))
            loaded.append((doc.astype(np.int32), dump(times)))
        del x, names
        word, ctx = np.concatenate(columns.pop()), []
        while columns:
            ctx.append(np.concatenate(columns.pop(0)))
        used = np.zeros(len(vocabulary), dtype=bool)
        used[word] = True
        word, names = (np.cumsum(used, dtype=np.int32) - np.int32(1))[word], vocabulary[used]
        weight = np.concatenate(weights).astype(np.float64)
        del weights
        known = np.bincount(word, weights=weight, minlength=len(names)).astype(np.int64)
        ways = layout.ways_of(vocabulary)
        rooms, parents, shared, shared_names = [], [], [], []
        row, room, chain = word, None, None
        for level, c in enumerate(ctx, 1):
            distinct, new = _dense(c if room is None else room * np.int64(len(vocabulary)) + c)
            del c
            ctx[level - 1] = None
            if room is None:
                before, at, split = np.zeros(len(distinct), dtype=np.uint64), distinct, ways[distinct] > 1
            else:
                up, at = np.divmod(distinct, len(vocabulary))
                before, split = chain[up], split[up]
            chain = mixed(before * _CHAIN + vocabulary[at] + np.uint64(level))
            room = new
            keys, new = _dense(room * np.int64(len(names)) + word)
            parent = np.empty(len(keys), dtype=np.int32)
            parent[new] = row
            row = new
            rooms.append(keys // len(names))
            parents.append(parent)
            mine = np.flatnonzero(split)
            mine = mine[np.argsort(chain[mine])]
            shared.append(mine)
            shared_names.append(chain[mine])
        counts = np.bincount(row, weights=weight, minlength=len(names) if not rooms else len(rooms[-1])).astype(np.int64)
        seen = []
        for (doc, times), own in zip(loaded, np.split(row, np.cumsum(sizes)[:-1]), strict=True):
            to = np.argsort(own, kind="stable")
            seen.append(dump(rises(own[to]), doc[to], load(times)[0][to]))
        shards = np.uint64(layout.shards)
        buckets, shared_buckets = (names % shards).astype(np.int64), [(h % shards).astype(np.int64) for h in shared_names]
        hashed = names, np.concatenate([np.zeros(0, dtype=np.uint64), *shared_names]), known
        return cls(buckets, counts, rooms, parents, shared, shared_buckets), seen, hashed

    def dump(self) -> bytes:
        levels = [x for k in range(len(self.rooms)) for x in (rises(self.rooms[k]), self.parents[k], self.shared[k], self.shared_buckets[k])]
        return dump(self.buckets, self.counts, *levels)

    @classmethod
    def load(cls, body: bytes) -> Shard:
        buckets, counts, *levels = load(body)
        return cls(buckets, counts, [np.cumsum(r) for r in levels[::4]], levels[1::4], levels[2::4], levels[3::4])

    @property
    def depth(self) -> int:
        return len(self.rooms)

    def start(self) -> list[np.ndarray]:
        """Tables of every local level: one for each word that has customers."""
        seats, customers = [], self.counts
        for level in range(self.depth, 0, -1):
            seats.insert(0, np.minimum(customers, 1))
            customers = self.lifted(level, seats[0])
        return seats

    def lifted(self, level: int, seats: np.ndarray) -> np.ndarray:
        """Customers of the rows of level - 1: the tables of their children."""
        n = len(self.buckets) if level == 1 else len(self.rooms[level - 2])
        return np.bincount(self.parents[level - 1], weights=seats, minlength=n).astype(np.int64)

    def customers(self, seats: list[np.ndarray]) -> list[np.ndarray]:
        """Customers of levels 1, 2, ... under these tables."""
        out = [self.counts]
        for level in range(self.depth, 1, -1):
            out.insert(0, self.lifted(level, seats[level - 1]))
        return out if self.depth else []

    def sums(self, seats: list[np.ndarray]) -> np.ndarray:
        """What this shard sends up: customers of each word at level 0."""
        return self.lifted(1, seats[0]) if self.depth else self.counts

    def totals(self, level: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.rooms[level - 1], weights=values).astype(np.int64)

    def joined(self, level: int, values: np.ndarray, over_all: list[np.ndarray]) -> np.ndarray:
        """Totals of the level's rooms; of the shared ones, over all shards."""
        out = self.totals(level, values)
        out[self.shared[level - 1]] = over_all[level - 1]
        return out

    def dump_seats(self, seats: list[np.ndarray]) -> bytes:
        """Tables beyond the first."""
        return dump(*[t - np.minimum(c, 1) for t, c in zip(seats, self.customers(seats), strict=True)])

    def load_seats(self, body: bytes) -> list[np.ndarray]:
        seats, customers = load(body), self.counts
        for level in range(self.depth, 0, -1):
            seats[level - 1] = seats[level - 1] + np.minimum(customers, 1)
            customers = self.lifted(level, seats[level - 1])
        return seats


def tables(customers: int, others: int, p: float, d: float, theta: float, rng: np.random.Generator) -> int:
    """Tables of `customers` seated one by one in a restaurant that has `others` tables of other words.

    The k-th customer (k from 0) opens a new table with probability a / (k - d t + a), a = (theta +
    d (others + t)) p, t the tables so far. The step of the next new table is drawn from the survival
    function prod (i - d t) / (i - d t + a) = G(j - d t) G(k - d t + a) / (G(k - d t) G(j - d t + a)).
    """
    if customers <= 0:
        return 0
    t, k = 1, 1
    while k < customers:
        a = (theta + d * (others + t)) * p
        x = k - d * t
        start = math.lgamma(x + a) - math.lgamma(x)
        mark = math.log(1.0 - rng.random())

        def log_survival(j: int) -> float:
            return math.lgamma(j - d * t) - math.lgamma(j - d * t + a) + start  # noqa: B023

        if log_survival(customers) >= mark:
            break
        low, high = k, customers  # log_survival(low) >= mark > log_survival(high)
        while high - low > 1:
            middle = (low + high) // 2
            if log_survival(middle) >= mark:
                low = middle
            else:
                high = middle
        t, k = t + 1, high
    return t


def seat(customers: np.ndarray, others: np.ndarray, p: np.ndarray, d: float, theta: float, rng: np.random.Generator) -> np.ndarray:
    """tables() of every row: all rows seat their k-th customers together, the few full ones jump."""
    out = np.minimum(customers, 1)
    for i in np.flatnonzero(customers > ONE_BY_ONE):
        out[i] = tables(int(customers[i]), int(others[i]), float(p[i]), d, theta, rng)
    at = np.flatnonzero((customers > 1) & (customers <= ONE_BY_ONE))
    at = at[np.argsort(-customers[at], kind="stable")]
    mine, other, prob = -customers[at], others[at].astype(np.float64), p[at]
    t = np.ones(len(at))
    k = 1
    while n := int(np.searchsorted(mine, -k)):  # rows with more than k customers
        now = t[:n]
        a = (theta + d * (other[:n] + now)) * prob[:n]
        now += rng.random(n) * (k - d * now + a) < a
        k += 1
    out[at] = t.astype(np.int64)
    return out
