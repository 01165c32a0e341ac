"""Cross-tokenizer alignment by an associative monoid of byte-range fragments.

Two vocabularies cut one text into tokens; where a token of each ends at the same byte both are cut,
and the tokens between two such common ends form a group. A document is cut into byte-range pieces at
single spaces (both vocabularies start a token there), and each piece yields a fragment: an open prefix
(tokens up to its first common end, whose group may have begun in an earlier piece), closed groups, and
an open suffix (tokens after its last common end). Fragments compose associatively. Inside a task a
piece's fragment is composed from those of its words, each distinct word encoded once a batch; the
pieces of a very long document are combined by a tree of Spark aggregations, `FANOUT` fragments a task
and level, never all of them in one task. The pairs of tokens that end together (links) are counted
corpus-wide by an aggregation; each link then learns its pair's count and whether it is the most
frequent pair of its B token, from a copy of the pair counts beside each bounded share of the documents.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.bpe import byte_characters
from matchlake.llm.columns import settle
from matchlake.llm.ragged import gather
from matchlake.session import new_scratch

# characters of text a piece holds before it is cut at the next single space between non-spaces
PIECE_CHARS = 1 << 18
# fragments composed by one task at each level of the tree
FANOUT = 64
# characters of pieces encoded at once in a task: bounds the encoders' working memory, whatever the batch
ENCODE_CHARS = 1 << 20
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
# what \s matches besides the space
OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
# words, and characters of words, that a task remembers
REMEMBERED, REMEMBERED_CHARS = 300_000, 1 << 23
# characters of words encoded in one go
GO_CHARS = 1 << 15
# links (distinct in their piece) scored by one task, beside at most so many pair counts
SHARE_LINKS, SHARE_PAIRS = 6_000_000, 2_000_000

FRAGMENT = T.StructType([
    T.StructField("_key", T.LongType()), T.StructField("_piece", T.LongType()), T.StructField("_ok", T.BooleanType()),
    T.StructField("_na", T.LongType()), T.StructField("_nb", T.LongType()), T.StructField("_closed", T.BooleanType()),
    T.StructField("_pre_a", T.StringType()), T.StructField("_pre_b", T.StringType()),
    T.StructField("_groups", T.StringType()), T.StructField("_ngroups", T.LongType()),
    T.StructField("_suf_a", T.StringType()), T.StructField("_suf_b", T.StringType()),
])
FIELDS = [f.name for f in FRAGMENT.fields]
INTS = T.ArrayType(T.IntegerType())
# what a task gives of a piece: its document's number of pieces, the digest of the groups where that is one (the groups'
# text is then left out), and the distinct links with the number of times each comes
PIECE = [T.StructField("_pieces", T.LongType()), T.StructField("_sha", T.StringType()), T.StructField("_la", INTS),
         T.StructField("_lb", INTS), T.StructField("_lk", INTS)]


class Vocabularies:
    """Encoders and the bytes of every token of A (`tokenizers` byte-level) and B (sentencepiece)."""

    def __init__(self, a_path: str, b_path: str) -> None:
        # a task has its own cores: the library's thread pool would only spin beside the other tasks
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        back = {c: b for b, c in enumerate(byte_characters())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)

    def encode(self, pieces: list[str]) -> list[tuple[np.ndarray, np.ndarray, bool]]:
        """(A ids, B ids, ok) of pieces that each begin with one space; ok: both join to the piece's bytes."""
        a_ids = [np.array(e.ids, dtype=np.int64) for e in self.a.encode_batch(pieces, add_special_tokens=False)]
        b_ids = [np.array(x, dtype=np.int64) for x in self.b.encode([p[1:] for p in pieces], num_threads=1)]
        out = []
        for piece, a, b in zip(pieces, a_ids, b_ids, strict=True):
            raw = piece.encode()
            ok = b"".join(self.a_bytes[i] for i in a) == raw and b"".join(self.b_bytes[i] for i in b) == raw
            out.append((a, b, ok))
        return out


@cache
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def cut(text: str, size: int = PIECE_CHARS) -> list[str]:
    """' ' + text in pieces that each begin with a space; a piece is cut only at a space between non-spaces."""
    whole, pieces, start = " " + text, [], 0
    while len(whole) - start > size:
        found = SAFE_CUT.search(whole, start + size)
        if found is None:
            break
        pieces.append(whole[start:found.start()])
        start = found.start()
    pieces.append(whole[start:])
    return pieces


def _ids(values: np.ndarray) -> str:
    return ",".join(map(str, values.tolist()))


def _join(left: str, right: str, mark: str = ",") -> str:
    return f"{left}{mark}{right}" if left and right else left or right


def common_ends(vocab: Vocabularies, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offsets where tokens of both end, and the number of A and of B tokens up to each."""
    a_end, b_end = np.cumsum(vocab.a_len[a]), np.cumsum(vocab.b_len[b])
    common = np.intersect1d(a_end, b_end, assume_unique=True)
    return common, np.searchsorted(a_end, common, side="right"), np.searchsorted(b_end, common, side="right")


def fragment(vocab: Vocabularies, a: np.ndarray, b: np.ndarray) -> dict:
    """The fragment of one piece's tokens: counts, open prefix, closed groups and open suffix."""
    common, a_cut, b_cut = common_ends(vocab, a, b)
    if not len(common):
        return {"_na": len(a), "_nb": len(b), "_closed": False, "_pre_a": _ids(a), "_pre_b": _ids(b),
                "_groups": "", "_ngroups": 0, "_suf_a": "", "_suf_b": ""}
    groups = [
        f"{_ids(a[a_cut[k - 1]:a_cut[k]])}|{_ids(b[b_cut[k - 1]:b_cut[k]])}" for k in range(1, len(common))
    ]
    return {
        "_na": len(a), "_nb": len(b), "_closed": True,
        "_pre_a": _ids(a[:a_cut[0]]), "_pre_b": _ids(b[:b_cut[0]]),
        "_groups": ";".join(groups), "_ngroups": len(groups),
        "_suf_a": _ids(a[a_cut[-1]:]), "_suf_b": _ids(b[b_cut[-1]:]),
    }


def compose(left: dict, right: dict) -> dict:
    """The fragment of two adjacent ones, left then right: associative."""
    out = {"_na": left["_na"] + right["_na"], "_nb": left["_nb"] + right["_nb"], "_ok": left["_ok"] and right["_ok"]}
    if not left["_closed"] and not right["_closed"]:
        return out | {"_closed": False, "_pre_a": _join(left["_pre_a"], right["_pre_a"]),
                      "_pre_b": _join(left["_pre_b"], right["_pre_b"]), "_groups": "", "_ngroups": 0,
                      "_suf_a": "", "_suf_b": ""}
    if not right["_closed"]:
        return out | {k: left[k] for k in ("_closed", "_pre_a", "_pre_b", "_groups", "_ngroups")} | {
            "_suf_a": _join(left["_suf_a"], right["_pre_a"]), "_suf_b": _join(left["_suf_b"], right["_pre_b"])}
    if not left["_closed"]:
        return out | {k: right[k] for k in ("_closed", "_groups", "_ngroups", "_suf_a", "_suf_b")} | {
            "_pre_a": _join(left["_pre_a"], right["_pre_a"]), "_pre_b": _join(left["_pre_b"], right["_pre_b"])}
    middle = f"{_join(left['_suf_a'], right['_pre_a'])}|{_join(left['_suf_b'], right['_pre_b'])}"
    return out | {
        "_closed": True, "_pre_a": left["_pre_a"], "_pre_b": left["_pre_b"],
        "_groups": _join(_join(left["_groups"], middle, ";"), right["_groups"], ";"),
        "_ngroups": left["_ngroups"] + 1 + right["_ngroups"], "_suf_a": right["_suf_a"], "_suf_b": right["_suf_b"],
    }


def words(text: str) -> list[str]:
    """The text cut at every single space between non-spaces."""
    if "  " in text or text[:1] == " " or text[-1:] == " " or any(
            c in text and (f" {c}" in text or f"{c} " in text) for c in OTHER_SPACE):
        return SAFE_CUT.split(text)
    return text.split(" ")


class Words:
    """Fragments of distinct words, as far as remembered: a word that both vocabularies join to its bytes ends at a
    common end, so its fragment is groups only, written a,a|b;a|b,b as in the result."""

    def __init__(self, vocab: Vocabularies) -> None:
        self.vocab = vocab
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.text: list[str] = []
        # per word: A tokens, B tokens, groups (-1: not joined to its bytes); links: last A and B id of each group
        self.counts = np.zeros((0, 3), dtype=np.int64)
        self.first = np.zeros(1, dtype=np.int64)
        self.links = np.zeros((0, 2), dtype=np.int64)

    def learn(self, wanted: list[str]) -> None:
        unknown = list(dict.fromkeys(w for w in wanted if w not in self.number))
        if len(self.number) + len(unknown) > REMEMBERED or self.chars + sum(map(len, unknown)) > REMEMBERED_CHARS:
            self.forget()
            unknown = list(dict.fromkeys(wanted))
        counts, links, go, size = [], [], [], 0
        for k, word in enumerate(unknown):
            go.append(word)
            size += len(word) + 1
            # words with white space at an end are not safe beside others
            alone = word[:1].isspace() or word[-1:].isspace() or not word
            if alone and len(go) > 1:
                self._encode(go[:-1], counts, links)
                go = [word]
            if alone or size >= GO_CHARS or k + 1 == len(unknown):
                self._encode(go, counts, links)
                go, size = [], 0
        self.number.update(zip(unknown, range(len(self.number), len(self.number) + len(unknown)), strict=True))
        self.chars += sum(map(len, unknown))
        self.counts = np.concatenate([self.counts, *counts])
        self.first = np.r_[0, np.cumsum(np.maximum(self.counts[:, 2], 0))]
        self.links = np.concatenate([self.links, *links])

    def _encode(self, go: list[str], counts: list[np.ndarray], links: list[np.ndarray]) -> None:
        """Appends texts, counts and links of words that may stand beside each other."""
        v = self.vocab
        (a, b, ok), = v.encode([" " + " ".join(go)])
        if ok:
            common, a_cut, b_cut = common_ends(v, a, b)
            ends = np.cumsum([len(w.encode()) + 1 for w in go])
            last = np.searchsorted(common, ends)
            ok = bool((last < len(common)).all()) and bool((common[last] == ends).all())
        if not ok:
            if len(go) == 1:
                self.text.append("")
                counts.append(np.array([[0, 0, -1]]))
                return
            half = len(go) // 2
            self._encode(go[:half], counts, links)
            self._encode(go[half:], counts, links)
            return
        a_text, b_text = [str(i) for i in a.tolist()], [str(i) for i in b.tolist()]
        groups, x, y = [], 0, 0
        for i, j in zip(a_cut.tolist(), b_cut.tolist(), strict=True):
            groups.append(f"{a_text[x] if i - x == 1 else ','.join(a_text[x:i])}|{b_text[y] if j - y == 1 else ','.join(b_text[y:j])}")
            x, y = i, j
        last = last + 1
        self.text += [";".join(groups[i:j]) for i, j in zip([0, *last[:-1].tolist()], last.tolist(), strict=True)]
        counts.append(np.diff(np.c_[a_cut[last - 1], b_cut[last - 1], last], axis=0, prepend=np.zeros((1, 3), dtype=np.int64)))
        links.append(np.c_[a[a_cut - 1], b[b_cut - 1]])


@cache
def word_fragments(a_path: str, b_path: str) -> Words:
    return Words(vocabularies(a_path, b_path))


def fragments(keyed: DataFrame, a_path: str, b_path: str, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One fragment row (with its row's _doc) per piece of every (_key, _doc, _text) row; no shuffle.

    Pieces are encoded and emitted ENCODE_CHARS characters at a time, so a task holds the encodings of
    about that much text, not of its whole input batch.
    """
    schema = T.StructType([T.StructField("_doc", keyed.schema["_doc"].dataType), *FRAGMENT.fields, *PIECE])
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}

    def emit(known: Words, docs: pa.Array, pending: list[tuple[int, int, int, int, str]]) -> pa.RecordBatch:
        cuts = [words(piece[1:]) for *_, piece in pending]
        known.learn([w for cut_words in cuts for w in cut_words])
        sizes = np.array([len(c) for c in cuts])
        which = np.fromiter((known.number[w] for c in cuts for w in c), dtype=np.int64, count=int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        counts = np.add.reduceat(np.maximum(known.counts[which], 0), starts)
        # a piece of an empty text has no tokens either
        ok = (np.minimum.reduceat(known.counts[which, 2], starts) >= 0) & np.array([len(piece) > 1 for *_, piece in pending])
        rows = []
        for n, (_, key, k, pieces, _) in enumerate(pending):
            text = ";".join([known.text[w] for w in which[starts[n] : starts[n] + sizes[n]].tolist()]) if ok[n] else ""
            sha = hashlib.sha256(text.encode()).hexdigest() if ok[n] and pieces == 1 else ""
            head, _, rest = ("", "", "") if pieces == 1 else text.partition(";")
            pre_a, _, pre_b = head.partition("|")
            n_a, n_b, n_groups = counts[n].tolist() if ok[n] else (0, 0, 1)
            # every word ends at a common end: no open suffix
            rows.append((key, k, bool(ok[n]), n_a, n_b, bool(ok[n]), pre_a, pre_b, rest, n_groups - 1, "", "", pieces, sha))
        owner = np.repeat(np.arange(len(pending)), sizes)
        good = ok[owner]
        word, owner = which[good], owner[good]
        many = known.first[word + 1] - known.first[word]
        pair = gather(known.links, known.first[word], many)
        b_size = len(known.vocab.b_len)
        links, times = np.unique(np.repeat(owner, many) * (len(known.vocab.a_len) * b_size) + pair[:, 0] * b_size + pair[:, 1], return_counts=True)
        owner, links = np.divmod(links, len(known.vocab.a_len) * b_size)
        offsets = pa.array(np.searchsorted(owner, np.arange(len(pending) + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (links // b_size, links % b_size, times)]
        columns = zip(zip(*rows, strict=True), [*FRAGMENT.fields, *PIECE[:2]], strict=True)
        return pa.RecordBatch.from_arrays([
            docs.take(pa.array([at for at, *_ in pending], pa.int64())),
            *[pa.array(values, kinds[f.dataType.simpleString()]) for values, f in columns], *lists,
        ], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_fragments(a_path, b_path)
        for batch in batches:
            pending, size = [], 0
            for at, (key, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                pieces = cut(text or "", piece_chars)
                for k, piece in enumerate(pieces):
                    pending.append((at, key, k, len(pieces), piece))
                    size += len(piece)
                    if size >= ENCODE_CHARS:
                        yield emit(known, batch.column(1), pending)
                        pending, size = [], 0
            if pending:
                yield emit(known, batch.column(1), pending)

    return keyed.select("_key", "_doc", "_text").mapInArrow(run, schema)


def reduce_level(frags: DataFrame) -> DataFrame:
    """One level of the tree: FANOUT adjacent fragments of a document become one."""
    def fold(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("_piece").to_dict("records")
        done = rows[0]
        for row in rows[1:]:
            done = compose(done, row)
        done |= {"_key": rows[0]["_key"], "_piece": rows[0]["_piece"] // FANOUT}
        return pd.DataFrame([done], columns=FIELDS)

    return frags.groupBy("_key", (F.col("_piece") / FANOUT).cast("long").alias("_parent")).applyInPandas(fold, FRAGMENT)


def scored_links(links: DataFrame, entries: int) -> DataFrame:
    """(_key, _n_best, _count_sum) of rows (_key, _piece, _la, _lb, _lk) with `entries` links in all, counted over all rows.

    Pieces are dealt out in shares of about SHARE_LINKS links; each share meets a copy of the pair counts, itself
    cut where it has more than SHARE_PAIRS pairs.
    """
    pairs = links.select(F.explode(F.arrays_zip("_la", "_lb", "_lk")).alias("_l")).groupBy(
        F.col("_l._la").alias("_a"), F.col("_l._lb").alias("_b")).agg(F.sum("_l._lk").alias("_c"))
    pairs = settle(pairs)
    best = pairs.groupBy("_b").agg(F.max("_c").alias("_top"))
    counted = pairs.join(best, "_b").select("_a", "_b", "_c", (F.col("_c") == F.col("_top")).alias("_best"))
    shares, parts = 1 + entries // SHARE_LINKS, 1 + pairs.count() // SHARE_PAIRS
    left = links.withColumn("_share", F.pmod(F.xxhash64("_key", "_piece"), F.lit(shares))).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    right = counted.withColumn("_part", F.pmod(F.xxhash64("_a", "_b"), F.lit(parts)).cast("long")).withColumn(
        "_share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))

    def score(mine: pa.Table, known: pa.Table) -> pa.Table:
        keys, codes, sums = mine["_key"].to_numpy(), known["_a"].to_numpy().astype(np.int64) << 32 | known["_b"].to_numpy(), []
        order = np.argsort(codes)
        codes, count, top = codes[order], known["_c"].to_numpy()[order], known["_best"].to_numpy()[order]
        if len(codes):
            for la, lb, lk in zip(mine["_la"].chunks, mine["_lb"].chunks, mine["_lk"].chunks, strict=True):
                sizes = la.value_lengths().to_numpy()
                times = lk.flatten().to_numpy().astype(np.int64)
                wanted = la.flatten().to_numpy().astype(np.int64) << 32 | lb.flatten().to_numpy()
                at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
                times = np.where(codes[at] == wanted, times, 0)
                upto, ends = np.r_[0, np.cumsum(times * top[at])], np.cumsum(sizes)
                total = np.r_[0, np.cumsum(times * count[at])]
                sums.append(np.c_[upto[ends] - upto[ends - sizes], total[ends] - total[ends - sizes]])
        done = np.concatenate([np.zeros((0, 2), dtype=np.int64), *sums]) if len(codes) else np.zeros((len(keys), 2), dtype=np.int64)
        return pa.table({"_key": pa.array(keys, pa.int64()), "_n_best": pa.array(done[:, 0], pa.int64()), "_count_sum": pa.array(done[:, 1], pa.int64())})

    met = left.groupBy("_share", "_part").cogroup(right.groupBy("_share", "_part")).applyInArrow(
        score, "_key long, _n_best long, _count_sum long")
    return met.groupBy("_key").agg(F.sum("_n_best").alias("_n_best"), F.sum("_count_sum").alias("_count_sum"))


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
          piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A: ' ' + text by `a_path`; B: text by `b_path` (which adds the space); special strings are text.
    - Null or empty text, or a text whose A or B token bytes do not join to ' ' + text: zeros and ''.
    - Links are the A-B token pairs that end at the same byte; a pair's count is the number of links
      corpus-wide that hold it; n_best counts links whose count is the highest of their B id (ties too).
    - Null and repeated doc_ids and repeated rows are separate rows; other columns are left aside
      whatever their names. An empty table gives no rows.
    """
    keyed = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).withColumn("_key", F.monotonically_increasing_id())
    # keys are drawn in the same task that encodes, and written with the fragments: no copy of the texts is stored. Columns
    # of few distinct ids are far smaller as Parquet than as checkpointed rows
    path = new_scratch(docs.sparkSession, "alignment")
    fragments(keyed, a_path, b_path, piece_chars).write.option("compression", "zstd").parquet(path)
    frags = docs.sparkSession.read.parquet(path)
    entries, most = frags.agg(F.sum(F.size("_la")), F.max("_piece")).first()
    # only documents of several pieces go up the tree; the others are whole already
    done = frags.where("_pieces = 1").select("_key", "_doc", "_ok", "_na", "_nb", "_ngroups", "_sha")
    links = frags.where("_pieces = 1").select("_key", "_piece", "_la", "_lb", "_lk")
    if most:
        tall = frags.where("_pieces > 1")
        open_ = tall.select(FIELDS)
        while most > 0:
            open_ = settle(reduce_level(open_))
            most //= FANOUT
        groups = F.concat_ws(";", F.concat_ws("|", "_pre_a", "_pre_b"), F.when(F.col("_groups") != "", F.col("_groups")))
        open_ = open_.withColumn("_sha", F.sha2(groups, 256))
        done = done.unionByName(tall.where("_piece = 0").select("_key", "_doc").join(
            open_.select("_key", "_ok", "_na", "_nb", "_ngroups", "_sha"), "_key"))
        # links of a text count only where all of its pieces are joined to their bytes
        links = links.unionByName(tall.select("_key", "_piece", "_la", "_lb", "_lk").join(open_.where("_ok").select("_key"), "_key"))
    out = done.join(scored_links(links, entries or 0), "_key", "left")
    ok = F.col("_ok")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("_doc").alias(doc_id),
        F.when(ok, F.col("_na")).otherwise(zero).alias("n_a"),
        F.when(ok, F.col("_nb")).otherwise(zero).alias("n_b"),
        F.when(ok, F.col("_ngroups") + 1).otherwise(zero).alias("n_groups"),
        F.when(ok, F.col("_ngroups") + 1).otherwise(zero).alias("n_links"),
        F.coalesce(F.col("_n_best"), zero).cast("long").alias("n_best"),
        F.coalesce(F.col("_count_sum"), zero).cast("long").alias("count_sum"),
        F.when(ok, F.col("_sha")).otherwise(F.lit("")).alias("groups_sha256"),
    )


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    )
