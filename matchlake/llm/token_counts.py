"""Token counts by rank-synchronous merges over ragged arrays."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.bpe import byte_length, merges
from matchlake.llm.ragged import CHUNK_BYTES

# the split rule of byte-level vocabularies, a fixed value, and the mark that stands between texts here
PRE_TOKEN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\0]+|\s+(?!\S)|\s+|\0"""
)
# for these characters the class tables of both regular-expression libraries agree
KNOWN = re.compile(r"[\0\t-\r -~¡-ɏ]*")
# distinct words that a worker remembers before it starts anew
REMEMBERED = 600_000
# in place of a word's count: its text is not cut into words
UNSAFE = -(1 << 40)
BATCH_WORDS = 400_000
TOKEN_LIMIT = 512


@cache
def library(path: str):  # noqa: ANN201
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class TokenCounter:
    """Counts as the `tokenizers` library gives them, without begin, end or added special tokens.

    Special strings inside a text are one token each, as the library does by default. Texts are cut at
    single spaces, where a pre-token always begins; each distinct word's pre-tokens are merged once.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        self.bpe = merges(path)
        special = [t.content for t in library(path).get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(regex.escape(s) for s in special)) if special else None
        self.special_mark = [s[:2] for s in special]
        self.known: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str]:
        spans = library(self.path).pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in spans]

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, none of which holds a special string: merged anew, nothing remembered."""
        if not texts:
            return np.zeros(0, dtype=np.int64)
        whole = "\0".join(texts)
        if KNOWN.fullmatch(whole) and not any(t[-1:].isspace() for t in texts):
            # all texts are split at once; what stands between them is no part of any rule
            pieces = PRE_TOKEN.findall(whole)
            pieces.append("\0")
        else:
            pieces = [p for t in texts for p in ([*PRE_TOKEN.findall(t), "\0"] if KNOWN.fullmatch(t) and "\0" not in t else [*self.pre_tokens(t), "\0"])]
        mark = np.fromiter((p == "\0" for p in pieces), dtype=bool, count=len(pieces))
        if mark.sum() != len(texts):
            return np.concatenate([self.counts([t]) for t in texts]) if len(texts) > 1 else self.alone(texts[0])
        inner = [p for p in pieces if p != "\0"]
        _, sizes = self.bpe.merge("".join(inner).encode(), np.fromiter(map(byte_length, inner), np.int64, len(inner)))
        each = np.zeros(len(pieces), dtype=np.int64)
        each[~mark] = sizes
        return np.diff(np.cumsum(each)[mark], prepend=0)

    def alone(self, text: str) -> np.ndarray:
        """A text that holds the mark itself."""
        pieces = self.pre_tokens(text)
        _, sizes = self.bpe.merge("".join(pieces).encode(), np.fromiter(map(byte_length, pieces), np.int64, len(pieces)))
        return sizes.sum(keepdims=True)

    def learn(self, words: list[str]) -> None:
        unknown = list(set(words) - self.known.keys())
        if len(self.known) + len(unknown) > REMEMBERED:
            self.known.clear()
            unknown = list(set(words))
        # beside more white space the split rule cuts a space run elsewhere
        self.known.update(dict.fromkeys((w for w in unknown if w[1:2].isspace() or w[-1:].isspace()), UNSAFE))
        unknown = [w for w in unknown if w not in self.known]
        for k in range(0, len(unknown), BATCH_WORDS):
            part = unknown[k : k + BATCH_WORDS]
            self.known.update(zip(part, self.counts(part).tolist(), strict=True))

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text. A word is what a single space precedes, with that space."""
        totals = np.zeros(len(texts), dtype=np.int64)
        plain: list[tuple[int, str]] = []
        for k, whole in enumerate(texts):
            parts = [whole]
            if self.special and any(m in whole for m in self.special_mark):
                parts = self.special.split(whole)
                totals[k] += len(parts) - 1
            plain += [(k, p) for p in parts if p]
        if not plain:
            return totals
        words: list[str] = []
        sizes: list[int] = []
        for _, text in plain:
            own = text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text, ""]
            words += own
            sizes.append(len(own))
        self.learn(words)
        each = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        sums = np.add.reduceat(each, np.cumsum([0, *sizes[:-1]]))
        odd = np.flatnonzero(sums < 0)
        sums[odd] = self.counts([plain[k][1] for k in odd])
        np.add.at(totals, [k for k, _ in plain], sums)
        return totals


@cache
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(
    docs: DataFrame, path: str, limit: int = TOKEN_LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit.

    Null or empty text: 0 bytes, 0 tokens. Null and repeated doc_ids and repeated rows are kept as
    they are. Other columns are left aside. An empty table gives no rows. No shuffle; a task holds one
    Arrow batch and a bounded table of words.
    """
    key_type = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField(doc_id, key_type), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            step = max(1, len(texts) * CHUNK_BYTES // max(1, texts.nbytes))
            for k in range(0, len(texts), step):
                part = [t or "" for t in texts.slice(k, step).to_pylist()]
                n_bytes = pa.array([len(t.encode()) for t in part], pa.int64())
                tokens = pa.array(counter(path)(part), pa.int64())
                yield pa.RecordBatch.from_arrays([ids.slice(k, step), n_bytes, tokens], names=[doc_id, "n_bytes", "n_tokens"])

    counted = docs.select(F.col(doc_id), F.col(text).alias("text")).mapInArrow(count, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
