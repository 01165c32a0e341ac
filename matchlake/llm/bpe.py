"""Byte-pair merges of many sequences at once, held as ragged numpy arrays."""

from __future__ import annotations

import json
from functools import cache

import numpy as np

NO_RANK = np.int32(2**31 - 1)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
    return [names[b] for b in range(256)]


class Merges:
    """The vocabulary and merge ranks of a `tokenizers` BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        names = byte_characters()
        self.byte_id = np.array([self.vocab[c] for c in names], dtype=np.int32)
        self.last_byte_id = np.array([self.vocab[c + suffix] for c in names], dtype=np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([self.vocab[p[k]] for p in pairs], dtype=np.uint64) for k in (0, 1))
        self.merged = np.array([self.vocab[a + b] for a, b in pairs] or [0], dtype=np.int32)
        keys = (left << np.uint64(32)) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        # most pairs are found, or known to be absent, by the first slot of a sparse table
        self.shift = np.uint64(64 - 20)
        self.table = np.full(1 << 20, -1, dtype=np.int32)
        self.table[self._slot(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair; NO_RANK where the pair does not merge."""
        if not len(self.keys):
            return np.full(len(left), NO_RANK, dtype=np.int32)
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        entry = self.table[self._slot(keys)]
        found = self.keys[entry] == keys
        other = np.flatnonzero((entry >= 0) & ~found)
        if len(other):
            entry[other] = np.minimum(np.searchsorted(self.keys, keys[other]), len(self.keys) - 1)
            found[other] = self.keys[entry[other]] == keys[other]
        return np.where(found & (entry >= 0), self.ranks[entry], NO_RANK)

    def merge(self, data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) after all merges of byte strings, which come joined; none of them is empty.

        In each round every sequence applies its lowest-ranked pair, at all places, from the left.
        Sequences without a pair to merge leave the arrays.
        """
        if not len(lengths):
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        data = np.frombuffer(data, dtype=np.uint8)
        symbol = self.byte_id[data]
        last = np.cumsum(lengths) - 1
        symbol[last] = self.last_byte_id[data[last]]
        owner = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
        rank = np.full(len(symbol), NO_RANK, dtype=np.int32)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.rank(symbol[inner], symbol[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(symbol)])
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            over = least == NO_RANK
            if over.any():
                done.append((symbol[over], owner[over]))
                stay = ~over
                symbol, owner, rank, least = symbol[stay], owner[stay], rank[stay], least[stay]
                if not len(symbol):
                    break
            hit = rank == least
            at = np.flatnonzero(hit)
            # of a run a a a the pairs overlap: every second one counts, from the left
            run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
            nth = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[nth % 2 == 0]
            symbol[at] = self.merged[rank[at]]
            stay = np.ones(len(symbol), dtype=bool)
            stay[at + 1] = False
            at -= np.arange(len(at))
            symbol, owner, rank = symbol[stay], owner[stay], rank[stay]
            beside = np.zeros(len(symbol), dtype=bool)
            beside[at] = True
            beside[np.maximum(at, 1) - 1] = True
            touched = np.flatnonzero(beside)
            rank[touched] = NO_RANK
            touched = touched[touched + 1 < len(symbol)]
            touched = touched[owner[touched] == owner[touched + 1]]
            rank[touched] = self.rank(symbol[touched], symbol[touched + 1])
        symbol = np.concatenate([s for s, _ in done])
        owner = np.concatenate([o for _, o in done])
        return symbol[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(lengths))


def byte_length(piece: str) -> int:
    return len(piece) if piece.isascii() else len(piece.encode())


@cache
def merges(path: str) -> Merges:
    """One table per worker process."""
    return Merges(path)
