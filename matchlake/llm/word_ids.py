"""Token ids of a vocabulary with word ends, one lookup per distinct word."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import numpy as np
import regex

from matchlake.llm.bpe import byte_length, merges
from matchlake.llm.ragged import gather
from matchlake.llm.token_counts import library

# the split rule of this vocabulary, a fixed value, and the line break that stands between words here
PIECE = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n""")
# words of these characters are split here; all others go to the library
KNOWN = re.compile(r"[\n!-~¡-ɏ]*")
# Python splits at these control characters, the vocabulary's rule does not
CONTROL = re.compile("[\x1c-\x1f]")
REMEMBERED = 900_000


def plain(text: str) -> bool:
    """The text is split as the library does, and holds no special string."""
    return "<|" not in text and KNOWN.fullmatch(text) is not None


class WordIds:
    """Ids as the `tokenizers` library gives them without added special tokens.

    The vocabulary drops white space, so a text's ids are those of its words in turn.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        self.bpe = merges(path)
        self.forget()
        ends = [i for token, i in self.bpe.vocab.items() if re.fullmatch(r"[^\w\s]*[.!?][^\w\s]*</w>", token)]
        self.sentence_end = np.zeros(max(self.bpe.vocab.values()) + 1, dtype=bool)
        self.sentence_end[ends] = True

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.uint16)
        self.first = np.zeros(1, dtype=np.int64)

    def learn(self, words: list[str]) -> None:
        unknown = list(set(words) - self.number.keys())
        if len(self.number) + len(unknown) > REMEMBERED:
            self.forget()
            unknown = list(set(words))
        if not unknown:
            return
        own, other = unknown, []
        if not plain("\n".join(own)):
            own = [w for w in unknown if plain(w)]
            other = [w for w in unknown if not plain(w)]
        # a line break composes with nothing, so all words are normalised and split at once
        pieces = PIECE.findall(unicodedata.normalize("NFC", "\n".join(own)).lower())
        if own:
            pieces.append("\n")
        at = {p: k for k, p in enumerate(dict.fromkeys(["\n", *pieces]))}
        distinct = list(at)[1:]
        flat, sizes = self.bpe.merge("".join(distinct).encode(), np.fromiter(map(byte_length, distinct), np.int64, len(distinct)))
        sizes = np.r_[0, sizes]
        starts = np.cumsum(sizes) - sizes
        which = np.fromiter(map(at.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        sums = np.cumsum(sizes[which])
        lengths = np.diff(sums[which == 0], prepend=0)
        ids = gather(flat, starts[which], sizes[which])
        if other:
            encoded = [e.ids for e in library(self.path).encode_batch(other, add_special_tokens=False)]
            ids = np.r_[ids, np.array([i for e in encoded for i in e], dtype=np.int64)]
            lengths = np.r_[lengths, np.array([len(e) for e in encoded], dtype=np.int64)]
        base = len(self.number)
        self.number.update(zip(own + other, range(base, base + len(unknown)), strict=True))
        self.ids = np.r_[self.ids, ids.astype(np.uint16)]
        self.first = np.r_[self.first, self.first[-1] + np.cumsum(lengths)]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        words: list[str] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        odd = {k: t for k, t in enumerate(texts) if CONTROL.search(t)}
        for k, text in enumerate(texts):
            own = text.split() if k not in odd else []
            words += own
            counts[k] = len(own)
        self.learn(words)
        which = np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))
        sizes = np.diff(self.first)[which]
        ids = gather(self.ids, self.first[which], sizes)
        sums, ends = np.r_[0, np.cumsum(sizes)], np.cumsum(counts)
        lengths = sums[ends] - sums[ends - counts]
        if odd:
            parts = np.split(ids, np.cumsum(lengths)[:-1])
            for k, text in odd.items():
                parts[k] = np.array(library(self.path).encode(text, add_special_tokens=False).ids, dtype=np.uint16)
                lengths[k] = len(parts[k])
            ids = np.concatenate(parts)
        return ids, lengths


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
