"""Byte-level BPE over whole texts with a public vocabulary, in time linear in the text.

The bytes of a text map to Latin-1 characters, so that an Aho-Corasick automaton over the vocabulary
finds all tokens of a piece in one scan. The encoding then takes the longest token at each place and
steps back to a shorter one where two neighbours could not have come out of the merges next to each
other; that compatibility of two tokens is decided once and kept. The result equals the merges'.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.runtime import spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEPT_PIECES, KEPT_PAIRS, LONGEST_KEPT = 200_000, 1_000_000, 64


class Encoder:
    """Encodes text by a rank file (base64 token and rank a line; rank order is merge order)."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ids = {base64.b64decode(t).decode("latin-1"): int(r) for t, r in pairs}
        self.split_text = regex.compile(pattern).findall
        self.size = max(self.ids.values()) + 1
        self.lengths = [0] * self.size
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.lengths[i] = len(text)
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.joined: dict[tuple[int, int], int] = {}
        self.parts = [(i, i) for i in range(self.size)]
        self.fits: dict[tuple[int, int], bool] = {}
        self.shorter = [-1] * self.size  # the longest token that a token starts with, but itself
        for text, i in sorted(self.ids.items(), key=lambda x: x[1]):
            for k in range(len(text) - 1, 0, -1):
                if (head := self.ids.get(text[:k])) is not None:
                    self.shorter[i] = head
                    break
            for k in range(1, len(text)):
                a, b = self.ids.get(text[:k], self.size), self.ids.get(text[k:], self.size)
                if a < i and b < i and self._compatible(a, b):
                    self.parts[i] = (a, b)
                    self.joined[a, b] = i
                    break
        self.fits.clear()
        self.pieces: dict[str, list[int]] = {}

    def _compatible(self, a: int, b: int) -> bool:
        """Whether the merges can leave the tokens a and b side by side.

        Undoes the merges from the latest backwards; the pair falls if at some point a merge across
        the border would have come earlier than the one that was undone.
        """
        joined, parts, limit = self.joined, self.parts, self.size + 1
        while True:
            if joined.get((a, b), limit) < limit:
                return False
            left_first = a > b
            for left in (left_first, not left_first):
                if left and parts[a][1] != a:
                    limit, a = a, parts[a][1]
                    break
                if not left and parts[b][0] != b:
                    limit, b = b + 1, parts[b][0]
                    break
            else:
                return True

    def _fit(self, a: int, b: int) -> bool:
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) >= KEPT_PAIRS:
                self.fits.clear()
            known = self.fits[a, b] = self._compatible(a, b)
        return known

    def _merge(self, text: str) -> list[int]:
        """Tokens of one piece, given as Latin-1 characters."""
        if (whole := self.ids.get(text)) is not None:
            return [whole]
        lengths, shorter, n = self.lengths, self.shorter, len(text)
        longest = [-1] * n
        for end, i in self.automaton.iter(text):
            start = end + 1 - lengths[i]
            if longest[start] < 0 or lengths[i] > lengths[longest[start]]:
                longest[start] = i
        open_at = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        pos, token = 0, longest[0]
        while pos < n:
            while True:
                end = pos + lengths[token]
                if open_at[end] and (not out or self._fit(out[-1], token)):
                    out.append(token)
                    pos = end
                    token = longest[pos] if pos < n else -1
                    break
                if shorter[token] >= 0:
                    token = shorter[token]
                    continue
                open_at[pos] = 0  # no encoding passes here
                token = out.pop()
                pos -= lengths[token]
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; strings of special tokens are ordinary text; null and '' give no ids."""
        out: list[int] = []
        if not text:
            return out
        pieces = self.pieces
        for piece in self.split_text(text):
            ids = pieces.get(piece)
            if ids is None:
                ids = self._merge(piece.encode("utf-8").decode("latin-1"))
                if len(piece) <= LONGEST_KEPT:
                    if len(pieces) >= KEPT_PIECES:
                        pieces.clear()
                    pieces[piece] = ids
            out += ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str = PATTERN) -> Encoder:
    """The encoder of a rank file, built once a worker."""
    return Encoder(path, pattern)


def encode_corpus(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """`(doc_id, ids)` of every row, in whole; a null or empty text gives an empty list.

    Repeated rows and ids are encoded row by row; only the two named columns are read, so other
    columns cannot clash. `vocabulary` is a rank file that every worker can read; it is not shipped.
    """
    kind = documents.schema[doc_id].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            ids = [enc.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    source = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return spread(source).mapInArrow(run, f"doc_id {kind.simpleString()}, ids array<int>")
