"""Byte-level BPE: texts to token ids and back.

A text is cut into words by a fixed pattern; each word's bytes are merged pair by pair, lowest rank first, from a literal
map of byte strings to ranks. Words repeat, so every task folds a distinct word once and keeps its ids; what it keeps is
bounded in words and in bytes, and a word that fell out is folded again. Decoding joins the tokens' byte strings.

A null or empty text has no tokens. Rows are encoded one by one, so repeated rows and null ids give a row each.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame

from creditloom.llm.tasks import map_rows

#: Distinct words a task keeps with their packed ids, 100 MB or so, and the longest that it keeps.
KEPT_WORDS = 500_000
KEPT_CHARS = 64


def load_ranks(path: str) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the neighbouring pieces of lowest rank, the leftmost of equals, until no pair has a rank."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    pieces: list[bytes] = [word[i : i + 1] for i in range(len(word))]
    if len(pieces) > KEPT_CHARS:
        return _fold_long(pieces, ranks)
    found = [ranks.get(a + b) for a, b in zip(pieces, pieces[1:])]
    while True:
        best, at = None, -1
        for i, rank in enumerate(found):
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            return [ranks[p] for p in pieces]
        pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
        del found[at]
        if at:
            found[at - 1] = ranks.get(pieces[at - 1] + pieces[at])
        if at < len(found):
            found[at] = ranks.get(pieces[at] + pieces[at + 1])


def _fold_long(pieces: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """The same merges in n log n steps, with a heap of pairs over a linked list."""
    end = len(pieces)
    after, before = list(range(1, end + 1)), list(range(-1, end - 1))
    heap = [(rank, i, 2) for i in range(end - 1) if (rank := ranks.get(pieces[i] + pieces[i + 1])) is not None]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        if i >= 0 and after[i] < end and (rank := ranks.get(pair := pieces[i] + pieces[after[i]])) is not None:
            heapq.heappush(heap, (rank, i, len(pair)))

    while heap:
        rank, i, size = heapq.heappop(heap)
        if not pieces[i] or after[i] >= end or len(pieces[i]) + len(pieces[after[i]]) != size or ranks.get(pieces[i] + pieces[after[i]]) != rank:
            continue  # one of the two has been merged since
        gone = after[i]
        pieces[i], pieces[gone] = pieces[i] + pieces[gone], b""
        after[i] = after[gone]
        if after[gone] < end:
            before[after[gone]] = i
        offer(i)
        offer(before[i])
    return [ranks[p] for p in pieces if p]


class Codec:
    """Encodes and decodes with one vocabulary; lives in a task."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = load_ranks(path)
        self.pieces = {rank: token for token, rank in self.ranks.items()}
        self.words = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def ids(self, word: str) -> bytes:
        found = self.known.get(word)
        if found is None:
            found = packed(array("I", fold(word.encode("utf-8"), self.ranks)))
            if len(word) <= KEPT_CHARS:
                if len(self.known) >= KEPT_WORDS:
                    self.known.clear()
                self.known[word] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """The packed ids of a whole text."""
        return b"".join([self.ids(match[0]) for match in self.words.finditer(text or "")])

    def decode(self, data: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(data, dtype="<u4").tolist()))


def packed(ids: array) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    if array("H", [1]).tobytes() == b"\x01\x00":
        return ids.tobytes()
    swapped = array("I", ids)
    swapped.byteswap()
    return swapped.tobytes()


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df``'s other columns with ``ids``, the packed token ids of the whole text, and ``n_tokens``."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        codec = Codec(path, pattern)
        for *kept, body in rows:
            ids = codec.encode(body)
            yield (*kept, ids, len(ids) // 4)

    return _with(df, text, "ids binary, n_tokens bigint", work)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df``'s other columns with ``decoded``, the bytes that packed ids stand for; null ids decode to no bytes."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        pieces = {rank: token for token, rank in load_ranks(path).items()}
        for *kept, body in rows:
            yield (*kept, b"".join(map(pieces.__getitem__, np.frombuffer(body or b"", dtype="<u4").tolist())))

    return _with(df, ids, "decoded binary", work)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df``'s other columns with the digests of the ids and of the bytes they decode to; neither leaves its task."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        codec = Codec(path, pattern)
        for *kept, body in rows:
            ids = codec.encode(body)
            yield (*kept, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest())

    return _with(df, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", work)


def _with(df: DataFrame, column: str, added: str, work) -> DataFrame:
    taken = {column.lower()} | {x.split()[0] for x in added.split(", ")}
    kept = [(c, t) for c, t in df.dtypes if c.lower() not in taken]
    schema = ", ".join([*(f"`{c}` {t}" for c, t in kept), added])
    return map_rows(df.select(*(f"`{c}`" for c, _ in kept), f"`{column}`"), schema, work)
