"""Byte-level BPE encoding and decoding by a rank queue.

A text is cut by the pre-token pattern; inside a pre-token, adjacent tokens
merge in the order of the rank of their joined bytes, leftmost first. The
pairs wait in a queue of one bucket per rank: a two-level hierarchy of bitmaps names the
least rank in use by find-first-set, its bucket gives the leftmost position in
the linked list of tokens, and entries whose pair has changed since are
skipped. A pre-token of n bytes costs O(n log n) however long it is. One of few
bytes has no queue: the least rank of its pairs is looked up anew each time.
"""

from __future__ import annotations

import base64
import os
import struct
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartoledger.llm.common import pieces

# Ranks to a bitmap: 2 ** WORD_BITS.
WORD_BITS = 8
WORD_MASK = (1 << WORD_BITS) - 1
# A vocabulary travels to every worker, so its file is bounded.
MAX_FILE_BYTES = 64_000_000
# Pre-tokens remembered per task: at most so many, none longer than so many characters.
REMEMBERED = 400_000
REMEMBERED_CHARS = 64
# Bytes of a pre-token whose positions fit a bitmap.
SHORT = 256
# Bytes of a pre-token whose pairs are looked through for the least rank: below that many a queue costs more than it saves.
TINY = 32
# Above every rank: no token for a pair.
NONE = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of ``base64 rank`` lines on the driver."""
    size = os.path.getsize(path)
    if size > MAX_FILE_BYTES:
        raise ValueError(f"{path}: {size} bytes are over the limit of {MAX_FILE_BYTES} for a vocabulary")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    lacking = [b for b in range(256) if bytes([b]) not in ranks]
    if lacking:
        raise ValueError(f"{path}: no token for the bytes {lacking}")
    if len(set(ranks.values())) != len(ranks) or min(ranks.values()) < 0:
        raise ValueError(f"{path}: ranks are not distinct non-negative numbers")
    return ranks


class RankQueue:
    """Positions by rank; ``pop`` gives the leftmost position of the least rank.

    ``words`` marks the ranks in use, 256 to a bitmap, and ``top`` the bitmaps in use.
    """

    __slots__ = ("top", "words", "buckets")

    def __init__(self) -> None:
        self.top = 0
        self.words: dict[int, int] = {}
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, at: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, at)
            return
        self.buckets[rank] = [at]
        word = rank >> WORD_BITS
        known = self.words.get(word, 0)
        if not known:
            self.top |= 1 << word
        self.words[word] = known | 1 << (rank & WORD_MASK)

    def pop(self) -> tuple[int, int] | None:
        if not self.top:
            return None
        word = (self.top & -self.top).bit_length() - 1
        bits = self.words[word]
        least = bits & -bits
        rank = word << WORD_BITS | least.bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self.buckets[rank]
        self.words[word] = bits ^ least
        if bits == least:
            self.top &= self.top - 1
        return rank, bucket[0]


class Encoder:
    """Encodes texts by ``ranks``; keeps the ids of short pre-tokens it has met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.singles = [ranks[bytes([b])] for b in range(256)]
        self.doubles = [[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)]
        self.pairs = {(a, b): rank for a, of in enumerate(self.doubles) for b, rank in enumerate(of) if rank >= 0}
        # The queue of short pre-tokens, empty between them: bitmaps of ranks, and of positions per rank.
        size = max(ranks.values()) + 1
        self.words = [0] * ((size >> WORD_BITS) + 1)
        self.places = [0] * size
        self.bit = [1 << i for i in range(max(WORD_MASK + 1, SHORT, len(self.words)))]
        self.known: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) <= TINY:
            return self._merge_tiny(piece)
        return self._merge_short(piece) if len(piece) <= SHORT else self._merge_long(piece)

    def _merge_tiny(self, piece: bytes) -> list[int]:
        """No queue: the leftmost least of the ranks of all pairs, again and again."""
        rank_of, singles, pair_of = self.ranks.get, self.singles, self.pairs.get
        ids = [singles[b] for b in piece]
        starts = list(range(len(piece) + 1))
        pair = [pair_of(p, NONE) for p in zip(piece, piece[1:])]
        while pair and (rank := min(pair)) != NONE:
            at = pair.index(rank)
            ids[at] = rank
            del ids[at + 1], starts[at + 1], pair[at]
            if at < len(pair):
                pair[at] = rank_of(piece[starts[at] : starts[at + 2]], NONE)
            if at:
                pair[at - 1] = rank_of(piece[starts[at - 1] : starts[at + 1]], NONE)
        return ids

    def _merge_short(self, piece: bytes) -> list[int]:
        """The queue with positions in bitmaps too, written out where it is used: most pre-tokens are short."""
        rank_of, n = self.ranks.get, len(piece)
        words, places, bit, singles, doubles = self.words, self.places, self.bit, self.singles, self.doubles
        ids = [singles[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [doubles[a][b] for a, b in zip(piece, piece[1:])]
        pair.append(-1)
        top = 0
        for at, rank in enumerate(pair):
            if rank >= 0:
                held = places[rank]
                places[rank] = held | bit[at]
                if not held:
                    word = rank >> WORD_BITS
                    words[word] |= bit[rank & WORD_MASK]
                    top |= bit[word]
        while top:
            word = (top & -top).bit_length() - 1
            bits = words[word]
            least = bits & -bits
            rank = (word << WORD_BITS) + least.bit_length() - 1
            held = places[rank]
            first = held & -held
            places[rank] = held ^ first
            if held == first:
                words[word] = bits ^ least
                if bits == least:
                    top ^= bit[word]
            at = first.bit_length() - 1
            if pair[at] != rank:
                continue
            gone = after[at]
            end = after[gone]
            ids[at] = rank
            after[at] = end
            pair[gone] = pair[at] = -1
            if end < n:
                before[end] = at
                rank = rank_of(piece[at : after[end]])
                if rank is not None:
                    pair[at] = rank
                    held = places[rank]
                    places[rank] = held | bit[at]
                    if not held:
                        word = rank >> WORD_BITS
                        words[word] |= bit[rank & WORD_MASK]
                        top |= bit[word]
            if at:
                at = before[at]
                rank = rank_of(piece[at:end])
                if rank is None:
                    pair[at] = -1
                else:
                    pair[at] = rank
                    held = places[rank]
                    places[rank] = held | bit[at]
                    if not held:
                        word = rank >> WORD_BITS
                        words[word] |= bit[rank & WORD_MASK]
                        top |= bit[word]
        out, at = [], 0
        while at < n:
            out.append(ids[at])
            at = after[at]
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        """The queue with positions in a heap per rank."""
        rank_of, n = self.ranks.get, len(piece)
        queue = RankQueue()
        push, pop = queue.push, queue.pop
        ids = [self.singles[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # Rank of the pair that starts at a position now; an entry of the queue that says another rank is stale.
        pair: list[int | None] = [None] * n
        for at in range(n - 1):
            rank = rank_of(piece[at : at + 2])
            if rank is not None:
                pair[at] = rank
                push(rank, at)
        while (least := pop()) is not None:
            rank, at = least
            if pair[at] != rank:
                continue
            gone = after[at]
            end = after[gone]
            ids[at] = rank
            after[at] = end
            pair[gone] = None
            if end < n:
                before[end] = at
                pair[at] = rank = rank_of(piece[at : after[end]])
                if rank is not None:
                    push(rank, at)
            else:
                pair[at] = None
            if at:
                left = before[at]
                pair[left] = rank = rank_of(piece[left:end])
                if rank is not None:
                    push(rank, left)
        out, at = [], 0
        while at < n:
            out.append(ids[at])
            at = after[at]
        return out

    def _packed(self, piece: str) -> bytes:
        ids = self.merge(piece.encode())
        found = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= REMEMBERED_CHARS:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        known = self.known.get
        return b"".join([known(p) or self._packed(p) for p in self.split(text)])


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` per row of ``docs``; ``ids`` packs the ids as little-endian 32-bit words.

    No special tokens: their strings in a text are ordinary text. A null text
    is an empty text and has no token; a null id is carried; repeated rows give
    repeated results; other columns are dropped; bytes that are no UTF-8 count
    as U+FFFD. A text is encoded whole and costs memory in proportion to its
    own length. ``unpacked`` turns ``ids`` into an array.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Encoder(shared.value, pattern)
        for batch in pieces(batches, "text"):
            ids = [own.encode(t.decode("utf-8", "replace")) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    text = F.coalesce(docs[text_col].cast("binary"), F.lit(b""))
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
    return own.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(tokens: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", data_col: str = "data") -> DataFrame:
    """The rows of ``tokens`` and, as ``data``, the bytes that the packed ids of a row stand for.

    Null ids give null bytes. An id that the vocabulary lacks is an error.
    """
    if data_col.lower() in (c.lower() for c in tokens.columns):
        raise ValueError(f"column {data_col} is taken")
    vocabulary = tokens.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})
    at = tokens.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = vocabulary.value.__getitem__
        for batch in pieces(batches, ids_col):
            data = [
                None if ids is None else b"".join(map(token, np.frombuffer(ids, "<u4").tolist()))
                for ids in batch.column(at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(data, pa.binary())], names=[*batch.schema.names, data_col]
            )

    return tokens.mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField(data_col, T.BinaryType())]))


def unpacked(tokens: DataFrame, ids_col: str = "ids") -> DataFrame:
    """The rows of ``tokens`` with the packed ids as ``array<long>``."""
    at = tokens.columns.index(ids_col)
    fields = [T.StructField(f.name, T.ArrayType(T.LongType()) if i == at else f.dataType) for i, f in enumerate(tokens.schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, ids_col):
            lists = [None if b is None else np.frombuffer(b, "<u4").astype(np.int64) for b in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(lists, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return tokens.mapInArrow(run, T.StructType(fields))
