"""Benchmark decontamination by SimHash windows and a multi-index over Hamming blocks.

For each benchmark item, document windows of the item's own size (in words) get
a SimHash over their word shingles; a document shorter than the item is one
window as a whole. Eight byte blocks index the items' SimHashes:
two that differ in at most ``radius`` bits differ in at most ``radius // 8``
bits in some block, and every such block value is listed, so no fingerprint
within the radius is missed. Candidates are verified by the exact weighted
Jaccard similarity of the shingles (each weighs as often as it occurs).

Only windows that hold enough benchmark shingles to reach the similarity at all
are fingerprinted; that bound is exact, so it drops no match.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoledger.llm.common import mix64, ngram_hashes, pieces, text_of, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
# Four standard deviations above the bits that a similarity of 0.8 is expected to flip.
RADIUS = 20
BLOCKS = 8
_RUN = 2048


def shingles(data: bytes, size: int = SHINGLE) -> np.ndarray:
    """Hash of each run of ``size`` lower-cased words; a shorter text is one shingle, no word gives none."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    return mix64(ngram_hashes(word_hashes(words), min(size, len(words))))


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _pack(ones: np.ndarray, n: int) -> np.ndarray:
    """SimHashes from the counts of set bits among ``n`` shingles each."""
    return np.packbits(2 * ones > n, axis=-1, bitorder="little").view(np.uint64).reshape(-1)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two bags."""
    common = sum((a & b).values())
    whole = sum(a.values()) + sum(b.values()) - common
    return common / whole if whole else 0.0


class Index:
    """Fingerprints, block lists and shingle bags of one bounded block of benchmark items."""

    def __init__(self, items: list[tuple[int, bytes]], size: int, threshold: float, radius: int) -> None:
        self.size, self.threshold, self.radius = size, threshold, radius
        per_block = radius // BLOCKS
        values = np.arange(256, dtype=np.uint8)
        close = np.bitwise_count(values[:, None] ^ values[None, :]) <= per_block
        by_words: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        everything = []
        for item, text in items:
            n = len(text.split())
            if n:
                own = shingles(text, size)
                by_words[n].append((item, own))
                everything.append(own)
        self.known = np.unique(np.concatenate(everything)) if everything else np.zeros(0, np.uint64)
        bits = max(16, int(len(self.known) * 16).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[(self.known & self.mask).astype(np.int64)] = True
        self.sizes = []
        for n, group in sorted(by_words.items()):
            prints = np.concatenate([_pack(_bits(own).sum(axis=0, dtype=np.int64), len(own)) for _, own in group])
            blocks = prints.view(np.uint8).reshape(-1, BLOCKS)
            lists = close[:, blocks]  # block value, item, block: may the item be near
            self.sizes.append((n, [i for i, _ in group], prints, lists, [Counter(own.tolist()) for _, own in group]))

    def hits(self, own: np.ndarray) -> np.ndarray:
        """Mask of the shingles that some item has."""
        found = self.maybe[(own & self.mask).astype(np.int64)]
        at = np.flatnonzero(found)
        if len(at):
            place = np.minimum(np.searchsorted(self.known, own[at]), len(self.known) - 1)
            found[at] = self.known[place] == own[at]
        return found

    def matches(self, data: bytes) -> list[tuple[int, float, int, int, int]]:
        """``(item, similarity, start word, words, bits apart)``: the best window of each item found in a text."""
        words = data.lower().split()
        hashes = word_hashes(words)
        best: dict[int, tuple] = {}
        by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n, items, prints, lists, bags in self.sizes:
            k = min(self.size, n)
            size = min(n, len(words))  # an item longer than the text meets the whole text
            inside = size - k + 1  # shingles of a window
            least = math.ceil(self.threshold * (n - k + 1) - 1e-9)
            if inside < max(1, least):
                break
            if k not in by_length:
                own = mix64(ngram_hashes(hashes, k))
                found = self.hits(own)
                by_length[k] = own, np.concatenate(([0], np.cumsum(found))) if found.any() else None
            own, sums = by_length[k]
            if sums is None:
                continue
            starts = np.flatnonzero(sums[inside:] - sums[:-inside] >= least)
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                for at in range(0, len(run), _RUN):
                    part = run[at : at + _RUN]
                    if not len(part):
                        continue
                    first = int(part[0])
                    piece = own[first : int(part[-1]) + inside]
                    ones = np.concatenate((np.zeros((1, 64), np.int64), np.cumsum(_bits(piece), axis=0, dtype=np.int64)))
                    sums_ = ones[inside:] - ones[:-inside]
                    marks = _pack(sums_, inside)
                    values = marks.view(np.uint8).reshape(-1, BLOCKS)
                    near = np.zeros((len(marks), len(items)), bool)
                    for b in range(BLOCKS):
                        near |= lists[values[:, b], :, b]
                    apart = np.bitwise_count(marks[:, None] ^ prints[None, :])
                    for w, i in zip(*np.nonzero(near & (apart <= self.radius)), strict=True):
                        bag = Counter(piece[w : w + inside].tolist())
                        score = similarity(bag, bags[i])
                        if score >= self.threshold:
                            row = (items[i], score, first + int(w), size, int(apart[w, i]))
                            old = best.get(items[i])
                            if old is None or (-row[1], row[2]) < (-old[1], old[2]):
                                best[items[i]] = row
        return list(best.values())


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[int, bytes]]]:
    """Benchmark items in blocks of about ``block_words`` words (cut by a running total, so every block is bounded)."""
    own = text_of(benchmark, id_col, text_col).where("doc_id is not null and length(text) > 0")
    words = F.size(F.split(F.col("text").cast("string"), "[\\x20\\x09-\\x0D]+"))
    total = own.agg(F.coalesce(F.sum(words), F.lit(0)).alias("n")).first()["n"]
    n = max(1, math.ceil(total / block_words))
    for block in range(n):
        part = own if n == 1 else own.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)) == block)
        yield [(r["doc_id"], bytes(r["text"])) for r in part.distinct().orderBy("doc_id", "text").toLocalIterator()]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    size: int = SHINGLE,
    threshold: float = SIMILARITY,
    radius: int = RADIUS,
    block_words: int = 500_000,
) -> DataFrame:
    """``(doc_id, item_id, similarity, start_word, n_words, bits)``: the best window of each item in each document.

    The benchmark is the stated query set: it is searched in blocks of bounded
    size, each sent to the executors and held against all documents. Items and
    documents without a word match nothing; an item with more words than a
    document is held against the whole document; null ids of items are passed over;
    an item repeated under several ids matches under each; repeated rows of
    ``docs`` give repeated results.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64())]
        + [("start_word", pa.int64()), ("n_words", pa.int64()), ("bits", pa.int32())]
    )
    plain = text_of(docs, id_col, text_col)
    out = None
    for items in _blocks(benchmark, item_col, "text", block_words):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, size, threshold, radius)
            for batch in pieces(batches, "text"):
                rows = [
                    (doc_id, *match)
                    for doc_id, text in zip(
                        batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True
                    )
                    for match in index.matches(text)
                ]
                columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, schema.field(i).type) for i, c in enumerate(columns)], schema=schema
                )

        found = plain.mapInArrow(
            run, "doc_id long, item_id long, similarity double, start_word long, n_words long, bits int"
        )
        out = found if out is None else out.union(found)
    return out


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    size: int = SHINGLE,
    threshold: float = SIMILARITY,
    radius: int = RADIUS,
    block_words: int = 500_000,
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns unchanged; one pass per block, no shuffle."""
    schema, at = docs.schema, docs.columns.index(text_col)
    for items in _blocks(benchmark, item_col, "text", block_words):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, size, threshold, radius)
            for batch in batches:
                if batch.num_rows:
                    texts = batch.column(at).cast(pa.binary())
                    yield batch.filter(pa.array([not index.matches(t.as_py() or b"") for t in texts], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
