"""Language-model scoring with bigram tries sharded by context.

Training n-grams are counted on Spark, shard by shard; each shard builds an
Elias-Fano trie of quantised, smoothed probabilities, memory-maps its levels
and answers the n-grams of the documents:

1. word counts give the training total, the vocabulary size, and the words so
   frequent that their children must be dealt to several shards;
2. documents are dealt into groups; a group sends each shard its distinct
   words and bigrams with their training counts, packed;
3. a shard adds up what all groups sent, builds its trie, and sends every
   group one code per word and bigram it asked for; of a dealt-out context it
   also tells how many distinct children it learned, which are added up over
   the shards;
4. a group puts the codes back to the positions of its texts and adds up
   ``log10(p(w | previous) + rest(previous) * p(w))``.

Bigrams are smoothed by absolute discounting, interpolated with the add-one
unigram. Groups and shards are sized by tokens, so their number grows with the
corpus and their memory does not. A group sends a row only to shards that hold
one of its n-grams: there are never more rows than distinct n-grams of groups.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoledger.llm.common import pieces, word_hashes
from cartoledger.llm.trie import Trie, dequantise, quantise
from cartoledger.session import stage, stage_with_metrics

DISCOUNT = 0.75
# Bytes of text per group and per shard.
PART_BYTES = 10_000_000
# A word with more than this share of a shard's tokens has its children dealt to several shards.
HOT_SHARE = 0.25
# No word with less than one of so many training tokens is dealt out: that bounds the table of such words.
HOT_WORDS = 1_000_000
_SEED = 10
END = np.uint64(0x656E64206F662074)  # hash that stands for the end of a text
_CHILD = np.uint64(16)  # children are named by the upper 48 bits of their hash


def tokens(data: bytes) -> np.ndarray:
    """Hashes of the lower-cased words and one end token."""
    return np.append(word_hashes(data.lower().split(), _SEED), END)


class Hot:
    """The words whose children are dealt out, sorted by hash: how often they occur, in how many shards, and their kinds."""

    def __init__(self, words: np.ndarray, n: np.ndarray, splits: np.ndarray) -> None:
        order = np.argsort(words)
        self.words, self.n, self.splits = words[order], n[order], splits[order]
        self.kinds = np.zeros(len(words), np.int64)

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the hashes that are hot, and their places in this table."""
        if not len(self.words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        found = np.flatnonzero(self.words[at] == hashes)
        return found, at[found]


class Group:
    """Distinct words and bigrams of a group of texts, in the order in which shards are asked; order of texts is free."""

    def __init__(self, texts: list[bytes], learn: list[bool], shards: int, hot: Hot) -> None:
        rows = [tokens(t) for t in texts]
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        everything = np.concatenate(rows)
        weight = np.repeat(np.array(learn, np.float64), self.sizes)
        self.words, self.word_at = np.unique(everything, return_inverse=True)
        self.word_count = np.bincount(self.word_at, weight, len(self.words)).astype(np.uint32)
        # Every token but a text's first has a bigram with the token before it.
        second = np.ones(len(everything), bool)
        second[self.starts] = False
        self.bigram_of = np.flatnonzero(second)
        size = np.int64(len(self.words))
        pairs = self.word_at[self.bigram_of - 1] * size + self.word_at[self.bigram_of]
        pairs, at = np.unique(pairs, return_inverse=True)
        count = np.bincount(at, weight[self.bigram_of], len(pairs)).astype(np.uint32)
        first, last = pairs // size, pairs % size

        home = (self.words % np.uint64(shards)).astype(np.int64)
        splits = np.ones(len(self.words), np.int64)
        found, place = hot.places(self.words)
        splits[found] = hot.splits[place]
        part = (self.words[last] & np.uint64(0xFFFF)).astype(np.int64) % splits[first]
        shard = (home[first] + part * 7919) % shards
        order = np.argsort(shard, kind="stable")
        self.pair_rank = np.empty(len(pairs), np.int64)  # place of each pair in shard order
        self.pair_rank[order] = np.arange(len(pairs))
        self.pair_at = self.pair_rank[at]
        self.pair_shard = shard[order]
        self.pair_first, self.pair_count = first[order], count[order]
        self.pair_child = self.words[last[order]] >> _CHILD
        # One context per run of equal first words inside a shard.
        change = np.ones(len(order), bool)
        change[1:] = (self.pair_first[1:] != self.pair_first[:-1]) | (self.pair_shard[1:] != self.pair_shard[:-1])
        self.context_start = np.flatnonzero(change)
        self.context_of = np.cumsum(change) - 1
        self.context_shard = self.pair_shard[self.context_start]
        self.context_word = self.pair_first[self.context_start]
        self.context_size = np.diff(np.append(self.context_start, len(order)))
        self.at_home = home[self.context_word] == self.context_shard
        self.word_order = np.argsort(home, kind="stable")
        self.word_shard = home[self.word_order]

    def slices(self) -> Iterator[tuple[int, slice, slice, slice]]:
        """Of each shard that is asked: its words, contexts and pairs."""
        asked = np.union1d(self.word_shard, self.pair_shard)
        cuts = [np.searchsorted(a, (asked, asked + 1)) for a in (self.word_shard, self.context_shard, self.pair_shard)]
        for i, shard in enumerate(asked.tolist()):
            yield shard, *(slice(int(c[0][i]), int(c[1][i])) for c in cuts)


_ASK = pa.schema(
    [("shard", pa.int32()), ("g", pa.int32())]
    + [(c, pa.binary()) for c in ("words", "word_counts", "children", "guests", "guest_children")]
    + [(c, pa.binary()) for c in ("child_low", "child_high", "counts")]
)
_REPLY = pa.schema([("g", pa.int32()), ("shard", pa.int32())] + [(c, pa.binary()) for c in ("counts", "rests", "codes")])


def _ask(table: pa.Table, shards: int, hot: Hot) -> pa.Table:
    """One row per shard that is asked.

    Contexts at home are named by their place among the words (``children`` has the number of bigrams of each word),
    only those dealt out to another shard by their hash (``guests``).
    """
    group = Group(table.column("text").to_pylist(), table.column("learn").to_pylist(), shards, hot)
    g = table.column("g")[0].as_py()
    rows = []
    for shard, words, contexts, pairs in group.slices():
        own = group.word_order[words]
        child = group.pair_child[pairs]
        context, size, home = group.context_word[contexts], group.context_size[contexts], group.at_home[contexts]
        children = np.zeros(len(own), np.uint32)
        children[np.searchsorted(own, context[home])] = size[home]
        rows.append(
            (
                shard,
                g,
                group.words[own].tobytes(),
                group.word_count[own].tobytes(),
                children.tobytes(),
                group.words[context[~home]].tobytes(),
                size[~home].astype(np.uint32).tobytes(),
                child.astype(np.uint32).tobytes(),
                (child >> np.uint64(32)).astype(np.uint16).tobytes(),
                group.pair_count[pairs].tobytes(),
            )
        )
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ASK, strict=True)], schema=_ASK)


def _contexts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts that the rows ask for, in their order (by hash), the number of bigrams of each, and of contexts per row."""
    contexts, sizes, per_row = [], [], []
    columns = [table.column(c) for c in ("words", "children", "guests", "guest_children")]
    for row in zip(*columns, strict=True):
        words, children, guests, more = (np.frombuffer(v.as_py(), k) for v, k in zip(row, (np.uint64, np.uint32) * 2, strict=True))
        some = children > 0
        context, size = np.concatenate((words[some], guests)), np.concatenate((children[some], more))
        order = np.argsort(context)
        contexts.append(context[order])
        sizes.append(size[order])
        per_row.append(len(context))
    return np.concatenate(contexts), np.concatenate(sizes), np.array(per_row, np.int64)


def _joined(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of a packed column and the number of values of each row."""
    parts = [np.frombuffer(v.as_py(), kind) for v in column]
    return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def _answer(table: pa.Table, hot: Hot) -> pa.Table:
    """Build the trie of one shard from what all groups sent, and answer each of them.

    One more row, of group -1, tells the learned children of the dealt-out contexts here: their hashes and numbers.
    """
    words, word_sizes = _joined(table.column("words"), np.uint64)
    word_counts, _ = _joined(table.column("word_counts"), np.uint32)
    _, at = np.unique(words, return_inverse=True)
    totals = np.bincount(at, word_counts) if len(at) else np.zeros(0)
    answered = totals[at].astype(np.uint64)

    contexts, children, context_sizes = _contexts(table)
    low, pair_sizes = _joined(table.column("child_low"), np.uint32)
    high, _ = _joined(table.column("child_high"), np.uint16)
    counts, _ = _joined(table.column("counts"), np.uint32)
    child, child_at = np.unique(low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32)), return_inverse=True)
    del low, high
    context, context_at = np.unique(contexts, return_inverse=True)
    keys = np.repeat(context_at, children) * np.int64(max(1, len(child))) + child_at
    keys, pair_at = np.unique(keys, return_inverse=True)
    seen = np.bincount(pair_at, counts, len(keys))
    owner, own_child = keys // max(1, len(child)), keys % max(1, len(child))

    learned = seen > 0
    sums = np.bincount(owner, seen, len(context))
    kinds = np.bincount(owner, learned, len(context))
    whole = sums.copy()
    # A shard holds some of the children of a dealt-out context only, perhaps none that was learned.
    parted, place_hot = hot.places(context)
    whole[parted] = hot.n[place_hot]
    known = sums > 0
    place = np.cumsum(known) - 1
    probability = np.maximum(seen - DISCOUNT, 0)[learned] / whole[owner[learned]]
    with tempfile.TemporaryDirectory() as folder:
        trie = Trie(
            folder,
            context[known],
            DISCOUNT * kinds[known] / sums[known],
            place[owner[learned]],
            own_child[learned],
            probability,
        )
        found = trie.find(context)
        rests = trie.rests(found)[context_at]
        codes = trie.codes(found[owner], own_child)[pair_at]
        del trie
    shard = table.column("shard")[0].as_py()
    rows, at = [(-1, shard, context[parted].tobytes(), b"", kinds[parted].astype(np.uint32).tobytes())], [0, 0, 0]
    for i, (g, shard) in enumerate(zip(table.column("g").to_pylist(), table.column("shard").to_pylist(), strict=True)):
        parts = []
        for k, (values, sizes) in enumerate(((answered, word_sizes), (rests, context_sizes), (codes, pair_sizes))):
            parts.append(values[at[k] : at[k] + sizes[i]].tobytes())
            at[k] += sizes[i]
        rows.append((g, shard, *parts))
    return pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _REPLY, strict=True)], schema=_REPLY
    )


_SCORES = pa.schema(
    [("doc_id", pa.int64()), ("learn", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
    + [("base_score", pa.float64()), ("score", pa.float64())]
)


def _score(docs: pa.Table, replies: pa.Table, shards: int, hot: Hot, total: int, kinds: int) -> pa.Table:
    if not docs.num_rows:
        return _SCORES.empty_table()
    group = Group(docs.column("text").to_pylist(), docs.column("learn").to_pylist(), shards, hot)
    counts = np.zeros(len(group.words), np.float64)
    rests = np.zeros(len(group.context_start), np.uint8)
    codes = np.zeros(len(group.pair_first), np.uint8)
    by_shard = {s.as_py(): i for i, s in enumerate(replies.column("shard"))}
    columns = [replies.column(c) for c in ("counts", "rests", "codes")]
    for shard, words, contexts, pairs in group.slices():
        i = by_shard[shard]
        counts[group.word_order[words]] = np.frombuffer(columns[0][i].as_py(), np.uint64)
        rests[contexts] = np.frombuffer(columns[1][i].as_py(), np.uint8)
        codes[pairs] = np.frombuffer(columns[2][i].as_py(), np.uint8)
    # The weight of a dealt-out context for unseen words is that of its children in all shards.
    parted, place = hot.places(group.words[group.context_word])
    rests[parted] = quantise(DISCOUNT * hot.kinds[place] / hot.n[place])
    base = (counts + 1) / (total + kinds + 1)
    p = base[group.word_at]
    logs = np.log10(p)
    base_score = np.add.reduceat(logs, group.starts)
    at = group.bigram_of
    mixed = dequantise(codes)[group.pair_at] + dequantise(rests)[group.context_of][group.pair_at] * p[at]
    logs[at] = np.log10(np.minimum(mixed, 1.0))
    return pa.Table.from_arrays(
        [
            docs.column("doc_id"),
            docs.column("learn"),
            pa.array(group.sizes),
            pa.array(np.add.reduceat((counts > 0)[group.word_at].astype(np.int64), group.starts)),
            pa.array(base_score),
            pa.array(np.add.reduceat(logs, group.starts)),
        ],
        schema=_SCORES,
    )


def _word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of the training texts, added up inside each batch before the shuffle."""
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 32_000_000):
            words, n = np.unique(np.concatenate([tokens(t) for t in batch.column("text").to_pylist()]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], schema=schema)

    counted = docs.where("learn").select("text").mapInArrow(run, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _told_kinds(replies: DataFrame, hot: Hot) -> np.ndarray:
    """Number of distinct learned children of each dealt-out word, added up over the shards that hold some of them."""
    schema = pa.schema([("word", pa.int64()), ("kinds", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, kinds in zip(batch.column("counts"), batch.column("codes"), strict=True):
                columns = np.frombuffer(words.as_py(), np.int64), np.frombuffer(kinds.as_py(), np.uint32).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    told = replies.where("g = -1").select("counts", "codes").mapInArrow(run, "word long, kinds long")
    table = told.groupBy("word").agg(F.sum("kinds").alias("kinds")).toArrow()  # at most HOT_WORDS rows
    out = np.zeros(len(hot.words), np.int64)
    found, place = hot.places(table.column("word").to_numpy().view(np.uint64))
    out[place] = table.column("kinds").to_numpy()[found]
    return out


def score(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_bytes: int = PART_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """``(doc_id, learn, n_tokens, n_known, train_tokens, base_score, score)``, one row per row of ``docs``.

    The model learns from the rows where ``learn`` is true (null: false).
    Tokens are lower-cased words and one end token, so a null or empty text
    has one token. ``base_score`` is the add-one unigram log10 probability,
    ``score`` the model's. Repeated rows are learned and scored as often as
    they occur; without training rows both scores are those of a uniform word.
    """
    own = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("binary"), F.lit(b"")).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    measured = own.agg(F.sum(F.length("text").cast("long") + 8).alias("bytes")).first()
    parts = max(1, math.ceil((measured["bytes"] or 0) / part_bytes))
    counted = [F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total")]
    vocabulary, known = stage_with_metrics(_word_counts(own), "lm_words", counted)
    kinds, total = known["kinds"], known["total"] or 0
    limit = max(1, int(hot_share * total / parts), total // HOT_WORDS)
    often = vocabulary.where(F.col("n") > limit).toArrow()  # fewer than HOT_WORDS rows
    n = often.column("n").to_numpy()
    hot = Hot(often.column("word").to_numpy().view(np.uint64), n, np.minimum(parts, -(-n // limit)))

    dealt = own.withColumn("g", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int"))
    asks = dealt.groupBy("g").applyInArrow(
        lambda t: _ask(t, parts, hot),
        "shard int, g int, words binary, word_counts binary, children binary, guests binary, guest_children binary, "
        "child_low binary, child_high binary, counts binary",
    )
    replies = asks.groupBy("shard").applyInArrow(
        lambda t: _answer(t, hot), "g int, shard int, counts binary, rests binary, codes binary"
    )
    replies = stage(replies, "lm_replies")
    hot.kinds = _told_kinds(replies, hot)
    scored = (
        dealt.groupBy("g")
        .cogroup(replies.where("g >= 0").groupBy("g"))
        .applyInArrow(
            lambda a, b: _score(a, b, parts, hot, total, kinds),
            "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double",
        )
    )
    return scored.select(
        "doc_id", "learn", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
