"""Line deduplication by an exact set-similarity join; DataFrame functions only.

A line is the set of its words, each named by 64 bits of its hash. Words are
ordered by rarity (frequency class, then hash); two sets of similarity ``t`` or
more share a word among the first ``n - ceil(t * n) + 1`` of each (prefix
filter), and sizes and positions of the shared word bound the overlap still
possible (length and positional filters), and parity bits the difference. All
of them are part of the condition of the posting join, so only pairs that pass
leave it. These are verified on their whole sets. A line goes if an earlier
line (smaller doc_id, then line number) has at least the similarity: one such
line is enough, so lines settled by the earliest line like them need no other
partner, and a large family of similar lines is not spread out into its pairs.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from itertools import accumulate
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoledger.session import stage

# Frequency classes belong to hash buckets of words: a table of fixed size.
BUCKETS = 1 << 17
# Between the words of class 0 and those of the next: no word is of an odd class, so the mark is none itself.
MARK = 1 << 56
# Line numbers are ints.
LINES = 1 << 31
# Words to a key by which a line set meets the earliest set like it.
LEADER_WORDS = 3
# A key of so many sets has HEADS heads besides the earliest set.
LARGE_KEY = 8
HEADS = 16
# Words of 64 bits that mark the lines to verify, or the large keys: a table of fixed size.
MARKS = 1 << 17
# Similarity threshold as a fraction.
SIMILARITY = (4, 5)
_BLANKS = "\t\x0b\x0c\r"
_PLACE = ("doc_id", "line_no")
_PARITY = ("parity", "parity_2")


def _spaced(text: Column) -> Column:
    """The text with every blank but the line feed as a space; texts without one are not rewritten."""
    return F.when(text.rlike(f"[{_BLANKS}]"), F.translate(text, _BLANKS, " " * len(_BLANKS))).otherwise(text)


def _hashes(line: Column) -> Column:
    """Hashes of the distinct words of a spaced line, ascending."""
    hashed = F.transform(F.split(line, " "), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_distinct(F.array_remove(hashed, F.xxhash64(F.lit("")))))


def _bucket(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def frequency_classes(docs: DataFrame) -> Column:
    """Frequency class of each word bucket, as a constant array.

    Classes are even bytes, four to a doubling, and half of all words are of
    class 0 or below. Counts the words of all lines; partial sums leave each
    task, and the table has ``BUCKETS`` entries at any scale. Blanks but the
    space are not looked for here: a word beside one counts with it.
    """
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    counted = lines.select(F.explode(F.split("line", " ")).alias("word")).select(_bucket(F.xxhash64("word")).alias("bucket"))
    counted = counted.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    levels, sizes = [0] * BUCKETS, Counter()
    for row in counted.select("bucket", "n", F.round(4 * F.log2("n")).cast("int").alias("level")).collect():
        levels[row["bucket"]] = row["level"]
        sizes[row["level"]] += row["n"]
    upto = list(accumulate(sizes[level] for level in sorted(sizes)))
    middle = next((level for level, n in zip(sorted(sizes), upto) if 2 * n >= upto[-1]), 0)
    classes = (min(max(2 * (level - middle), -128), 126) for level in levels)
    return F.split(F.lit(",".join(map(str, classes))), ",").cast("array<tinyint>")


def _ranks(line: Column, classes: Column) -> Column:
    """Ranks of the distinct words of a spaced line and the mark, ascending: the class, then 56 bits of the hash."""
    rank = lambda h: F.shiftleft(F.get(classes, _bucket(h)).cast("long"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))
    hashed = F.transform(F.split(line, " "), lambda w: F.xxhash64(w))
    words = F.transform(F.array_remove(hashed, F.xxhash64(F.lit(""))), rank)
    return F.sort_array(F.array_append(F.array_distinct(words), F.lit(MARK)))


def _parity(words: Column) -> Column:
    """64 bits, of which each word flips one."""
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(words, F.lit(0).cast("long"), lambda s, h: s.bitwiseXOR(bit(h)))


def _leader_keys(below: Column) -> Column:
    """Keys of the rarest words and of two runs of words on each side of the mark, before which ``below`` words lie.

    A key names several words, common or rare: sets that share one are mostly alike, and like sets mostly share one.
    """
    k = LEADER_WORDS
    ends = [
        F.slice("words", 1, k),
        F.slice("words", F.greatest(below - k + 1, F.lit(1)), F.least(below, F.lit(k))),
        F.slice("words", below + 1, k),
        F.slice("words", F.greatest(below - 2 * k + 1, F.lit(1)), F.greatest(F.least(below - k, F.lit(k)), F.lit(0))),
        F.slice("words", below + k + 1, k),
    ]
    return F.array_compact(F.array(*[F.when(F.size(e) > 0, F.xxhash64(F.lit(i), e)) for i, e in enumerate(ends)]))


def _sets(docs: DataFrame, classes: Column, num: int, den: int) -> DataFrame:
    """One row per distinct word set: its first place, size, parity bits and prefix in order of rarity.

    Each word flips one of 128 parity bits, so two sets differ in at least as many words as bits;
    words up to class 0 have 64 of them, the others the rest.

    Equal sets (all copies of a line, however many) meet here as partial
    aggregates, so no later step sees a group of copies.
    """
    sets = (
        docs.select("doc_id", F.posexplode(F.split(_spaced(F.col("text")), "\n")).alias("line_no", "line"))
        .where(F.trim("line") != "")
        .select("doc_id", "line_no", _ranks(F.col("line"), classes).alias("marked"))
        .select(
            "doc_id",
            "line_no",
            F.array_remove("marked", F.lit(MARK)).alias("words"),
            (F.array_position("marked", F.lit(MARK)) - 1).cast("int").alias("below"),
        )
    )
    n = F.size("words")
    # A set can only resemble another one if a set one larger may: t * (n + 1) <= n.
    alone = num * (n + 1) > den * n
    prefix = F.slice("words", 1, F.when(alone, 0).otherwise(n - F.ceil(n * num / den).cast("int") + 1))
    # Postings carry 32 bits of a word's hash: two words that share them add candidates, none is lost.
    short = F.transform(prefix, lambda r: (r.bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(1 << 31)).cast("int"))
    leaders = F.when(alone, F.array().cast("array<long>")).otherwise(_leader_keys(F.col("below")))
    described = sets.select(
        F.xxhash64("words").alias("s1"),
        F.xxhash64(F.lit(1), "words").alias("s2"),
        n.cast("int").alias("n"),
        _parity(F.slice("words", 1, F.col("below"))).alias("parity"),
        _parity(F.slice("words", F.col("below") + 1, n)).alias("parity_2"),
        short.alias("prefix"),
        leaders.alias("leaders"),
        _place_number().alias("place"),
    )
    # All but the place follows from the set, so it may stand in the key; a number as the place lets the groups meet by hash, unsorted.
    first = described.groupBy([c for c in described.columns if c != "place"]).agg(F.min("place").alias("place"))
    return first.select(*_place_of(F.col("place")), "n", *_PARITY, "prefix", "leaders")


def _place_number() -> Column:
    """``doc_id`` and ``line_no`` as one number of the same order."""
    return F.col("doc_id").cast("decimal(20,0)") * F.lit(LINES).cast("decimal(10,0)") + F.col("line_no").cast("decimal(10,0)")


def _place_of(place: Column) -> list[Column]:
    line = F.pmod(place, F.lit(LINES).cast("decimal(10,0)"))
    doc = F.call_function("div", place - line, F.lit(LINES).cast("decimal(10,0)"))
    return [doc.alias("doc_id"), line.cast("int").alias("line_no")]


def _apart(a: str, b: str) -> Column:
    """Parity bits in which two sets differ."""
    return reduce(add, (F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in _PARITY))


def _possible(a: str, b: str, num: int, den: int) -> Column:
    """Whether sizes and parity bits allow the similarity: similar sets differ in few words, so in few bits (exact bounds)."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (na * den >= nb * num) & (nb * den >= na * num) & (_apart(a, b) * (den + num) <= (na + nb) * (den - num))


def _pair(a: str, b: str) -> list[Column]:
    return [F.col(f"{s}.{c}").alias(f"{t}_{c}") for s, t in ((a, "a"), (b, "b")) for c in _PLACE]


def _leader_pairs(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Each set with the likeliest of the heads of its leader keys, where the pair is possible.

    The head of a key is the earliest set that has it. Members of a large
    family often resemble one another but not its first, so a key of many sets
    has more heads: its sets are dealt into ``HEADS`` shares, and the earliest
    of each share is one. The pairs grow in proportion to the sets, and they
    settle most members of a large family of similar lines. Heads are plain
    aggregates joined back, so a hot key is split like any skewed join.
    """
    own = F.struct(*_PLACE, "n", *_PARITY).alias("own")
    keyed = sets.select(F.explode("leaders").alias("key"), own)
    heads = keyed.groupBy("key").agg(F.min("own").alias("head"), F.count(F.lit(1)).alias("m")).where("m > 1")
    heads = stage(heads, "line_heads")
    marks = _marks(heads.where(F.col("m") >= LARGE_KEY).select("key"))
    share = F.pmod(F.xxhash64("own.doc_id", "own.line_no"), F.lit(HEADS)).alias("share")
    more = _marked(keyed, marks, "key").groupBy("key", share).agg(F.min("own").alias("head"))
    heads = heads.select("key", "head").union(more.select("key", "head"))
    pairs = keyed.join(heads, "key").where((F.col("head") < F.col("own")) & _possible("head", "own", num, den))
    apart = _apart("head", "own") / (F.col("head.n") + F.col("own.n"))
    nearest = F.min(F.struct(apart.alias("apart"), "head")).alias("nearest")
    pairs = pairs.groupBy("own").agg(nearest).select(F.col("nearest.head").alias("head"), "own")
    return pairs.select(*_pair("head", "own"))


def _candidates(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of sets, ``b`` later and not yet ``done``, that pass the prefix, length, positional and parity filters."""
    post = sets.where(F.size("prefix") > 0).select(
        *_PLACE, "n", *_PARITY, "done", F.posexplode("prefix").alias("p", "token")
    )
    a, b = post.alias("a"), post.alias("b")
    na, nb = F.col("a.n"), F.col("b.n")
    later = F.struct(*[F.col(f"a.{c}") for c in _PLACE]) < F.struct(*[F.col(f"b.{c}") for c in _PLACE])
    reach = F.least(na - F.col("a.p"), nb - F.col("b.p"))
    positional = reach * (num + den) >= (na + nb) * num
    # Both sides name ``done`` in a condition of both, so that one shuffle of the postings serves both.
    open_ = ~F.col("b.done") | (F.col("a.done") & (na < 0))
    meet = (F.col("a.token") == F.col("b.token")) & open_ & _possible("a", "b", num, den) & positional & later
    return a.join(b, meet).select(*_pair("a", "b")).distinct()


def _marks(rows: DataFrame) -> DataFrame:
    """``MARKS`` words of 64 bits at most, in which each row sets one bit: a table of bounded size to broadcast."""
    mark, bit = _mark(*rows.columns)
    return rows.select(mark.alias("mark"), bit.alias("bit")).groupBy("mark").agg(F.bit_or("bit").alias("bits"))


def _mark(*columns: str) -> tuple[Column, Column]:
    hashed = F.xxhash64(*columns)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 58).cast("int"))
    return hashed.bitwiseAND(F.lit(MARKS - 1)).cast("int"), bit


def _marked(rows: DataFrame, marks: DataFrame, *columns: str) -> DataFrame:
    """Rows whose ``columns`` set a bit of ``marks``: all that made one, and few others."""
    mark, bit = _mark(*columns)
    marked = rows.select("*", mark.alias("mark"), bit.alias("bit")).join(F.broadcast(marks), "mark")
    return marked.where(F.col("bits").bitwiseAND(F.col("bit")) != 0).drop("mark", "bit", "bits")


def _verified(pairs: DataFrame, docs: DataFrame, num: int, den: int) -> DataFrame:
    """``(doc_id, line_no)`` of the later lines whose word sets reach the similarity with an earlier one."""
    a_place, b_place = ([F.col(f"{s}_{c}").alias(c) for c in _PLACE] for s in "ab")
    marks = _marks(pairs.select(*a_place).union(pairs.select(*b_place)))
    # Lines of which a pair may be leave their document alone; those that only share a mark meet no pair.
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = _marked(lines, marks, *_PLACE)
    a, b = (lines.select(*[F.col(c).alias(f"{s}_{c}") for c in (*_PLACE, "line")]) for s in "ab")
    words = [_hashes(_spaced(F.col(f"{s}_line"))).alias(f"{s}_words") for s in "ab"]
    common = F.size(F.array_intersect("a_words", "b_words"))
    whole = F.size("a_words") + F.size("b_words") - common
    return (
        pairs.join(a, ["a_doc_id", "a_line_no"])
        .join(b, ["b_doc_id", "b_line_no"])
        .select(*b_place, *words)
        .where(common * den >= whole * num)
        .select(*_PLACE)
        .distinct()
    )


def dedup_lines(
    docs: DataFrame,
    similarity: tuple[int, int] = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, text, n_lines, n_removed)``, one row per row of ``docs``, and the columns named in ``carry``.

    Lines are separated by line feeds; lines without a word stay and are not
    counted. A removed line goes with its line feed. Rows that share an id are
    one document, judged by line number; rows with a null id keep all lines
    and do not touch other rows; a null text stays null.
    """
    num, den = similarity
    plain = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), *carry)
    known = plain.where("doc_id is not null and text is not null")

    # Each step is written in the shared folder and read again; the shuffles behind it go with the write.
    sets = stage(_sets(known, frequency_classes(known), num, den), "line_sets")
    # First the likeliest partner of each set; what that leaves open meets all others.
    leaders = stage(_leader_pairs(sets, num, den), "line_leaders")
    early = stage(_verified(leaders, known, num, den), "lines_early")
    marked = sets.join(early.withColumn("hit", F.lit(True)), ["doc_id", "line_no"], "left")
    marked = marked.withColumn("done", F.coalesce("hit", F.lit(False))).drop("hit")
    pairs = stage(_candidates(marked, num, den), "line_pairs")
    late = stage(_verified(pairs, known, num, den), "lines_late")
    first = sets.groupBy("doc_id").agg(F.collect_set("line_no").alias("first"))
    like = early.union(late).groupBy("doc_id").agg(F.collect_set("line_no").alias("like"))
    none = F.array().cast("array<int>")
    kept = F.array_except(F.coalesce("first", none), F.coalesce("like", none))
    lines = F.split("text", "\n")
    with_word = f"[^ {_BLANKS}]"
    has_word = F.transform(lines, lambda x: x.rlike(with_word))
    joined = known.join(first, "doc_id", "left").join(like, "doc_id", "left").withColumn("kept", kept)
    left = F.filter(lines, lambda x, i: ~x.rlike(with_word) | F.array_contains("kept", i))
    n_lines = F.size(F.filter(has_word, lambda x: x))
    done = joined.select(
        "doc_id",
        F.array_join(left, "\n").alias("text"),
        n_lines.alias("n_lines"),
        (F.size(lines) - F.size(left)).alias("n_removed"),
        *carry,
    )
    rest = plain.where("doc_id is null or text is null").select(
        "doc_id", "text", n_lines.alias("n_lines"), F.lit(0).alias("n_removed"), *carry
    )
    return done.union(rest.withColumn("n_lines", F.coalesce("n_lines", F.lit(0)).cast("int")))
