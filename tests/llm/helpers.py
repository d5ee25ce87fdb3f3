"""Plain versions of the operators, and small tables, for the tests."""

import itertools
import math
import re
from collections import Counter, defaultdict

import xxhash

from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


def table(spark, texts, start=0):
    """Documents 0, 1, ... of the given texts."""
    rows = [(start + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def awkward(spark, extra=()):
    """Null and empty texts, null ids, repeated rows, blanks only, and a long text; columns that clash with operators' own."""
    long = " ".join(f"w{i % 977} x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (None, "a text of a row that has no id"), (None, None), (3, " \n\t \n"), (4, "same row twice here")]
    rows += [(4, "same row twice here"), (5, long), (6, "é"), (7, "a\n\n\nb\x0bc\x0cd")]
    rows += list(extra)
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    fields += [T.StructField(c, T.StringType()) for c in ("lang", "source", "fp", "words", "kept", "rate", "g", "seed")]
    fields += [T.StructField("n_chars", T.LongType())]
    return spark.createDataFrame([(i, t, "en", "s", "1", "w", "k", "r", "g", "z", 0) for i, t in rows], T.StructType(fields))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def union_find(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def simhash(text):
    ws = words(lower(text))
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(fps, distance=3):
    return union_find(
        len(fps), [(a, b) for a, b in itertools.combinations(range(len(fps)), 2) if (fps[a] ^ fps[b]).bit_count() <= distance]
    )


def repeats(docs, n):
    """doc_id -> (words, mask of removed words)."""
    first = {}
    for i, t in docs:
        ws = words(t)
        for k in range(len(ws) - n + 1):
            g = tuple(ws[k : k + n])
            first[g] = min(first.get(g, i), i)
    out = {}
    for i, t in docs:
        ws = words(t)
        gone = [False] * len(ws)
        for k in range(len(ws) - n + 1):
            if first[tuple(ws[k : k + n])] < i:
                gone[k : k + n] = [True] * n
        out[i] = ws, gone
    return out


def dedup_lines(docs, num=4, den=5):
    """doc_id -> text, by comparing every line with every earlier one."""
    lines = [(i, k, x, frozenset(words(x))) for i, t in sorted(docs) for k, x in enumerate(t.split("\n"))]
    gone, earlier = set(), []
    for i, k, _, s in lines:
        if s:
            if any(len(s & e) * den >= len(s | e) * num for e in earlier):
                gone.add((i, k))
            earlier.append(s)
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in docs}


def leaks(text, items, threshold=0.8, size=5):
    """item -> best weighted Jaccard similarity of any window of the item's size, at least the threshold."""
    ws, out = words(lower(text)), {}
    for item, t in items:
        own = words(lower(t))
        if not own or len(own) > len(ws):
            continue
        k = min(size, len(own))
        bag = Counter(tuple(own[i : i + k]) for i in range(len(own) - k + 1))
        best = 0.0
        for s in range(len(ws) - len(own) + 1):
            w = Counter(tuple(ws[s + i : s + i + k]) for i in range(len(own) - k + 1))
            common = sum((bag & w).values())
            best = max(best, common / (sum(bag.values()) + sum(w.values()) - common))
        if best >= threshold:
            out[item] = best
    return out


def short_leaks(text, items, threshold=0.8, size=5):
    """item -> weighted Jaccard similarity of the whole text to each item with more words, at least the threshold."""
    ws, out = words(lower(text)), {}
    for item, t in items:
        own = words(lower(t))
        k = min(size, len(own))
        if k <= len(ws) < len(own):
            a, b = (Counter(tuple(x[i : i + k]) for i in range(len(x) - k + 1)) for x in (ws, own))
            score = sum((a & b).values()) / sum((a | b).values())
            if score >= threshold:
                out[item] = score
    return out


def quality(text, limits, window=8):
    """Figures of the quality rules, word by word."""
    ws = words(text)
    total = sum(map(len, ws))
    lines = [x for x in (text or "").split("\n") if words(x)]
    dup_lines, dup_chars, seen = 0, 0, set()
    for x in lines:
        if x in seen:
            dup_lines += 1
            dup_chars += sum(map(len, words(x)))
        seen.add(x)

    def inside(n):
        grams = Counter(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
        return [
            any(grams[tuple(ws[s : s + n])] > 1 for s in range(max(0, i - n + 1), min(i, len(ws) - n) + 1))
            for i in range(len(ws))
        ]

    repeat = sum(inside(window))
    failed = len(ws) < 20 or 100 * repeat > 30 * len(ws)
    shares = [sum(len(w) for w, m in zip(ws, inside(n)) if m) / total if total else 0.0 for n in sorted(limits)]
    line_share = dup_chars / total if total else 0.0
    kept = not failed and line_share <= 0.30 and all(s <= limits[n] for s, n in zip(shares, sorted(limits)))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(ws), total, symbols, dup_lines, repeat, failed, kept


def bigram_model(texts, learn, discount=0.75):
    """``score(text) -> (n_tokens, n_known, total, base, score)`` of the smoothed bigram model."""
    rows = [words(lower(t)) + [None] for t in texts]
    uni, bi, kinds = Counter(), Counter(), defaultdict(set)
    for row, use in zip(rows, learn):
        if use:
            uni.update(row)
            for a, b in zip(row, row[1:]):
                bi[a, b] += 1
                kinds[a].add(b)
    total, vocabulary = sum(uni.values()), len(uni)
    after = Counter()
    for (a, _), n in bi.items():
        after[a] += n

    def p1(w):
        return (uni[w] + 1) / (total + vocabulary + 1)

    def score(text):
        row = words(lower(text)) + [None]
        base = sum(math.log10(p1(w)) for w in row)
        whole = math.log10(p1(row[0]))
        for a, b in zip(row, row[1:]):
            p = p1(b)
            if after[a]:
                p = max(bi[a, b] - discount, 0) / after[a] + discount * len(kinds[a]) / after[a] * p
            whole += math.log10(p)
        return len(row), sum(uni[w] > 0 for w in row), total, base, whole

    return score
