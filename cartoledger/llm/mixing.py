"""Mixing documents to target weights by soft domain membership; DataFrame functions only.

1. A labelled table trains a naive Bayes classifier over hashed word features;
   every document gets posteriors over the domains instead of one domain.
2. Nonnegative document rates are fitted so that the expected tokens of each
   domain, ``sum(rate * posterior * tokens)``, come to its target share of all
   tokens: least squares in the metric of the domains' second moments, starting
   from rate 1, by projected gradient. Every step is one aggregate over the
   documents that returns one number per domain, and one column expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoledger.llm.common import checkpointed, free_name
from cartoledger.session import stage

BUCKETS = 1 << 17
PREFIX = 4
# Domains of the labels table, least wanted first: a row belongs to the first whose test holds.
DOMAINS = ("toxic", "poor", "good")


def domain_of(quality: Column, toxic: Column) -> Column:
    """Domain of a label row; null where a label is missing."""
    return (
        F.when(toxic == 1, "toxic").when((toxic == 0) & (quality == 0), "poor").when((toxic == 0) & (quality == 1), "good")
    )


def _words(text: Column) -> Column:
    """Words as an array (may hold empty strings)."""
    blanks = "\t\n\x0b\x0c\r"
    return F.split(F.translate(F.coalesce(text, F.lit("")), blanks, " " * len(blanks)), " ")


def _with_words(docs: DataFrame, text_col: str, words: str, distinct: str) -> DataFrame:
    """Adds the words and the distinct words of a text."""
    own = docs.withColumn(words, F.array_remove(_words(docs[text_col]), ""))
    return own.withColumn(distinct, F.array_distinct(words))


def _feature(word: Column) -> Column:
    """Hash bucket of a feature."""
    return F.xxhash64(word).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _head(word: Column) -> Column:
    return F.substring(word, 1, PREFIX)


def _style(words: str, distinct: str) -> Column:
    """Bucket of the share of distinct words in tenths; no word starts with its first character."""
    ratio = F.floor(F.size(distinct) * 10 / F.greatest(F.size(words), F.lit(1)))
    return _feature(F.concat(F.lit("\x01"), ratio.cast("string")))


def _features(words: str, distinct: str) -> Column:
    """Distinct buckets of the words, of their heads, and of the style."""
    heads = F.transform(distinct, lambda w: _feature(_head(w)))
    return F.array_distinct(F.concat(F.transform(distinct, _feature), heads, F.array(_style(words, distinct))))


@dataclass(frozen=True)
class Model:
    """Bernoulli naive Bayes over the presence of features: at most ``BUCKETS`` features."""

    buckets: list[int]
    weights: dict[str, list[float]]  # per domain, log odds of each feature's presence
    offsets: dict[str, float]  # per domain, log prior and log probability that no feature is present


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 12_000,
    min_docs: int = 3,
    min_purity: float = 0.6,
    smoothing: float = 0.5,
) -> Model:
    """Fit the classifier on the labelled documents.

    Fitted on at most ``sample_rows`` labelled documents, those of least hash
    of the id (a documented bound; the corpus itself is never sampled).
    ``labels`` needs doc_id, quality, toxic; rows with a null count for
    nothing, and a document labelled more than once takes its least wanted
    domain. A feature marks a domain if it is present in ``min_docs`` documents or
    more, ``min_purity`` of these are of the domain, and that is four standard
    deviations more than chance gives; the other
    domains share one frequency of it.
    """
    rank = F.array_position(F.array(*[F.lit(d) for d in DOMAINS]), F.col("domain"))
    own = (
        labels.select(
            labels["doc_id"].cast("long").alias("doc_id"), domain_of(labels["quality"], labels["toxic"]).alias("domain")
        )
        .where("doc_id is not null and domain is not null")
        .groupBy("doc_id")
        .agg(F.min(rank).alias("rank"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    present = _with_words(texts.join(F.broadcast(own), "doc_id"), "text", "words", "distinct").select(
        "rank", F.explode(F.array_append(_features("words", "distinct"), F.lit(-1))).alias("bucket")
    )
    # Per feature and domain the number of documents that have it; bucket -1 counts the documents.
    counted = present.groupBy("bucket").agg(
        *[F.sum((F.col("rank") == i + 1).cast("long")).alias(d) for i, d in enumerate(DOMAINS)]
    )
    rows = {r["bucket"]: [r[d] for d in DOMAINS] for r in counted.collect()}  # at most BUCKETS + 1 rows
    known = rows.pop(-1, [0] * len(DOMAINS))
    everything = sum(known)
    chosen, frequencies = [], []
    for bucket, n in sorted(rows.items()):
        if sum(n) < min_docs:
            continue
        overall = (sum(n) + smoothing) / (everything + 2 * smoothing)
        own_frequency = [(a + 2 * smoothing * overall) / (b + 2 * smoothing) for a, b in zip(n, known, strict=True)]
        usual = [sum(n) * b / everything for b in known]
        marked = [
            a >= min_purity * sum(n) and (a - u) ** 2 >= 16 * u for a, u in zip(n, usual, strict=True)
        ]
        if any(marked):
            # Domains that the feature does not mark share one frequency, so it says nothing between them.
            rest = [i for i, m in enumerate(marked) if not m]
            shared = (sum(n[i] for i in rest) + 2 * smoothing * overall) / (sum(known[i] for i in rest) + 2 * smoothing)
            mixed = [f if m else shared for f, m in zip(own_frequency, marked, strict=True)]
            chosen.append(bucket)
            frequencies.append([min(max(f, 1e-4), 1 - 1e-4) for f in mixed])
    return Model(
        chosen,
        {d: [float(f"{math.log(f[i] / (1 - f[i])):.5g}") for f in frequencies] for i, d in enumerate(DOMAINS)},
        {
            d: round(
                math.log((known[i] + 1) / (everything + len(DOMAINS))) + sum(math.log(1 - f[i]) for f in frequencies), 6
            )
            for i, d in enumerate(DOMAINS)
        },
    )


def _constant(values: list, kind: str) -> Column:
    """A constant array, folded by the optimizer from one string."""
    return F.split(F.lit(",".join(f"{v:g}" for v in values)), ",").cast(f"array<{kind}>")


def with_posteriors(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``n_tokens`` and ``p_DOMAIN``: whole texts, row by row, no shuffle.

    A null or empty text has no token; what its posteriors are follows from
    the absence of all features.
    """
    names = {k: free_name(docs, k) for k in ("words", "distinct", "present", *(f"s_{d}" for d in DOMAINS))}
    found = _with_words(docs, text_col, names["words"], names["distinct"])
    # Place of a bucket's weights, from 1; 0 for a bucket that marks no domain.
    places = [0] * BUCKETS
    for place, bucket in enumerate(model.buckets, 1):
        places[bucket] = place
    # The table is named once, as it is long and every copy would go into the plan's text and into each task.
    place_of = _constant(places, "int")
    features = F.concat(
        F.transform(names["distinct"], _feature),
        F.transform(names["distinct"], lambda w: _feature(_head(w))),
        F.array(_style(names["words"], names["distinct"])),
    )
    present = F.filter(F.transform(features, lambda f: F.get(place_of, f)), lambda p: p > 0)
    found = found.withColumn(names["present"], F.array_distinct(present))
    for d in DOMAINS:
        weights = _constant([0.0, *model.weights[d]], "double")
        found = found.withColumn(
            names[f"s_{d}"],
            F.aggregate(names["present"], F.lit(model.offsets[d]), lambda s, p: s + F.get(weights, p)),
        )
    logs = {d: F.col(names[f"s_{d}"]) for d in DOMAINS}
    most = F.greatest(*logs.values())
    parts = {d: F.exp(F.greatest(logs[d] - most, F.lit(-60.0))) for d in DOMAINS}
    whole = reduce(lambda a, b: a + b, parts.values())
    return found.select(
        *[docs[c] for c in docs.columns],
        F.size(names["words"]).cast("long").alias("n_tokens"),
        *[F.round(parts[d] / whole, 9).alias(f"p_{d}") for d in DOMAINS],
    )


def _solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """Gaussian elimination with pivoting for the few domains."""
    n = len(right)
    rows = [[*matrix[i], right[i]] for i in range(n)]
    for i in range(n):
        pivot = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        for r in range(i + 1, n):
            f = rows[r][i] / rows[i][i]
            rows[r] = [x - f * y for x, y in zip(rows[r], rows[i], strict=True)]
    out = [0.0] * n
    for i in reversed(range(n)):
        out[i] = (rows[i][n] - sum(rows[i][j] * out[j] for j in range(i + 1, n))) / rows[i][i]
    return out


def fit_rates(
    members: DataFrame, targets: dict[str, float], steps: int = 30, tolerance: float = 1e-6, cut_every: int = 10
) -> list[list[float]]:
    """Steps that lead rates of 1 to the fitted ones (see ``rate_of``), from ``members(n_tokens, p_...)``.

    Minimises the distance between the expected tokens of each domain and its
    target share of all tokens, over nonnegative rates, by projected gradient.
    With ``G = sum(n * p p')`` the step is ``rate - p' G^-1 (A rate - target)``:
    gradient descent in the metric where every token counts alike, exact in one
    step if no rate would become negative; the projection sets those to zero.
    A tiny ridge keeps ``G`` invertible when a domain is absent (its target is
    then out of reach and the rest is met as well as possible). An empty table
    or one without tokens needs no step.
    """
    weight = sum(targets.get(d, 0.0) for d in DOMAINS)
    if weight <= 0 or any(targets.get(d, 0.0) < 0 for d in DOMAINS):
        raise ValueError("target weights must be nonnegative and not all zero")
    p, n = {d: F.col(f"p_{d}") for d in DOMAINS}, F.col("n_tokens")
    moments = members.agg(
        F.sum(n).alias("all"),
        *[F.round(F.sum(n * p[a] * p[b]), 3).alias(f"{a}_{b}") for a in DOMAINS for b in DOMAINS],
    ).first()
    total = float(moments["all"] or 0)
    if not total:
        return []
    ridge = 1e-9 * total
    gram = [[moments[f"{a}_{b}"] + (ridge if a == b else 0.0) for b in DOMAINS] for a in DOMAINS]
    goal = [targets.get(d, 0.0) / weight * total for d in DOMAINS]
    name = free_name(members, "rate")
    current = members.select("n_tokens", *[f"p_{d}" for d in DOMAINS], F.lit(1.0).alias(name))
    moves: list[list[float]] = []
    since: list[list[float]] = []
    for step in range(steps):
        rate = rate_of(since, F.col(name))
        expected = current.agg(*[F.round(F.sum(rate * n * p[d]), 3).alias(d) for d in DOMAINS]).first()
        residual = [expected[d] - g for d, g in zip(DOMAINS, goal, strict=True)]
        move = [round(m, 9) for m in _solve(gram, residual)]
        if max(abs(r) for r in residual) <= tolerance * total or max(map(abs, move)) <= tolerance:
            break
        moves.append(move)
        since.append(move)
        if (step + 1) % cut_every == 0:
            current = checkpointed(current.withColumn(name, rate_of(since, F.col(name))))
            since = []
    return moves


def rate_of(moves: list[list[float]], start: Column | None = None) -> Column:
    """The rate after the given steps, as an expression over the posteriors."""
    rate = F.lit(1.0) if start is None else start
    for move in moves:
        step = reduce(lambda a, b: a + b, [F.col(f"p_{d}") * m for d, m in zip(DOMAINS, move, strict=True)])
        rate = F.greatest(F.lit(0.0), rate - step)
    return rate


def with_rates(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float], sample_rows: int = 12_000, steps: int = 30
) -> DataFrame:
    """``docs`` (all columns) plus ``n_tokens``, ``p_DOMAIN`` and ``rate``, row by row; no text is shuffled.

    The scored documents are stored once; the fit reads their counts and
    posteriors, and the rate is an expression over these.
    """
    scored = stage(with_posteriors(docs, train(docs, labels, sample_rows)), "mixing_scored")
    members = scored.select("n_tokens", *[f"p_{d}" for d in DOMAINS])
    return scored.withColumn("rate", F.round(rate_of(fit_rates(members, targets, steps)), 6))


def mix(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float], sample_rows: int = 12_000, steps: int = 30
) -> DataFrame:
    """``(doc_id, n_tokens, p_toxic, p_poor, p_good, rate)``, one row per row of ``docs``."""
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    model = train(own, labels, sample_rows)
    members = stage(with_posteriors(own, model).drop("text"), "mixing_members")
    return members.withColumn("rate", F.round(rate_of(fit_rates(members, targets, steps)), 6))
