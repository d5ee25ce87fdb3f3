"""Mixing against a plain projected gradient; the pipeline against its plain composition; the registered queries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cartoledger.llm import mixing, quality
from cartoledger.llm.oracle import ORACLE_SQL
from cartoledger.llm.queries import QUERIES
from tests.llm import helpers

SF = "/root/testdata/sf0.001"
NAMES = mixing.DOMAINS


def _plain_rates(n, p, targets, steps=30):
    total = n.sum()
    goal = np.array([targets.get(d, 0.0) for d in NAMES]) / sum(targets.values()) * total
    gram = (p * n[:, None]).T @ p + 1e-9 * total * np.eye(len(NAMES))
    rate = np.ones(len(n))
    for _ in range(steps):
        residual = (p * (n * rate)[:, None]).sum(0) - goal
        rate = np.maximum(0, rate - p @ np.linalg.solve(gram, residual))
    return rate


@pytest.mark.parametrize("targets", [{"good": 0.7, "poor": 0.3}, {"good": 1, "poor": 1, "toxic": 1}, {"toxic": 1.0}])
def test_rates_equal_plain_gradient(spark, targets):
    draw = np.random.default_rng(3)
    p = draw.dirichlet([0.3] * len(NAMES), 300).round(9)
    n = draw.integers(0, 500, 300)
    rows = [(i, int(n[i]), *map(float, p[i])) for i in range(300)]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, " + ", ".join(f"p_{d} double" for d in NAMES))
    fitted = members.withColumn("rate", mixing.rate_of(mixing.fit_rates(members, targets)))
    got = {r["doc_id"]: r["rate"] for r in fitted.collect()}
    want = _plain_rates(n.astype(float), p, targets)
    assert np.abs(np.array([got[i] for i in range(300)]) - want).max() < 1e-3
    assert min(got.values()) >= 0


def test_reachable_targets_are_met(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = mixing.mix(docs, labels, {"good": 0.8, "poor": 0.2, "toxic": 0.0}).cache()
    assert out.count() == docs.count()
    sums = out.agg(F.sum("n_tokens").alias("n"), *[F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")).alias(d) for d in NAMES]).first()
    assert sums["good"] / sums["n"] == pytest.approx(0.8, abs=0.05)
    assert sums["toxic"] / sums["n"] < 0.03
    means = {(r["quality"], r["toxic"]): r for r in out.join(labels, "doc_id").groupBy("quality", "toxic").agg(F.avg("p_good").alias("good"), F.avg("p_toxic").alias("bad")).collect()}
    assert means[1, 0]["good"] > 0.9 and means[1, 1]["bad"] > 0.65  # from 400 labels in four languages


def test_mixing_awkward_rows(spark):
    docs = helpers.awkward(spark)
    labels = spark.createDataFrame([(4, 1, 0, "x"), (4, 1, 1, "x"), (5, 1, None, "x"), (None, 0, 0, "x"), (6, 0, 0, "x")], "doc_id long, quality int, toxic int, domain string")
    rows = mixing.mix(docs, labels, {"good": 1.0}).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["p_toxic"] + r["p_poor"] + r["p_good"] == pytest.approx(1, abs=1e-6) and r["rate"] >= 0
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_tokens"] == by[2]["n_tokens"] == by[3]["n_tokens"] == 0 and by[5]["n_tokens"] == 60_000
    assert by[4]["n_tokens"] == 4
    wide = mixing.with_rates(docs.drop("rate"), labels, {"good": 1.0})
    assert wide.columns[: len(docs.columns) - 1] == docs.drop("rate").columns and wide.count() == len(rows)
    assert mixing.mix(docs.limit(0), labels, {"good": 1.0}).count() == 0
    assert mixing.mix(docs, labels.limit(0), {"good": 1.0}).count() == len(rows)
    with pytest.raises(ValueError):
        mixing.fit_rates(spark.createDataFrame([], "doc_id long, n_tokens long, p_toxic double, p_poor double, p_good double"), {"good": -1.0})


def test_mixing_native_plan(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    plan = mixing.with_posteriors(docs, mixing.train(docs, labels))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "MapInArrow", "Exchange"))


def test_pipeline_equals_plain_composition(spark):
    """Stages 1 to 4 by comparing everything with everything; the rates of stage 5 by a plain gradient."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rules = quality.Rules()
    kept = [(r["doc_id"], r["text"]) for r in docs if helpers.quality(r["text"], rules.max_shares)[6]]
    texts = helpers.dedup_lines(kept)
    ids = sorted(texts)
    groups = helpers.near_groups([helpers.simhash(texts[i]) for i in ids])
    ids = sorted({ids[g] for g in groups})
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    ids = [i for i in ids if not helpers.leaks(texts[i], items)]

    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) <= set(ids)
    assert all(got[i]["text"] == texts[i] and got[i]["n_chars"] == len(texts[i]) for i in got)
    # all that is missing was hardly wanted
    table = helpers.table(spark, []).union(spark.createDataFrame([(i, texts[i], "", "", 0) for i in ids], helpers.DOCS))
    mixed = mixing.mix(table, spark.read.parquet(f"{SF}/labels.parquet"), corpus_pipeline.TARGETS).collect()
    n = np.array([float(r["n_tokens"]) for r in mixed])
    p = np.array([[r[f"p_{d}"] for d in NAMES] for r in mixed])
    rates = dict(zip([r["doc_id"] for r in mixed], _plain_rates(n, p, corpus_pipeline.TARGETS)))
    wanted = {i for i, r in rates.items() if r >= corpus_pipeline.LEAST_RATE}
    assert {i for i in set(got) ^ wanted if abs(rates[i] - corpus_pipeline.LEAST_RATE) > 1e-3} == set()
    assert all(abs(got[i]["rate"] - rates[i]) < 1e-3 for i in got)


def test_kept_rows_meet_targets_with_a_large_poor_source(spark, tmp_path):
    """A third of the rows is poor: their rate is low, but they stay and make up their share."""
    kinds = [("poor", 0, 0)] * 100 + [("toxic", 1, 1)] * 20 + [("good", 1, 0)] * 180
    rows = [(i, " ".join(f"{k}{(7 * i + 3 * j) % 50}" for j in range(40)), "en", k, 0) for i, (k, _, _) in enumerate(kinds)]
    labels = [(i, quality, toxic) for i, (_, quality, toxic) in enumerate(kinds)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.source_mixing(spark, spark.createDataFrame(rows, helpers.DOCS), str(tmp_path)).collect()
    assert {r["doc_id"] for r in got if r["source"] == "poor"} == set(range(100))
    tokens = sum(r["rate"] * r["n_tokens"] for r in got)
    for d in NAMES:
        share = sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in got) / tokens
        assert share == pytest.approx(corpus_pipeline.TARGETS[d], abs=0.005)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).dtypes == docs.dtypes
        assert stage(spark, helpers.awkward(spark), SF).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = {tuple(r) for r in got.select(*want.columns).collect()}
    assert rows == set(want.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs(spark, name):
    key = {"op6_chat_format": "conversations", "op8_html_extraction": "pages", "op11_vector_codes": "embeddings"}
    key = key.get(name, "documents")
    got = QUERIES[name](spark, SF)
    n = got.count()
    if name == "op6_chat_format":
        assert n == spark.read.parquet(f"{SF}/{key}.parquet").select("conv_id").distinct().count() + 1
    elif name not in ("op3_decontamination", "op12_hard_negatives"):
        assert n == spark.read.parquet(f"{SF}/{key}.parquet").count()


def test_plan_of_the_posteriors_names_the_table_once(spark):
    """The table of buckets has 2**17 numbers; each copy would be text of the plan on the driver and data of each task."""
    model = mixing.Model([5, 77], {d: [1.0, -1.0] for d in mixing.DOMAINS}, {d: -1.0 for d in mixing.DOMAINS})
    docs = helpers.table(spark, ["a b c", "d e f g", None])
    plan = mixing.with_posteriors(docs, model)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("0," * 70_000) == 1
