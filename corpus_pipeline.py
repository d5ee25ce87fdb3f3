"""The training corpus: documents through five operators, each stage written and read again.

STAGES lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)``,
works on all that its predecessor kept and returns a DataFrame. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoledger.llm import decontaminate, linededup, mixing, quality, simhash
from cartoledger.llm.common import name_checkpoint_dir
from cartoledger.session import shuffles_removed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Target shares of all tokens after filtering.
TARGETS = {"good": 0.97, "poor": 0.03, "toxic": 0.0}
# Documents whose fitted rate is not above this go: the others are wanted, however seldom, to meet the targets.
LEAST_RATE = 0.0


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return quality.keep_good(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that resemble an earlier line; ``n_chars`` follows the text.

    Every row keeps its own other columns; rows of equal id are judged as one document.
    """
    shorter = linededup.dedup_lines(docs, carry=("lang", "source"))
    return shorter.select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return simhash.keep_first(docs.select(*COLUMNS), 3, 3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the rate at which to draw them; those that the fit puts at rate zero are gone."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.with_rates(docs.select(*COLUMNS), labels, TARGETS).where(F.col("rate") > LEAST_RATE)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

# Rolling-hash verdicts, SimHash windows and the fitted rates have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder and read again."""
    name_checkpoint_dir(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        with shuffles_removed(spark):
            kept.write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
