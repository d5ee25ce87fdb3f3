"""Session helpers: settings the library relies on, and a local session for tests."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

# While a table is staged: shuffle files go with the write, and the driver keeps a plan's text only up to a bound
# (constant tables stand in it number by number, and it is made anew whenever the plan adapts).
_STAGING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxPlanStringLength": "100000",
}
# No marker file: the driver would start a process to set its mode, and nobody looks for it.
_NO_MARKER = ("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")

# Settings the pipeline prefers. Operators never depend on them for results:
# they use explicit TIMESTAMP_NTZ casts and UTC-free arithmetic throughout.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcasts: never from plan-time estimates; only the library's size-checked hints
    # (operators/joins.py), or AQE at run time from measured shuffle sizes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cartoledger") -> SparkSession:
    """A local session for tests and the bench; on a cluster use the cluster's own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else that of the context; a fallback is set only without either."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is unset; pass a shared folder as fallback")
    spark.sparkContext.setCheckpointDir(fallback)  # the setting itself cannot be changed in a running session
    return spark.sparkContext.getCheckpointDir()


def _stage_root(spark: SparkSession) -> str:
    # Only a session of a single process may fall back to a folder of its own.
    alone = spark.conf.get("spark.master", "").startswith("local[")
    return checkpoint_dir(spark, "/tmp/cartoledger-checkpoints" if alone else None).rstrip("/")


@contextmanager
def shuffles_removed(spark: SparkSession):
    """While open, the shuffle files of a write or an action go as soon as it ends, whenever the collector runs.

    What was written needs them no longer, and no later query reads the shuffles of another.
    """
    before = {key: spark.conf.get(key, None) for key in _STAGING}
    for key, value in _STAGING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stage_with_metrics(df, name: str, metrics: list, run_id: str | None = None):
    """``stage`` that also returns aggregate ``metrics`` (Columns) computed while writing.

    The metrics ride on the write job (``DataFrame.observe``), so a size needed
    later, such as a broadcast bound, costs no extra pass over the data.
    """
    import uuid

    from pyspark.sql import Observation

    spark = df.sparkSession
    path = f"{_stage_root(spark)}/cartoledger/{run_id or uuid.uuid4().hex}/{name}"
    seen = Observation(f"stage_{name}_{uuid.uuid4().hex[:8]}")
    with shuffles_removed(spark):
        df.observe(seen, *metrics).write.mode("overwrite").option(*_NO_MARKER).parquet(path)
    return spark.read.schema(df.schema).parquet(path), dict(seen.get)


def stage(df, name: str, run_id: str | None = None):
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage of a table that several later steps read (the reference
    stores the same tables), so plans stay small and a lost executor costs a
    re-read, not a recomputation of everything upstream.
    """
    import uuid

    spark = df.sparkSession
    path = f"{_stage_root(spark)}/cartoledger/{run_id or uuid.uuid4().hex}/{name}"
    with shuffles_removed(spark):
        df.write.mode("overwrite").option(*_NO_MARKER).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark, run_id: str) -> None:
    """Remove the tables that ``stage`` wrote for ``run_id``, through the file system they are on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_stage_root(spark)}/cartoledger/{run_id}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
