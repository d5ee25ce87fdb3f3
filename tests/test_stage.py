"""Staged tables leave no shuffle files behind, and the session's settings stay as they were."""

import time

from pyspark.sql import functions as F

from cartoledger.session import shuffles_removed, stage, stage_with_metrics


def _shuffle_bytes(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i) for i in range(files.size()))
    return sum(f.length() for f in names if f.getName().startswith("shuffle_"))


def _settled(spark, want: int) -> int:
    for _ in range(50):  # files go in the background
        if _shuffle_bytes(spark) <= want:
            break
        time.sleep(0.1)
    return _shuffle_bytes(spark)


def test_stage_leaves_no_shuffle_files(spark):
    keyed = spark.range(200_000).groupBy((F.col("id") % 50_000).alias("k")).agg(F.sum("id").alias("x"))
    before = _shuffle_bytes(spark)
    staged = stage(keyed.join(keyed.select("k", F.col("x").alias("y")), "k"), "pairs")
    assert _settled(spark, before) <= before
    assert staged.count() == 50_000
    before = _shuffle_bytes(spark)
    staged, seen = stage_with_metrics(keyed, "sums", [F.count(F.lit(1)).alias("n")])
    assert seen == {"n": 50_000} and _settled(spark, before) <= before
    assert staged.where("x is null").count() == 0


def test_setting_is_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with shuffles_removed(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before
    spark.conf.set(key, "false")
    try:
        stage(spark.range(3).distinct(), "three")
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)


def test_stage_leaves_no_marker_and_bounds_the_plan_text(spark):
    key = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(key, None)
    with shuffles_removed(spark):
        assert int(spark.conf.get(key)) <= 100_000
    assert spark.conf.get(key, None) == before
    staged = stage(spark.range(100), "hundred")
    folder = spark._jvm.org.apache.hadoop.fs.Path(staged.inputFiles()[0]).getParent()
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    assert staged.count() == 100 and not any(f.getPath().getName() == "_SUCCESS" for f in files)
