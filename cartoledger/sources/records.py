"""Records of text files whose values may hold line feeds, cut without giving up on splitting the files.

A file is read line by line in as many splits as it has. Whether a line starts
a record depends on all lines before it, so each split is summed up in one row
(does it turn the state over, or end in the middle of a record), a prefix over
the splits of a file gives the state at the start of each, and a running sum
inside a split that of each line. Lines of a record meet by its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, at, line)``: lines in order of ``at`` within a split, splits in order of ``block``."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )


def _numbered(lines: DataFrame, starts: Column, starts_in: Column) -> DataFrame:
    """``(file, record, at, line)`` from whether a line starts a record, and the starts of whole splits."""
    split = Window.partitionBy("file", "block").orderBy("at")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = lines.withColumn("start", starts)
    counts = own.groupBy("file", "block").agg(F.sum(starts_in).alias("n"))
    offsets = counts.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = own.join(offsets, ["file", "block"])
    running = F.sum(F.col("start").cast("long")).over(split)
    return numbered.select("file", "block", "at", "line", (F.col("offset") + running).alias("record"))


def _joined(numbered: DataFrame) -> DataFrame:
    """``(file, record, text)``: the lines of a record in order, joined by line feeds."""
    lines = F.sort_array(F.collect_list(F.struct("block", "at", "line")))
    return numbered.groupBy("file", "record").agg(
        F.array_join(F.transform(lines, lambda x: x.line), "\n").alias("text")
    )


def quoted_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """``(file, record, text)`` of files whose quoted values may hold line feeds; records are numbered from 1 per file.

    A line starts a record if the quotes before it are even in number: a doubled quote keeps that.
    """
    lines = _lines(spark, path)
    quotes = F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))
    lines = lines.withColumn("quotes", quotes)
    split = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = lines.groupBy("file", "block").agg(F.sum("quotes").alias("n"))
    open_ = totals.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    inside = F.col("earlier") + F.coalesce(F.sum("quotes").over(split), F.lit(0))
    marked = lines.join(open_, ["file", "block"]).withColumn("whole", inside % 2 == 0)
    return _joined(_numbered(marked, F.col("whole"), F.col("start").cast("long")))


def escaped_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, record, text)`` of files in which a backslash before the line feed makes it part of a value."""
    lines = _lines(spark, path)
    trailing = F.length(F.regexp_extract("line", r"(\\*)$", 1))
    lines = lines.withColumn("goes_on", trailing % 2 == 1)
    split = Window.partitionBy("file", "block").orderBy("at")
    in_order = Window.partitionBy("file").orderBy("block")
    ends = lines.groupBy("file", "block").agg(F.max_by("goes_on", "at").alias("last"))
    states = ends.select("file", "block", F.coalesce(F.lag("last").over(in_order), F.lit(False)).alias("continued"))
    marked = lines.join(states, ["file", "block"])
    marked = marked.withColumn("whole", ~F.coalesce(F.lag("goes_on").over(split), F.col("continued")))
    return _joined(_numbered(marked, F.col("whole"), F.col("start").cast("long")))
