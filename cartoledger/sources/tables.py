"""Stored tables that are replaced as a whole (S9, S10), and their sizes on disk.

A table is a folder of versions and a small file that names the current one.
A new version is written beside the old, the name is switched by one atomic
rename, and only then are the other versions removed: a run that dies while it
writes leaves the old table as it was. All access goes through the Hadoop file
system of the path, so any store that Spark writes to will do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CURRENT = "_current"
_PREFIX = "version-"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _name(spark: SparkSession, path: str) -> str | None:
    """Name of the current version, None if there is no table."""
    fs, pointer = _fs(spark, f"{path}/{CURRENT}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode().strip()
    finally:
        stream.close()


def _switch(spark: SparkSession, path: str, name: str) -> None:
    """Make ``name`` the current version: a new pointer file takes the place of the old in one rename."""
    jvm = spark._jvm
    fs, fresh = _fs(spark, f"{path}/{CURRENT}-{uuid.uuid4().hex}")
    stream = fs.create(fresh)
    try:
        stream.write(bytearray(name.encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, jvm.org.apache.hadoop.fs.Path(f"{path}/{CURRENT}"), options)


def table_folder(spark: SparkSession, path: str) -> str:
    """Folder of the current version of the table at ``path``: plain Parquet files."""
    name = _name(spark, path.rstrip("/"))
    if name is None:
        raise FileNotFoundError(f"no table at {path}")
    return f"{path.rstrip('/')}/{name}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of the table at ``path``."""
    return spark.read.parquet(table_folder(spark, path))


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Store ``df`` as the new version of the table at ``path`` and return it as stored.

    ``df`` may read the old version. Versions that died half written are removed too.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    name = f"{_PREFIX}{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}")
    _switch(spark, path, name)
    fs, folder = _fs(spark, path)
    for status in fs.listStatus(folder):
        old = status.getPath().getName()
        if old.startswith(_PREFIX) and old != name:
            fs.delete(status.getPath(), True)
    return spark.read.schema(df.schema).parquet(f"{path}/{name}")


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, folder = _fs(spark, path)
    return fs.getContentSummary(folder).getLength()


def sizes(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """``(table_name, num_bytes, num_rows)`` of stored tables given by name and folder, largest first.

    Bytes are those on disk, rows come from the Parquet footers.
    """
    out = spark.createDataFrame([], "table_name string, num_bytes long, num_rows long")
    for name, folder in folders.items():
        rows = spark.read.parquet(folder).agg(F.count(F.lit(1)).alias("num_rows"))
        own = rows.select(F.lit(name).alias("table_name"), F.lit(folder_bytes(spark, folder)).cast("long").alias("num_bytes"), "num_rows")
        out = out.unionByName(own)
    return out.orderBy(F.desc("num_bytes"), "table_name")
