"""File sources and sinks (S1-S3, S5-S10), all on Spark's built-in readers.

* S1 ``read_tsv``: psql ``\\copy ... csv delimiter '\\t' header``: quoted fields,
  doubled quotes, a quoted empty string is '' while a bare empty field is NULL.
* S2 ``read_copy_text``: PostgreSQL COPY text format: tab separated, no header,
  backslash escapes, empty field is NULL (``NULL AS ''``).
* S3 ``read_changesets``: the changeset dump (XML, optionally .bz2) to header
  rows, rejected rows and tag rows.
* S5 ``read_regions``: project areas as GeoJSON features, one per line, to one
  multi-polygon per project (S6 adds ``hot_project`` from the feature id).
* S7/S8 ``export_csv``, S9/S10 ``save`` (in ``plans.pipeline``).

Values are read as strings and cast to the declared schema (S12), so
booleans in ``t``/``f`` form and timestamps in text form work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import copy_fields, unescape_copy_text
from ..schemas import SCHEMAS
from .records import escaped_records, quoted_records

# A value no real field holds; marks a quoted empty string while reading CSV.
_EMPTY = "\u0001EMPTY\u0001"


def _all_strings(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def _cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            c = F.to_timestamp_ntz(c)
        elif not isinstance(f.dataType, T.StringType):
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _schema(schema_or_table) -> T.StructType:
    return SCHEMAS[schema_or_table] if isinstance(schema_or_table, str) else schema_or_table


def _csv_options(**more) -> dict:
    return {"sep": "\t", "quote": '"', "escape": '"', "nullValue": "", "emptyValue": _EMPTY, "mode": "FAILFAST", **more}


def read_tsv(spark: SparkSession, path: str, schema, multiline: bool = False) -> DataFrame:
    """S1. With ``multiline``, quoted values may hold line feeds.

    Files are split either way: then lines are first put together to records
    (``records.quoted_records``), each of which is parsed on its own.
    """
    schema = _schema(schema)
    strings = _all_strings(schema)
    if multiline:
        records = quoted_records(spark, path).where((F.col("record") > 1) & (F.col("text") != ""))
        parsed = F.from_csv("text", strings.simpleString()[len("struct<") : -1].replace(":", " "), _csv_options())
        raw = records.select(parsed.alias("r")).select("r.*")
    else:
        raw = spark.read.csv(path, schema=strings, header=True, **_csv_options())
    restored = raw.select(
        *[F.when(F.col(f.name) == F.lit(_EMPTY), F.lit("")).otherwise(F.col(f.name)).alias(f.name) for f in schema.fields]
    )
    return _cast_to(restored, schema)


def read_copy_text(spark: SparkSession, path: str, schema, escaped_newlines: bool = False) -> DataFrame:
    """COPY text rows. All escapes are undone with native functions; an empty field is NULL.

    With ``escaped_newlines``, a backslash before a line feed makes it part of
    the value (``records.escaped_records``). A row with more or fewer fields than
    the schema is an error. What follows an end marker (backslash and full stop
    alone on a line) is ignored with ``escaped_newlines``; otherwise only the marker itself.
    """
    schema = _schema(schema)
    if escaped_newlines:
        records = escaped_records(spark, path)
        end = records.where(F.col("text") == "\\.").groupBy("file").agg(F.min("record").alias("end"))
        own = records.join(end, "file", "left").where(F.col("end").isNull() | (F.col("record") < F.col("end")))
    else:
        own = spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("text"))
    n = len(schema.fields)
    own = own.where((F.col("text") != "") & (F.col("text") != "\\.")).select(copy_fields("text").alias("fields"))
    wrong = F.raise_error(F.concat(F.lit(f"a row has not {n} fields but "), F.size("fields")))
    fields = F.when(F.size("fields") == n, F.col("fields")).otherwise(wrong)
    own = own.select(fields.alias("fields"))
    text = [F.nullif(F.col("fields")[i], F.lit("")) for i in range(n)]
    return _cast_to(own.select(*[unescape_copy_text(c).alias(f.name) for c, f in zip(text, schema.fields)]), schema)


_XML_SCHEMA = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("_created_at", T.StringType()),
        T.StructField("_closed_at", T.StringType()),
        T.StructField("_uid", T.StringType()),
        T.StructField("_user", T.StringType()),
        T.StructField("_num_changes", T.StringType()),
        T.StructField("_comments_count", T.StringType()),
        T.StructField("tag", T.ArrayType(T.StructType([T.StructField("_k", T.StringType()), T.StructField("_v", T.StringType())]))),
    ]
)


def _utc_ntz(col: str):
    """ISO-8601 text in UTC ('...Z') to TIMESTAMP_NTZ, independent of the session time zone."""
    return F.to_timestamp_ntz(F.regexp_replace(F.col(col), "Z$", ""))


def read_changesets(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S3: (meta, rejects, tags) from the changeset dump.

    meta follows ``changeset_meta``; rows missing a NOT NULL value (closed_at,
    uid, username: open or anonymous changesets; or a count) go to rejects
    instead of failing the load. tags are (changeset, key, value), one row per tag.
    """
    raw = spark.read.format("xml").option("rowTag", "changeset").schema(_XML_SCHEMA).load(path)
    meta = raw.select(
        F.col("_id").cast("int").alias("changeset"),
        _utc_ntz("_created_at").alias("created_at"),
        _utc_ntz("_closed_at").alias("closed_at"),
        F.col("_uid").cast("int").alias("uid"),
        F.col("_user").alias("username"),
        F.col("_num_changes").cast("int").alias("num_changes"),
        F.col("_comments_count").cast("int").alias("comments_count"),
    )
    required = ["changeset", "created_at", "closed_at", "uid", "username", "num_changes", "comments_count"]
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    tags = raw.select(F.col("_id").cast("int").alias("changeset"), F.explode("tag").alias("t")).select(
        "changeset", F.col("t._k").alias("key"), F.col("t._v").alias("value")
    )
    return meta.where(complete), meta.where(~complete), tags


_POLY = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"


def read_region_features(spark: SparkSession, path: str) -> DataFrame:
    """S5 + S6: GeoJSON features (one per line) to (hot_project, geom), one row per feature.

    Polygon and MultiPolygon geometries are both accepted.
    """
    feature = "struct<properties: struct<id: string>, geometry: struct<type: string, coordinates: string>>"
    f = spark.read.text(path).where(F.trim("value") != F.lit("")).select(F.from_json("value", feature).alias("f"))
    coords = F.col("f.geometry.coordinates")
    geom = F.when(F.col("f.geometry.type") == F.lit("MultiPolygon"), F.from_json(coords, _MULTI)).when(
        F.col("f.geometry.type") == F.lit("Polygon"), F.array(F.from_json(coords, _POLY))
    )
    return f.select(F.col("f.properties.id").cast("int").alias("hot_project"), geom.alias("geom"))


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """The features of each project merged into one multi-polygon, valid or not.

    The pipeline reads features instead: their validity is tested before they are merged.
    """
    parts = read_region_features(spark, path)
    return parts.groupBy("hot_project").agg(F.flatten(F.collect_list("geom")).alias("geom"))


def export_csv(df: DataFrame, path: str) -> None:
    """A single-column id list as CSV files (no header), as psql ``\\copy (...) TO .. CSV``."""
    df.write.mode("overwrite").csv(path, header=False)


# Input name -> (file format, declared table). "tsv": S1 (CSV, tab, header);
# "copy": S2 (COPY text); "geojson": S5.
FORMATS: dict[str, tuple[str, str]] = {
    "registered_names": ("tsv", "hot_project_registered_contributor_name"),
    "uid_username": ("copy", "uid_username"),
    "history_contributor": ("tsv", "hot_project_history_contributor"),
    "description": ("tsv", "hot_project_description"),
    "activity": ("tsv", "hot_project_activity"),
    "region": ("geojson", "hot_project_region"),
    "node_edits": ("copy", "node_edits"),
    "way_edits": ("copy", "way_edits"),
    "rel_edits": ("copy", "rel_edits"),
    "node_tag_edits": ("copy", "node_tag_edits"),
    "way_tag_edits": ("copy", "way_tag_edits"),
    "rel_tag_edits": ("copy", "rel_tag_edits"),
    "history": ("copy", "history"),
    "tag_history": ("copy", "tag_history"),
    "meta": ("tsv", "changeset_meta"),
    "meta_tags": ("tsv", "changeset_meta_tags"),
}


def read_input(spark: SparkSession, name: str, path: str, multiline: bool = False) -> DataFrame:
    """Read one pipeline input in its declared format and schema."""
    fmt, table = FORMATS[name]
    if fmt == "tsv":
        return read_tsv(spark, path, table, multiline=multiline)
    if fmt == "copy":
        return read_copy_text(spark, path, table, escaped_newlines=multiline)
    return read_region_features(spark, path)
