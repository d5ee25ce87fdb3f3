"""S1, S2 over many splits, COPY escapes byte by byte, S9/S10 as a whole or not at all, A13 in bytes."""

import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartoledger.functions.text import copy_fields, unescape_copy_text
from cartoledger.plans.pipeline import Inputs, Pipeline
from cartoledger.sources import files, tables

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
SF = "/root/testdata/sf0.001"


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_quoted_newlines_over_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(1)
    bits = ["word", "\n", "\n\n", '"', "\t", " ", "é", "'", "\\", ""]
    want, lines = [], ["id\ta\tb"]
    for i in range(400):
        a, b = ("".join(rng.choices(bits, k=rng.randrange(8))) for _ in range(2))
        if i % 50 == 7:
            a = "long\n" * 400  # a value over several splits
        quoted = ['"' + v.replace('"', '""') + '"' for v in (a, b)]
        lines.append("\t".join([str(i), quoted[0], "" if i % 9 == 0 else quoted[1]]))
        want.append((i, a, None if i % 9 == 0 else b))
    path = tmp_path / "t.txt"
    path.write_text("\n".join(lines) + "\n")
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 20
    df = files.read_tsv(spark, str(path), SCHEMA, multiline=True)
    assert sorted(tuple(r) for r in df.collect()) == want
    plain = spark.read.csv(str(path), schema="id int, a string, b string", sep="\t", header=True, quote='"', escape='"',
                           nullValue="", emptyValue="EMPTY", multiLine=True)
    assert sorted((r.id, (r.a or "").replace("EMPTY", "")) for r in plain.collect()) == [(i, a) for i, a, _ in want]
    folder = tmp_path / "two"
    folder.mkdir()
    for k in (1, 2):
        (folder / f"{k}.txt").write_text(f'id\ta\tb\n{k}\t"x\ny"\t\n')
    assert rows(files.read_tsv(spark, str(folder), SCHEMA, multiline=True)) == [(1, "x\ny", None), (2, "x\ny", None)]


def _copy(value):
    """COPY text as the database writes it, with some bytes in octal and hex."""
    out = []
    for k, byte in enumerate(value.encode()):
        if byte == 0x5C:
            out.append("\\\\")
        elif byte == 0x0A:
            out.append("\\n" if k % 2 else "\\\n")
        elif byte == 0x09:
            out.append("\\t" if k % 2 else "\\\t")
        elif byte > 0x7F or k % 5 == 0:
            out.append(f"\\{byte:03o}" if k % 2 else f"\\x{byte:02x}")
        else:
            out.append(chr(byte))
    return "".join(out)


def test_copy_text_round_trip_over_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(2)
    bits = ["word", "\n", "\t", "\\", "é", "漢", "7", "\r", " ", "\\\n", "N", "x41"]
    want = [(i, "".join(rng.choices(bits, k=rng.randrange(1, 9))) + ("\n" * 300 if i % 60 == 9 else ""), None if i % 7 else "b") for i in range(300)]
    path = tmp_path / "c.txt"
    path.write_bytes("".join(f"{i}\t{_copy(a)}\t{b or ''}\n" for i, a, b in want).encode() + b"\\.\n999\tafter\tthe end\n")
    df = files.read_copy_text(spark, str(path), SCHEMA, escaped_newlines=True)
    assert sorted(tuple(r) for r in df.collect()) == want


def test_copy_escapes_by_hand(spark):
    cases = [
        (r"\b\f\n\r\t\v", "\b\f\n\r\t\v"), (r"\\n", r"\n"), (r"\\\n", "\\\n"), (r"\101\7\60", "A\a0"), (r"\1011", "A1"),
        (r"\x41\x4a\x4A\x9", "AJJ\t"), (r"\x414", "A4"), (r"\303\251\xc3\xa9", "éé"), (r"\q\N\.", "qN."), ("a\\\nb\\\tc", "a\nb\tc"),
        ("plain", "plain"), ("", ""), (r"\xg", "xg"), ("é\\\\", "é\\"), (r"\000\x00a", "\0\0a"), (None, None), (r"\541", "a"),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, c string")
    got = {r.i: r.v for r in df.select("i", unescape_copy_text("c").alias("v")).collect()}
    assert got == {i: v for i, (_, v) in enumerate(cases)}
    lines = spark.createDataFrame([("a\tb\\\tc\t\t\\\\\td",), ("",), ("\t",)], "c string")
    fields = [r.f for r in lines.select(copy_fields("c").alias("f")).collect()]
    assert fields == [["a", "b\\\tc", "", "\\\\", "d"], [""], ["", ""]]


def test_copy_rows_of_other_width_are_errors(spark, tmp_path):
    for text in ("1\ta\n", "1\ta\tb\tc\n"):
        path = tmp_path / f"w{len(text)}.txt"
        path.write_text(text)
        with pytest.raises(Exception, match="a row has not 3 fields"):
            files.read_copy_text(spark, str(path), SCHEMA).collect()


def test_a_killed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    first = tables.replace_table(spark.range(5).toDF("k"), path)
    broken = spark.range(100).select(F.when(F.col("id") > 90, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).alias("k"))
    with pytest.raises(Exception, match="killed"):
        tables.replace_table(broken.repartition(4), path)
    assert rows(tables.read_table(spark, path)) == rows(first) == [(k,) for k in range(5)]
    # a version that was written and never named, as when the driver dies before the switch
    spark.range(9).write.parquet(f"{path}/version-orphan")
    assert tables.read_table(spark, path).count() == 5
    # the new version may be made from the old one
    again = tables.replace_table(tables.read_table(spark, path).union(spark.range(5, 7).toDF("k")), path)
    assert rows(again) == rows(tables.read_table(spark, path)) == [(k,) for k in range(7)]
    assert sorted(n for n in os.listdir(path) if not n.startswith(".")) == sorted([tables.CURRENT, os.path.basename(tables.table_folder(spark, path))])
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_sizes_in_bytes(spark, tmp_path):
    folders = {}
    for name, n in (("small", 10), ("large", 20_000), ("empty", 0)):
        tables.replace_table(spark.range(n), str(tmp_path / name))
        folders[name] = tables.table_folder(spark, str(tmp_path / name))
    got = [tuple(r) for r in tables.sizes(spark, folders).collect()]
    assert [(g[0], g[2]) for g in got][:1] == [("large", 20_000)] and {g[0]: g[2] for g in got} == {"small": 10, "large": 20_000, "empty": 0}
    for name, size, _ in got:
        assert size == sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folders[name]) for f in fs if not f.endswith(".crc"))
    p = Pipeline(Inputs.from_testdata(spark, SF))
    inventory = {r.table_name: r.num_rows for r in p.inventory().collect()}
    sized = p.sizes().collect()
    assert {r.table_name: r.num_rows for r in sized} == inventory
    assert [r.num_bytes for r in sized] == sorted((r.num_bytes for r in sized), reverse=True) and sized[-1].num_bytes > 0
