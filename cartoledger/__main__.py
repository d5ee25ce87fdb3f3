"""Command line: the ordered run (R1) and the on-demand reports.

    python -m cartoledger run   --out DIR (--testdata SF_DIR | --input NAME=PATH ... [--changesets-xml PATH])
    python -m cartoledger stats (--testdata SF_DIR | --input NAME=PATH ...) [--top N]

``run`` writes every derived table under DIR as Parquet and stops at the first
failure. ``stats`` prints the table inventory, the monthly timeline and the
most active projects. On a cluster, submit with spark-submit and the cluster's
own settings; locally a session is created with the recommended settings.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.pipeline import Inputs, Pipeline, run
from .session import RECOMMENDED_CONF


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName("cartoledger")
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    return b.getOrCreate()


def _inputs(spark: SparkSession, args) -> Inputs:
    if args.testdata:
        return Inputs.from_testdata(spark, args.testdata)
    paths = dict(kv.split("=", 1) for kv in args.input or [])
    return Inputs.from_paths(spark, changesets_xml=args.changesets_xml, **paths)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cartoledger")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("run", "stats"):
        p = sub.add_parser(name)
        p.add_argument("--testdata", help="directory of the driver's parquet test tables")
        p.add_argument("--input", action="append", help="NAME=PATH of an input file (repeatable)")
        p.add_argument("--changesets-xml", help="changeset dump (XML, may be .bz2)")
        if name == "run":
            p.add_argument("--out", required=True, help="output folder for the derived tables")
        else:
            p.add_argument("--top", type=int, default=100)
    args = ap.parse_args(argv)
    spark = _session()
    inputs = _inputs(spark, args)
    if args.cmd == "run":
        for table, path in run(inputs, args.out).items():
            print(f"{table}\t{path}")
        return 0
    p = Pipeline(inputs)
    p.inventory().show(100, truncate=False)
    p.monthly().orderBy("month").show(truncate=False)
    p.top_projects(args.top).show(args.top, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
