import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cartoledger.session import RECOMMENDED_CONF

    b = SparkSession.builder.master("local[4]").appName("cartoledger-tests")
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "4").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        # Tests only: a session without a shared folder gets a scratch one.
        d = tempfile.mkdtemp(prefix="cartoledger-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


def ts(text):
    import datetime as dt

    return dt.datetime.fromisoformat(text)


def rows(df, order=None):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r)) if order is None else out
