"""R1 and R4 from the command line entry point."""

import contextlib
import io
import os

import pytest

from cartoledger.__main__ import main

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_cli_run_and_stats(spark, tmp_path):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        assert main(["run", "--testdata", SF, "--out", str(tmp_path / "tables")]) == 0
    written = dict(line.split("\t") for line in out.getvalue().strip().splitlines())
    assert "user_hot_contributions" in written and os.path.isdir(written["user_hot_contributions"])
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        assert main(["stats", "--testdata", SF, "--top", "5"]) == 0
    text = out.getvalue()
    assert "table_name" in text and "month" in text and "num_users" in text
