"""Queries that must run as the first of a session, each in a process of its own."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from conftest import ROOT

CODE = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from tallyhall.session import local_session
spark = local_session(2)
print("rows:", entry.queries()[sys.argv[2]](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("name", ["listings_summary", "rfm_segments"])
def test_first_in_a_session(name, tmp_path):
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": f"--conf spark.checkpoint.dir={tmp_path} pyspark-shell"}
    done = subprocess.run([sys.executable, "-c", CODE, str(ROOT), name], env=env, capture_output=True, text=True, timeout=300)
    assert "rows: " in done.stdout, done.stderr[-3000:]
