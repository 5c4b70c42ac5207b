"""Every registered query against its SQL, on the smallest bundled data."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as registered
import parity

SF = "/root/testdata/sf0.001"
SQL = registered.oracle_sql()


@pytest.fixture(scope="module")
def other_engine():
    con = parity.connect(SF)
    yield con
    con.close()


def test_every_query_has_its_sql():
    """But for the optional training-data queries, most of which SQL can't express; they have tests of their own."""
    optional = {n for n in registered.queries() if n == "pipeline" or n.startswith("op") and n[2].isdigit()}
    assert set(registered.queries()) - optional == set(SQL) - optional


@pytest.mark.parametrize("name", sorted(SQL))
def test_results_agree(spark, other_engine, name):
    found = parity.compare(registered.queries()[name](spark, SF), other_engine, SQL[name])
    assert found["columns"]
    assert found["differ"] == 0, found
    assert found["rows"][0] > 0


def test_flagship_has_rows(spark):
    assert registered.entry(spark).limit(1).count() == 1


ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert __spark_entry__.queries()["land_csv"](spark, sys.argv[2]).count() > 0
"""


def test_python_workers_find_the_package_from_any_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, "-c", ELSEWHERE, str(Path(registered.__file__).parent), SF]
    subprocess.run(command, cwd=tmp_path, env=env, check=True, capture_output=True)
