"""Every registered query against its SQL, on the smallest data."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from __spark_entry__ import entry
from checks import ORACLES, QUERIES
from checks.compare import compare, open_tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not there")


@pytest.fixture(scope="module")
def db():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    outcome = compare(spark, db, FOLDER, QUERIES[name], ORACLES[name])
    assert outcome.problem == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_gives_the_grid(spark):
    grid = entry(spark)
    assert grid.columns[0] == "Area" and grid.columns[-1] == "TOTAL"
    assert [r.Area for r in grid.collect()] == ["MM", "NL", "SL", "VIS", "MIN", "TOTAL"]


def test_entry_file_works_without_the_optional_part():
    """Any library that the training-data operators need may be absent."""
    code = "import sys; sys.modules['ahocorasick'] = sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()))"
    folder = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True)
    assert done.stdout.strip() == "True" and "training-data queries are off" in done.stderr
