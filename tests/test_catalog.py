"""Registered queries: contract, and equality with DuckDB on the smallest tables."""

import pathlib
import sys

import pytest

import __spark_entry__ as entry
from headroom import catalog

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent / "tools"))
from check import compare  # noqa: E402

SPARSE = {"combine_tree_thinned"}  # its bids don't meet in the smallest tables


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(catalog.queries()) <= set(entry.queries())


def test_flagship(spark, sf):
    assert entry.entry(spark).count() == 6


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_matches_duckdb(spark, sf, name):
    folder = sf.replace("sf0.001", "sf0.01") if name in SPARSE else sf
    text, _, good = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], folder)
    assert good, text
