"""Every registered query against its SQL, on the smallest tables."""

import os

import compare
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


# File listings have no SQL: paths and times differ from place to place. The optional subpackage lists its own.
WITHOUT_SQL = {"a11_landed_files"} | getattr(contract.llm_queries, "WITHOUT_SQL", frozenset())


def test_every_other_query_has_sql():
    assert set(contract.queries()) - WITHOUT_SQL == set(SQL)


def test_file_listing(spark):
    found = contract.queries()["a11_landed_files"](spark, SF_DIR).collect()
    assert {r.file_path.rsplit("/", 1)[-1]: r.file_size for r in found} == {
        n: os.path.getsize(f"{SF_DIR}/{n}") for n in os.listdir(SF_DIR)
    }


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, con, name):
    assert compare.difference(contract.queries()[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "series_id",
        "date",
        "value",
        "title",
        "friendly_name",
        "units",
        "source",
    ]
