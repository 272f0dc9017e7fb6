"""Every catalog query against its SQL twin, and against known numbers."""

from __future__ import annotations

import __spark_entry__ as entry
import pytest

from tests.compare import connect, duck_rows, spark_rows
from visitloom.plans.catalog import QUERIES
from visitloom.plans.oracle import ORACLE_SQL

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    columns, rows = spark_rows(entry.queries()[name](spark, SMALL))
    expected_columns, expected = duck_rows(duck, entry.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected


def test_entry(spark):
    assert entry.entry(spark).count() == 1


# Measured once on the test tables with another engine.
BANDS = [2422, 41, 66, 74, 331, 135, 279, 130, 236, 521, 1777, 481, 28, 108, 7, 21]


def test_known_band_counts(spark):
    assert list(entry.queries()["session_band_counts"](spark, MEDIUM).first()) == BANDS


@pytest.mark.parametrize(
    ("name", "rows"),
    [
        ("filter_sessions", 227),
        ("filter_sessions_by_category", 70),
        ("session_random_extract", 60),
        ("top10_session", 100),
    ],
)
def test_known_row_counts(spark, name, rows):
    assert entry.queries()[name](spark, MEDIUM).count() == rows


def test_known_top_category(spark):
    ranked = entry.queries()["categories_ranked"](spark, MEDIUM).limit(10).collect()
    assert tuple(ranked[0]) == (96, 31, 29, 21)
    assert tuple(ranked[9]) == (38, 27, 25, 23)
