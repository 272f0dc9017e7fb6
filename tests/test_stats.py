from __future__ import annotations

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.helpers import sessions
from visitloom.functions.numbers import ratio2
from visitloom.operators.stats import session_aggr_stat, session_band_counts
from visitloom.schemas import SESSION_AGGR_STAT

VISITS = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
STEPS = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]


def counts(spark, rows):
    df = sessions(spark, [(str(i), "2024-01-01 00:00:00", v, s) for i, (v, s) in enumerate(rows)])
    return session_band_counts(df).first().asDict()


def test_visit_bands(spark):
    got = counts(spark, [(v, 0) for v in VISITS])
    assert got["session_count"] == len(VISITS)
    bands = [v for k, v in got.items() if k.startswith("visit_length")]
    assert bands == [2, 2, 2, 2, 2, 2, 2, 2, 1]
    assert sum(bands) == len(VISITS) - 1


def test_step_bands(spark):
    got = counts(spark, [(0, s) for s in STEPS])
    assert [v for k, v in got.items() if k.startswith("step_length")] == [2, 2, 2, 2, 2, 1]


def test_shares(spark):
    df = sessions(spark, [(str(i), "2024-01-01 00:00:00", 2, 5) for i in range(3)])
    row = session_aggr_stat(df, 8).first()
    assert (row["taskid"], row["session_count"]) == (8, 3)
    assert row["visit_length_1s_3s_ratio"] == 1.0
    assert row["step_length_4_6_ratio"] == 1.0
    assert row["visit_length_30m_ratio"] == 0.0


def test_no_sessions(spark):
    df = session_aggr_stat(sessions(spark, []), 8)
    row = df.first()
    assert row["session_count"] == 0
    assert set(row[2:]) == {None}
    assert [f.name for f in df.schema] == SESSION_AGGR_STAT.fieldNames()


def test_ratio_rounds_half_up_exactly(spark):
    pairs = [(n, d) for d in range(1, 121) for n in range(d + 1)]
    rows = (
        spark.createDataFrame(pairs, "n bigint, d bigint")
        .select("n", "d", ratio2("n", "d").alias("r"))
        .collect()
    )
    for n, d, r in rows:
        assert r == int(Fraction(100 * n, d) + Fraction(1, 2)) / 100


@pytest.mark.parametrize("whole", [0, None])
def test_ratio_without_whole(spark, whole):
    df = spark.range(1).select(F.lit(0).alias("n"), F.lit(whole).cast("bigint").alias("d"))
    assert df.select(ratio2("n", "d")).first()[0] is None
