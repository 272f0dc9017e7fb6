"""Band histogram of visit and step lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitloom.functions.numbers import ratio2
from visitloom.schemas import BANDS, SESSION_AGGR_STAT, shape_result


def _within(measure: str, low: int, high: int | None) -> Column:
    column = F.col(measure)
    return column >= low if high is None else column.between(low, high)


def session_band_counts(sessions: DataFrame) -> DataFrame:
    """One row: number of sessions, and number of sessions in each band."""
    return sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *(F.count_if(_within(measure, low, high)).alias(band) for measure, band, low, high in BANDS),
    )


def session_aggr_stat(sessions: DataFrame, taskid: int) -> DataFrame:
    """Share of each band in all sessions, 2 decimals half up; null shares without sessions."""
    shares = session_band_counts(sessions).select(
        "session_count",
        *(ratio2(band, "session_count").alias(f"{band}_ratio") for _, band, _, _ in BANDS),
    )
    return shape_result(shares, SESSION_AGGR_STAT, taskid)
