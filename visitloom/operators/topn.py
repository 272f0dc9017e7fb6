"""Most active sessions of the top categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.operators.bounded import broadcast_if_bounded, first_n_per_group
from visitloom.schemas import TOP10_SESSION, shape_result

TOP_SESSIONS = 10


def session_category_clicks(actions: DataFrame) -> DataFrame:
    """Clicks per (session, category)."""
    return (
        actions.where(F.col("session_id").isNotNull() & F.col("click_category_id").isNotNull())
        .groupBy("session_id", F.col("click_category_id").alias("category_id"))
        .agg(F.count(F.lit(1)).alias("click_count"))
    )


def top_category_session_counts(top: DataFrame, clicks: DataFrame, max_rows: int) -> DataFrame:
    """Per-session clicks of the top categories (``top`` has at most ``max_rows`` rows).

    Written as a semi join (the categories of ``top`` are distinct), which the
    optimizer moves below the aggregate that made ``clicks``.
    """
    ids = broadcast_if_bounded(top.select("category_id"), max_rows)
    return clicks.join(ids, "category_id", "left_semi").select(
        "category_id", "session_id", "click_count"
    )


def top_sessions(counts: DataFrame, n: int = TOP_SESSIONS) -> DataFrame:
    """The ``n`` sessions with most clicks per category; ties by session id.

    No category is gathered in one task, see :func:`first_n_per_group`.
    """
    return first_n_per_group(
        counts,
        group=["category_id"],
        order=[F.desc("click_count"), F.asc("session_id")],
        n=n,
        salt_on="session_id",
        rank="_place",
    ).drop("_place")


def top10_session(top: DataFrame, taskid: int) -> DataFrame:
    return shape_result(
        top, TOP10_SESSION, taskid, categoryid="category_id", sessionid="session_id"
    )
