"""Hand-sized tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visitloom.schemas import USER_INFO, USER_VISIT_ACTION
from visitloom.sources.tables import scan_actions


def action(session, time="2024-01-01 5:00:00", user=1, **columns):
    row = {name: None for name in USER_VISIT_ACTION.fieldNames()}
    row.update(session_id=session, action_time=time, user_id=user, date=(time or "")[:10])
    row.update(page_id=0, city_id=0)
    row.update(columns)
    return row


def raw_actions(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = USER_VISIT_ACTION.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], USER_VISIT_ACTION)


def actions(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return scan_actions(raw_actions(spark, rows))


def users(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Rows of (user_id, age, professional, city, sex)."""
    full = [(i, f"user{i}", f"name{i}", age, job, city, sex) for i, age, job, city, sex in rows]
    return spark.createDataFrame(full, USER_INFO)


def sessions(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (session_id, start_time, visit_length, step_length)."""
    df = spark.createDataFrame(
        rows, "session_id string, start string, visit_length bigint, step_length bigint"
    )
    return df.selectExpr(
        "session_id", "cast(start as timestamp_ntz) as start_time", "visit_length", "step_length"
    )


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df: DataFrame) -> str:
    """What ran, of a frame that ran: the plan without the initial plans, also those of subqueries."""
    kept, hidden = [], None
    for line in plan_of(df).split("\n"):
        at = len(line) - len(line.lstrip(" :+-"))
        if hidden is not None and at >= hidden:
            continue
        hidden = at if "== Initial Plan ==" in line else None
        if hidden is None:
            kept.append(line)
    return "\n".join(kept)
