"""Proportional, reproducible sample of sessions per day and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from visitloom.operators.bounded import broadcast_if_bounded, first_n_per_group
from visitloom.operators.sessions import lists_of_few
from visitloom.schemas import SESSION_RANDOM_EXTRACT, shape_result

EXTRACT_TOTAL = 100
#: Hours keep so many sessions in their states at most; a larger draw ranks the sessions instead.
STATE_ROWS = 1000


def _with_hour(sessions: DataFrame) -> DataFrame:
    start = F.col("start_time")
    return sessions.where(start.isNotNull()).withColumns(
        {"date": F.to_date(start), "hour": F.hour(start)}
    )


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Number of sessions by date and hour of their start."""
    return (
        _with_hour(sessions)
        .groupBy("date", "hour")
        .agg(F.count(F.lit(1)).alias("session_count"))
    )


def sessions_per_day(sessions: DataFrame) -> DataFrame:
    """Number of sessions by date of their start."""
    return (
        _with_hour(sessions).groupBy("date").agg(F.count(F.lit(1)).alias("session_count"))
    )


def extract_quota_per_hour(sessions: DataFrame, extract_total: int = EXTRACT_TOTAL) -> DataFrame:
    """How many sessions to draw from each (date, hour).

    The total is split evenly over the days (whole division), a day's part in
    proportion to the hours and cut to whole sessions. Few sessions over many
    days may thus draw less than the total. Input after the first aggregate is
    one row per hour that has sessions.
    """
    return _with_quota(sessions_per_hour(sessions), extract_total)


def _with_quota(hours: DataFrame, extract_total: int) -> DataFrame:
    """Add ``day_count`` and ``quota`` to rows of ``date``, ``hour`` and ``session_count``."""
    # Reading every column, though only the days count, keeps this plan equal to the one above up
    # to the shuffle, so that Spark runs the aggregate once for both.
    states = [F.max(F.size(c)) for c in hours.columns if c not in ("date", "hour", "session_count")]
    overall = hours.agg(
        F.struct(
            F.count_distinct("date").alias("days"), F.sum("session_count").alias("sessions"), *states
        ).alias("overall")
    ).scalar()
    per_day = F.floor(F.lit(extract_total) / overall["days"])
    day_count = F.sum("session_count").over(Window.partitionBy("date"))
    count = F.col("session_count")
    share = count.cast("double") / F.col("day_count").cast("double") * per_day
    return hours.withColumn("day_count", day_count).withColumn(
        "quota", F.least(F.floor(share), count)
    )


def first_sessions_per_hour(sessions: DataFrame, seed: int | str, n: int) -> DataFrame:
    """For each (date, hour) the number of sessions and its first ``n`` in the order of a seeded hash.

    One pass: a task keeps a count and ``n`` sessions per hour, whatever it reads, and these states
    are merged after the shuffle. ``first`` lists structs of ``_draw`` (the hash) and ``session``,
    in order; sessions with equal hashes go by id, then by their other columns.
    """
    others = [c for c in sessions.columns if c != "session_id"]
    draw = F.md5(F.concat("session_id", F.lit(f"#{seed}"))).alias("_draw")
    state = F.struct(draw, F.struct("session_id", *others).alias("session"))
    return (
        _with_hour(sessions)
        .groupBy("date", "hour")
        .agg(
            F.count(F.lit(1)).alias("session_count"),
            InternalFunction.collect_top_k(state, n, True).alias("first"),
        )
        .withColumn("first", F.array_sort("first"))
    )


def draw_sessions(
    sessions: DataFrame, seed: int | str, extract_total: int = EXTRACT_TOTAL
) -> DataFrame:
    """Draw each hour's quota of sessions without replacement, in the order of a seeded hash.

    At most ``extract_total`` rows come out, each with its ``place`` within its
    hour, and the hours with a quota are at most as many. No hour is gathered in
    one task. The sessions are read once: every task keeps the count and the
    first sessions of each hour. Beyond 1000 sessions such states are too large
    to hold; then counts and sessions are read apart, and every task cuts its own
    sessions to ``extract_total`` per hour before the shuffle. Both draw the same.
    """
    if extract_total > STATE_ROWS:
        return _draw_by_rank(sessions, seed, extract_total)
    hours = first_sessions_per_hour(sessions, seed, extract_total)
    drawn = _with_quota(hours, extract_total).where(F.col("quota") > 0)
    rows = drawn.select("quota", F.posexplode("first").alias("before", "drawn"))
    rows = rows.where(F.col("before") < F.col("quota"))
    place = (F.col("before") + 1).alias("place")
    return rows.select(*(F.col("drawn.session")[c].alias(c) for c in sessions.columns), place)


def _draw_by_rank(sessions: DataFrame, seed: int | str, extract_total: int) -> DataFrame:
    quotas = (
        extract_quota_per_hour(sessions, extract_total)
        .where(F.col("quota") > 0)
        .select("date", "hour", "quota")
    )
    pool = _with_hour(sessions).join(
        broadcast_if_bounded(quotas, extract_total), ["date", "hour"]
    )
    pool = pool.withColumn("_draw", F.md5(F.concat("session_id", F.lit(f"#{seed}"))))
    drawn = first_n_per_group(
        pool,
        group=["date", "hour"],
        order=[F.col("_draw"), F.col("session_id")],
        n=extract_total,
        salt_on="session_id",
        rank="place",
    )
    return drawn.where(F.col("place") <= F.col("quota")).select(*sessions.columns, "place")


def session_random_extract(
    actions: DataFrame, drawn: DataFrame, taskid: int, extract_total: int = EXTRACT_TOTAL
) -> DataFrame:
    """The drawn sessions with their keyword and category lists (null where empty).

    A session that a repeated user row made twice, and that was drawn twice,
    comes out twice: its places differ.
    """
    chosen = drawn.select("session_id", "place", "start_time")
    rows = lists_of_few(actions, chosen, extract_total)
    return shape_result(rows, SESSION_RANDOM_EXTRACT, taskid, sessionid="session_id")
