"""Roll-up of a growing table: states of each day, stored once, merged for any range of days."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitloom.operators.sessions import NO_FILTER, category_numbers, list_texts
from visitloom.params import TaskParams
from visitloom.schemas import SESSION_DAY


def day_states(actions: DataFrame) -> DataFrame:
    """One row per date and session: what any roll-up over whole days needs of that day.

    First and last time, least user and number of actions; the distinct keywords, and how often each
    category was clicked. Actions are counted by keyword and by category first, so a hot session
    shrinks before its shuffle and a state grows with the session's distinct values only.
    """
    some = actions.where(F.col("session_id").isNotNull())
    time = [F.col("action_ts").alias(name) for name in ("first_ts", "last_ts")]
    step = ENTRY.format("nullif(search_keyword, '')", "cast(null as bigint)", "0L", "1L")
    click = ENTRY.format("cast(null as string)", "click_category_id", "1L", "0L")
    entries = f"inline(if(click_category_id is null, array({step}), array({step}, {click})))"
    return _states(_counted(some.select("date", "session_id", "user_id", *time, F.expr(entries)), "date", "session_id"))


#: A keyword or a category; how many clicks (n) and actions (steps) it stands for.
ENTRY = "struct({} as keyword, {} as category, {} as n, {} as steps)"


def _counted(entries: DataFrame, *keys: str) -> DataFrame:
    """Entries added up: a row per keys, keyword and category."""
    return entries.groupBy(*keys, "keyword", "category").agg(*_merged(), F.sum("n").alias("n"))


def _states(counted: DataFrame) -> DataFrame:
    """States of dates and sessions, from a row per keyword and category."""
    per_category = "collect_list(if(category is null, null, struct(category, n)))"
    keywords = F.array_sort(F.collect_set("keyword")).alias("keywords")
    clicks = F.expr(f"array_sort({per_category})").alias("clicks")
    merged = counted.groupBy("date", "session_id").agg(*_merged(), keywords, clicks)
    return merged.select(*SESSION_DAY.fieldNames())


def _merged() -> list[Column]:
    return [
        F.min("user_id").alias("user_id"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.sum("steps").alias("steps"),
    ]


def _values(states: DataFrame, *keys: str) -> DataFrame:
    """The states taken apart again: a row per keys, keyword and category, and one without both."""
    none = "cast(null as string)", "cast(null as bigint)"
    entries = f"""inline(concat(
        transform(keywords, k -> {ENTRY.format("k", none[1], "0L", "0L")}),
        transform(clicks, c -> {ENTRY.format(none[0], "c.category", "c.n", "0L")}),
        array({ENTRY.format(*none, "0L", "steps")})))"""
    return _counted(states.select(*keys, "user_id", "first_ts", "last_ts", F.expr(entries)), *keys)


def store_days(states: DataFrame, path: str, files_per_day: int = 64) -> None:
    """Store states by date; the dates among ``states`` replace what is stored of them, others stay."""
    part = F.pmod(F.xxhash64("session_id"), F.lit(files_per_day))
    (
        states.repartition("date", part)
        .sortWithinPartitions("date", "session_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def add_days(actions: DataFrame, path: str, dates: Iterable[str], files_per_day: int = 64) -> None:
    """Make and store the states of some dates; only their actions are read.

    Dates without any action are left as they are stored.
    """
    kind = actions.schema["date"].dataType
    wanted = [F.lit(d).cast(kind) for d in dates]
    if wanted:
        store_days(day_states(actions.where(F.col("date").isin(*wanted))), path, files_per_day)


def scan_days(spark: SparkSession, path: str, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """The stored states of an inclusive range of dates; other dates are not opened."""
    return days_between(spark.read.schema(SESSION_DAY).parquet(path), start_date, end_date)


def days_between(states: DataFrame, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    kind = states.schema["date"].dataType
    if start_date is not None:
        states = states.where(F.col("date") >= F.lit(start_date).cast(kind))
    if end_date is not None:
        states = states.where(F.col("date") <= F.lit(end_date).cast(kind))
    return states


def _named(sessions: DataFrame) -> DataFrame:
    """With the roll-up's names and the seconds between first and last action."""
    names = {"first_ts": "start_time", "last_ts": "end_time", "steps": "step_length"}
    return sessions.withColumnsRenamed(names).withColumn(
        "visit_length", F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    )


def rollup_of_days(states: DataFrame, params: TaskParams = NO_FILTER) -> DataFrame:
    """The same rows as ``session_rollup`` of the days' actions.

    The flags of ``params`` are read off each day's distinct values (false where the roll-up may have
    null). Sessions of one day and of many shuffle a row per map task, without the lists.
    """
    flags = []
    if params.keywords is not None:
        chosen = F.array(*map(F.lit, params.keywords)).cast("array<string>")
        flags.append(F.bool_or(F.arrays_overlap("keywords", chosen)).alias("keyword_hit"))
    if params.category_ids is not None:
        ids = F.array(*map(F.lit, category_numbers(params.category_ids))).cast("array<bigint>")
        flags.append(F.bool_or(F.arrays_overlap("clicks.category", ids)).alias("category_hit"))
    return _named(states.groupBy("session_id").agg(*_merged(), *flags))


def records_of_days(states: DataFrame) -> DataFrame:
    """The same rows as ``session_records`` of the days' actions: the roll-up with the lists."""
    return _named(_values(states, "session_id").groupBy("session_id").agg(*_merged(), *list_texts()))


def merged_states(states: DataFrame, date: Column) -> DataFrame:
    """States of longer spans, such as months: one row for each ``date`` (made from a day's date) and
    session. They merge as days do: what is made of them equals what is made of their days."""
    spans = states.withColumn("date", date.cast(T.StringType()))
    return _states(_values(spans, "date", "session_id"))
