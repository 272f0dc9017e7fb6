"""Session roll-up, user join, session filter and filtered actions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitloom.functions.predicates import all_of, between, one_of
from visitloom.operators.bounded import BROADCAST_ROWS, own_shuffle
from visitloom.params import TaskParams

NO_FILTER = TaskParams()


def session_rollup(actions: DataFrame, params: TaskParams = NO_FILTER) -> DataFrame:
    """One row per session: user, first and last action, seconds between, number of actions.

    Where ``params`` restricts keywords or clicked categories, two flags tell
    whether the session has any match. They are computed in the same aggregate,
    so no list per session is ever built and a session of any size shrinks to
    one row per map task before the shuffle. All buffers are fixed width, which
    keeps this a hash aggregate.
    """
    measures = [
        F.min("user_id").alias("user_id"),
        F.min("action_ts").alias("start_time"),
        F.max("action_ts").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
    ]
    for flag, match in (
        ("keyword_hit", one_of(F.col("search_keyword"), params.keywords)),
        ("category_hit", one_of(F.col("click_category_id"), category_numbers(params.category_ids))),
    ):
        if match is not None:
            measures.append(F.bool_or(match).alias(flag))
    sessions = actions.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(*measures)
    return sessions.withColumn(
        "visit_length", F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    )


BIGINT = range(-(2**63), 2**63)


def category_numbers(texts: tuple[str, ...] | None) -> tuple[int, ...] | None:
    """Category ids as numbers; text that is not how a bigint is written matches none."""
    if texts is None:
        return None
    ids = (int(t) for t in texts if re.fullmatch(r"0|-?[1-9][0-9]{0,18}", t))
    return tuple(i for i in ids if i in BIGINT)


def list_texts() -> list[Column]:
    """The lists of a session, from its actions counted by distinct (keyword, category).

    A buffer grows with the distinct values of a session; repeats are written out in the text only.
    """
    clicks = "array_sort(collect_list(if(category is null, null, struct(category, cast(n as int) as n))))"
    return [
        F.expr("nullif(array_join(array_sort(collect_set(keyword)), ','), '')").alias(
            "search_keywords"
        ),
        F.expr(
            f"""nullif(rtrim(',', array_join(
                transform({clicks}, c -> repeat(concat(c.category, ','), c.n)), '')), '')"""
        ).alias("click_category_ids"),
    ]


def _counted(actions: DataFrame, keys: list[str], *measures: Column) -> DataFrame:
    """Actions counted (``n``) by keys, keyword and clicked category; a hot session shrinks here."""
    values = actions.where(F.col("session_id").isNotNull()).withColumns(
        {"keyword": F.expr("nullif(search_keyword, '')"), "category": F.col("click_category_id")}
    )
    return values.groupBy(*keys, "keyword", "category").agg(F.count(F.lit(1)).alias("n"), *measures)


def session_lists(actions: DataFrame) -> DataFrame:
    """Per session: sorted distinct keywords, and sorted clicked categories with repeats.

    One row per session, however long; sessions without any value are absent. A list is one cell:
    beyond what Spark can hold in one, the query fails. :func:`session_list_entries` has no cells.
    """
    some = actions.where("nullif(search_keyword, '') is not null or click_category_id is not null")
    return _counted(some, ["session_id"]).groupBy("session_id").agg(*list_texts())


def session_list_entries(actions: DataFrame) -> DataFrame:
    """The same lists as rows, for sessions of any size: kind (keyword or category), value, and in
    ``n`` how many actions of the session have it."""
    entries = actions.where(F.col("session_id").isNotNull()).selectExpr(
        "session_id",
        """stack(2, 'keyword', nullif(search_keyword, ''),
            'category', cast(click_category_id as string)) as (kind, value)""",
    )
    counted = entries.where("value is not null").groupBy("session_id", "kind", "value")
    return counted.agg(F.count(F.lit(1)).alias("n"))


def session_records(actions: DataFrame) -> DataFrame:
    """The roll-up with the lists: one scan, first by distinct keyword and category, then by session."""
    counted = _counted(
        actions,
        ["session_id"],
        F.min("user_id").alias("user_id"),
        F.min("action_ts").alias("first_ts"),
        F.max("action_ts").alias("last_ts"),
    )
    records = counted.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("first_ts").alias("start_time"),
        F.max("last_ts").alias("end_time"),
        F.sum("n").alias("step_length"),
        *list_texts(),
    )
    return records.withColumn(
        "visit_length", F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    )


def lists_of_few(actions: DataFrame, chosen: DataFrame, max_rows: int) -> DataFrame:
    """The lists of at most ``max_rows`` chosen sessions, beside the columns of ``chosen``.

    ``chosen`` holds distinct rows. While ``max_rows`` is small only the counted values are
    shuffled. Lists are null for sessions without a value.
    """
    sized = F.broadcast(chosen) if max_rows <= BROADCAST_ROWS else own_shuffle(chosen)
    narrow = actions.select("session_id", "search_keyword", "click_category_id")
    counted = _counted(narrow.join(sized, "session_id"), chosen.columns)
    return counted.groupBy(*chosen.columns).agg(*list_texts())


def session_keywords(actions: DataFrame) -> DataFrame:
    """Distinct search keywords of each session that searched."""
    lists = session_lists(actions.withColumn("click_category_id", F.lit(None).cast("bigint")))
    return lists.select("session_id", "search_keywords")


def session_click_categories(actions: DataFrame) -> DataFrame:
    """Clicked category ids, repeats kept, of each session that clicked."""
    lists = session_lists(actions.withColumn("search_keyword", F.lit(None).cast("string")))
    return lists.select("session_id", "click_category_ids")


def session_full_info(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Add the user's attributes; sessions of unknown users vanish.

    No hint: Spark broadcasts the users when their measured size allows it and
    otherwise splits the sessions of a skewed user at run time.
    """
    attributes = users.where(F.col("user_id").isNotNull()).select(
        "user_id", "age", "professional", "city", "sex"
    )
    return sessions.join(attributes, "user_id")


def session_predicates(params: TaskParams) -> dict[str, object]:
    """The predicates on a session of :func:`session_full_info`, by name; None = off."""
    return {
        "age": between(F.col("age"), params.start_age, params.end_age),
        "professional": one_of(F.col("professional"), params.professionals),
        "city": one_of(F.col("city"), params.cities),
        "sex": one_of(F.col("sex"), params.sex),
        "keyword": None if params.keywords is None else F.col("keyword_hit"),
        "category": None if params.category_ids is None else F.col("category_hit"),
    }


def filter_sessions(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """Keep the sessions that satisfy every given parameter.

    ``sessions`` must carry the flags of a roll-up made with the same
    parameters. User predicates are pushed into the user scan by the optimizer.
    """
    kept = sessions.where(all_of(session_predicates(params).values()))
    return kept.drop("keyword_hit", "category_hit")


def select_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Roll up, join the users and filter, in one plan."""
    return filter_sessions(session_full_info(session_rollup(actions, params), users), params)
