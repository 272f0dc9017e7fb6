"""Clicks, orders and payments per category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.functions.text import explode_ids
from visitloom.schemas import TOP10_CATEGORY, shape_result

TOP_CATEGORIES = 10


def category_events(actions: DataFrame, *keep: str) -> DataFrame:
    """One row per category that an action clicked, ordered or paid: ``kind``, ``category_id``.

    One scan; actions without any category are filtered at the scan.
    """
    ids = {"click": "click_category_id", "order": "order_category_ids", "pay": "pay_category_ids"}
    has_any = " or ".join(f"{column} is not null" for column in ids.values())
    event = "struct('{}' as kind, {} as category_id)"
    # A missing list has no items: a cast that fails costs far more than one that works.
    none = "cast(array() as array<string>)"
    lists = ", ".join(
        f"transform(if({ids[kind]} is null, {none}, filter(split({ids[kind]}, ','), c -> c <> '')), "
        f"c -> {event.format(kind, 'try_cast(c as bigint)')})"
        for kind in ("order", "pay")
    )
    events = f"explode(concat(array({event.format('click', ids['click'])}), {lists})) as event"
    rows = actions.where(has_any).select(*keep, F.expr(events))
    return rows.select(*keep, "event.kind", "event.category_id").where("category_id is not null")


def _counts():
    return [
        F.count_if(F.col("kind") == kind).alias(f"{kind}_count")
        for kind in ("click", "order", "pay")
    ]


def category_click_count(actions: DataFrame) -> DataFrame:
    """Actions with a clicked category, per category."""
    return (
        actions.where(F.col("click_category_id").isNotNull())
        .groupBy(F.col("click_category_id").alias("category_id"))
        .agg(F.count(F.lit(1)).alias("click_count"))
    )


def category_order_count(actions: DataFrame) -> DataFrame:
    """Order list entries per category; repeats in a list count again."""
    return (
        explode_ids(actions, "order_category_ids", "category_id")
        .groupBy("category_id")
        .agg(F.count(F.lit(1)).alias("order_count"))
    )


def category_pay_count(actions: DataFrame) -> DataFrame:
    """Payment list entries per category; repeats in a list count again."""
    return (
        explode_ids(actions, "pay_category_ids", "category_id")
        .groupBy("category_id")
        .agg(F.count(F.lit(1)).alias("pay_count"))
    )


def visited_categories(actions: DataFrame) -> DataFrame:
    """Distinct categories that were clicked, ordered or paid."""
    return category_events(actions).select("category_id").distinct()


def category_counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per visited category, in one pass over the actions."""
    return category_events(actions).groupBy("category_id").agg(*_counts())


def category_counts_by_join(actions: DataFrame) -> DataFrame:
    """Same result as :func:`category_counts`, from four aggregates and three outer joins.

    Reads the actions four times; kept to check the one-pass form against.
    """
    counts = visited_categories(actions)
    for part in (category_click_count, category_order_count, category_pay_count):
        counts = counts.join(part(actions), "category_id", "left")
    return counts.na.fill(0, ["click_count", "order_count", "pay_count"])


def session_category_activity(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per (session, category) of the given sessions.

    Aggregating before the semi join shrinks a huge session to a few rows per
    category. When the sessions fit a broadcast, the optimizer moves the semi
    join below the aggregate by itself.
    """
    activity = (
        category_events(actions.where(F.col("session_id").isNotNull()), "session_id")
        .groupBy("session_id", "category_id")
        .agg(*_counts())
    )
    return activity.join(sessions.select("session_id"), "session_id", "left_semi")


def sum_activity(activity: DataFrame) -> DataFrame:
    """Category counts from per-session activity."""
    return activity.groupBy("category_id").agg(
        *(F.sum(name).alias(name) for name in ("click_count", "order_count", "pay_count"))
    )


_RANKING = ("click_count", "order_count", "pay_count")


def categories_ranked(counts: DataFrame) -> DataFrame:
    """Categories by clicks, then orders, then payments, all descending; ties by id."""
    return counts.orderBy(*(F.desc(name) for name in _RANKING), F.asc("category_id"))


def top_categories(counts: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """The first ``n`` ranked categories."""
    return categories_ranked(counts).limit(n)


def top10_category(top: DataFrame, taskid: int) -> DataFrame:
    return shape_result(top, TOP10_CATEGORY, taskid, categoryid="category_id")
