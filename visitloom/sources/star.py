"""Adapter: star-schema and event tables -> the tables of the session analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitloom.schemas import PRODUCT_INFO, TASK, USER_INFO, USER_VISIT_ACTION
from visitloom.sources.tables import Tables

# --- Fixed values ---------------------------------------------------------------

SEARCH_KEYWORDS = (
    "lamp", "rug", "mirror", "bookshelf", "clock",
    "desk lamp", "vase", "candle", "pillow", "curtain",
)
UNKNOWN_USERS = 1_000_000_000  # added to the id of every 17th user in the actions
SESSION_SPAN_DAYS = (1, 1, 1, 7, 30)  # by user_id % 5
TIME_DIVISORS = (3600, 600, 60, 1)  # by user_id / 5 % 4; compresses a day's times


# Columns read from each table; declared, so that no file is opened to infer them.
SOURCES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string",
    "orders": "o_orderkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
}


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SOURCES[table]).parquet(f"{sf_dir}/{table}.parquet")


def _pick(values: tuple[int | str, ...], index: str) -> str:
    """SQL for the element of a fixed list at a zero-based index."""
    items = ", ".join(repr(v) for v in values)
    return f"element_at(array({items}), cast({index} + 1 as int))"


def _shaped(df: DataFrame, schema: T.StructType, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(
        *(f"cast({columns[f.name]} as {f.dataType.simpleString()}) as {f.name}" for f in schema)
    )


def user_visit_action(
    spark: SparkSession, sf_dir: str, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """``events`` as actions; times are text with unpadded hours.

    The inclusive dates bound the stored time as it is, so they reach the reader. The actions of
    every 17th user name one who is not in ``user_info``, so the user join drops some.
    """
    stored = source(spark, sf_dir, "events")
    if start_date is not None:
        stored = stored.where(F.col("ts") >= F.lit(start_date).cast("timestamp_ntz"))
    if end_date is not None:
        after = F.date_add(F.lit(end_date).cast("date"), 1)
        stored = stored.where(F.col("ts") < after.cast("timestamp_ntz"))
    events = stored.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "cast(ts as date) as day",
        # Far faster than a JSON parse, and the one key of props is a whole number.
        """cast(regexp_extract(props, '"k": *([0-9]+)', 1) as bigint) as k""",
        "(hour(ts) * 3600 + minute(ts) * 60 + second(ts)) div "
        + _pick(TIME_DIVISORS, "(user_id div 5) % 4")
        + " as second",
    )
    span = _pick(SESSION_SPAN_DAYS, "user_id % 5")
    columns = {
        "date": "day",
        "user_id": f"if(user_id % 17 = 0, user_id + {UNKNOWN_USERS}, user_id)",
        "session_id": f"concat('u', user_id, '_', (dayofmonth(day) - 1) div {span})",
        "page_id": "event_id % 10",
        "action_time": "concat(day, ' ', second div 3600, ':', "
        "lpad(second div 60 % 60, 2, '0'), ':', lpad(second % 60, 2, '0'))",
        "search_keyword": f"if(event_type = 'view', {_pick(SEARCH_KEYWORDS, 'k % 10')}, null)",
        "click_category_id": "if(event_type = 'click', k, null)",
        "click_product_id": "if(event_type = 'click', event_id % 100, null)",
        "order_category_ids": "case when event_type <> 'purchase' then null "
        "when event_id % 3 = 0 then concat(k, ',', (7 * k + 1) % 100) else cast(k as string) end",
        "order_product_ids": "if(event_type = 'purchase', event_id % 100, null)",
        "pay_category_ids": "case when event_type <> 'signup' then null "
        "when event_id % 4 = 0 then concat(k, ',', (3 * k + 2) % 100) else cast(k as string) end",
        "pay_product_ids": "if(event_type = 'signup', event_id % 100, null)",
        "city_id": "user_id % 10",
    }
    return _shaped(events, USER_VISIT_ACTION, columns)


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with its nation as users."""
    customer = source(spark, sf_dir, "customer")
    nation = source(spark, sf_dir, "nation")
    columns = {
        "user_id": "c_custkey",
        "username": "concat('user', c_custkey)",
        "name": "c_name",
        "age": "(c_custkey * 37) % 60",
        "professional": "c_mktsegment",
        "city": "n_name",
        "sex": "if(c_custkey % 2 = 0, 'male', 'female')",
    }
    joined = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    return _shaped(joined, USER_INFO, columns)


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as products with a JSON attribute."""
    columns = {
        "product_id": "p_partkey",
        "product_name": "p_name",
        "extend_info": """concat('{"product_status": ', p_partkey % 2, '}')""",
    }
    return _shaped(source(spark, sf_dir, "part"), PRODUCT_INFO, columns)


def task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as tasks; which parameters a task has depends on its key."""

    def field(name: str, value: str, when: str = "true") -> str:
        return f"""if({when}, concat('"{name}":["', {value}, '"]'), null)"""

    start = "concat('2024-01-', lpad(o_orderkey % 10 + 1, 2, '0'))"
    end = "concat('2024-01-', lpad(o_orderkey % 11 + 20, 2, '0'))"
    fields = ", ".join(
        (
            field("startDate", start),
            field("endDate", end, "o_orderkey % 4 <> 0"),
            field("startAge", "o_orderkey % 30", "o_orderkey % 2 = 0"),
            field("endAge", "o_orderkey % 30 + 25", "o_orderkey % 3 = 0"),
            field("keywords", "'lamp,rug,pillow'", "o_orderkey % 5 = 0"),
            field(
                "categoryIds",
                "concat(o_orderkey % 100, ',', o_orderkey % 13)",
                "o_orderkey % 7 = 0",
            ),
            """if(o_orderkey % 6 = 0, '"sex":[]', null)""",
        )
    )
    created = "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')"
    columns = {
        "task_id": "o_orderkey",
        "task_name": "concat('task', o_orderkey)",
        "create_time": created,
        "start_time": created,
        "finish_time": "null",
        "task_type": "o_orderpriority",
        "task_status": "o_orderstatus",
        "task_param": f"concat('{{', concat_ws(',', {fields}), '}}')",
    }
    return _shaped(source(spark, sf_dir, "orders"), TASK, columns)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        actions=user_visit_action(spark, sf_dir),
        users=user_info(spark, sf_dir),
        tasks=task(spark, sf_dir),
    )
