"""Table layouts, band limits and parameter names shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_LONG, _INT, _TEXT, _REAL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()

# --- Fixed values: column names and types of the source tables ---------------

USER_VISIT_ACTION = _struct(
    ("date", _TEXT),
    ("user_id", _LONG),
    ("session_id", _TEXT),
    ("page_id", _LONG),
    ("action_time", _TEXT),
    ("search_keyword", _TEXT),
    ("click_category_id", _LONG),
    ("click_product_id", _LONG),
    ("order_category_ids", _TEXT),
    ("order_product_ids", _TEXT),
    ("pay_category_ids", _TEXT),
    ("pay_product_ids", _TEXT),
    ("city_id", _LONG),
)

USER_INFO = _struct(
    ("user_id", _LONG),
    ("username", _TEXT),
    ("name", _TEXT),
    ("age", _INT),
    ("professional", _TEXT),
    ("city", _TEXT),
    ("sex", _TEXT),
)

PRODUCT_INFO = _struct(
    ("product_id", _LONG),
    ("product_name", _TEXT),
    ("extend_info", _TEXT),
)

TASK = _struct(
    ("task_id", _LONG),
    ("task_name", _TEXT),
    ("create_time", _TEXT),
    ("start_time", _TEXT),
    ("finish_time", _TEXT),
    ("task_type", _TEXT),
    ("task_status", _TEXT),
    ("task_param", _TEXT),
)

# --- The state of a session on a day -------------------------------------------

SESSION_DAY = _struct(
    ("date", _TEXT),
    ("session_id", _TEXT),
    ("user_id", _LONG),
    ("first_ts", T.TimestampNTZType()),
    ("last_ts", T.TimestampNTZType()),
    ("steps", _LONG),
    ("keywords", T.ArrayType(_TEXT)),
    ("clicks", T.ArrayType(_struct(("category", _LONG), ("n", _LONG)))),
)

# --- Fixed values: task parameter names --------------------------------------

TASK_PARAM_FIELDS = (
    "startDate",
    "endDate",
    "startAge",
    "endAge",
    "professionals",
    "cities",
    "sex",
    "keywords",
    "categoryIds",
)

# --- Fixed values: bands, both limits inclusive, None = open ------------------
# A visit of 0 seconds belongs to no band.

VISIT_BANDS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)

STEP_BANDS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)

# (column of the session roll-up, band column, low, high)
BANDS = tuple(
    (measure, f"{measure}_{name}", low, high)
    for measure, bands in (("visit_length", VISIT_BANDS), ("step_length", STEP_BANDS))
    for name, low, high in bands
)

# --- Fixed values: column names and types of the result tables ----------------

SESSION_AGGR_STAT = _struct(
    ("taskid", _LONG),
    ("session_count", _LONG),
    *((f"{band}_ratio", _REAL) for _, band, _, _ in BANDS),
)

SESSION_RANDOM_EXTRACT = _struct(
    ("taskid", _LONG),
    ("sessionid", _TEXT),
    ("start_time", _TEXT),
    ("search_keywords", _TEXT),
    ("click_category_ids", _TEXT),
)

SESSION_DETAIL = _struct(
    ("taskid", _LONG),
    ("userid", _LONG),
    ("sessionid", _TEXT),
    ("pageid", _LONG),
    ("action_time", _TEXT),
    ("search_keyword", _TEXT),
    ("click_category_id", _LONG),
    ("click_product_id", _LONG),
    ("order_category_ids", _TEXT),
    ("order_product_ids", _TEXT),
    ("pay_category_ids", _TEXT),
    ("pay_product_ids", _TEXT),
)

TOP10_CATEGORY = _struct(
    ("taskid", _LONG),
    ("categoryid", _LONG),
    ("click_count", _LONG),
    ("order_count", _LONG),
    ("pay_count", _LONG),
)

TOP10_SESSION = _struct(
    ("taskid", _LONG),
    ("categoryid", _LONG),
    ("sessionid", _TEXT),
    ("click_count", _LONG),
)

RESULT_TABLES = {
    "session_aggr_stat": SESSION_AGGR_STAT,
    "session_random_extract": SESSION_RANDOM_EXTRACT,
    "session_detail": SESSION_DETAIL,
    "top10_category": TOP10_CATEGORY,
    "top10_session": TOP10_SESSION,
}

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def shape_result(df: DataFrame, schema: T.StructType, taskid: int, **renames: str) -> DataFrame:
    """Select ``df`` into a result table's columns, stamping ``taskid``.

    ``renames`` maps result column -> source column where the names differ.
    """

    def source(field: T.StructField) -> Column:
        if field.name == "taskid":
            return F.lit(taskid)
        column = F.col(renames.get(field.name, field.name))
        if isinstance(df.schema[renames.get(field.name, field.name)].dataType, T.TimestampNTZType):
            return F.date_format(column, TIME_FORMAT)
        return column

    return df.select(*(source(f).cast(f.dataType).alias(f.name) for f in schema.fields))
