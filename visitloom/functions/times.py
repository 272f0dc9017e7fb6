"""Date and time operators on text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Output column -> pattern.
TIME_KEYS = {
    "date": "yyyy-MM-dd",
    "time": "yyyy-MM-dd HH:mm:ss",
    "date_key": "yyyyMMdd",
    "minute_key": "yyyyMMddHHmm",
    "date_hour": "yyyy-MM-dd_HH",
}


# Fixed value: the shape of a time text, hours padded or not.
TIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{1,2}:\d{2}:\d{2}\z"


def parse_time(text: Column) -> Column:
    """``yyyy-MM-dd H:mm:ss`` text (padded or not) to a timestamp, null when malformed.

    A cast parses several times faster than a format pattern; the shape keeps out what the cast
    alone would take: zones, fractions, partial times, a T, white space at the end.
    """
    return F.when(text.rlike(TIME_SHAPE), text.try_cast(T.TimestampNTZType()))


def as_timestamp(df: DataFrame, column: str) -> Column:
    """The column as a zone-less timestamp, parsed only when it is text."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return parse_time(F.col(column))
    return F.col(column).cast(T.TimestampNTZType())


def parse_action_times(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Add the time parsed from a text column; malformed text gives null."""
    return df.withColumn(out or column, as_timestamp(df, column))


def parse_date_keys(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add the date parsed from ``yyyyMMdd`` text; malformed text gives null."""
    iso = F.regexp_replace(F.col(column), r"^(\d{4})(\d{2})(\d{2})\z", "$1-$2-$3")
    return df.withColumn(out, F.when(F.col(column).rlike(r"^\d{8}\z"), iso.try_cast(T.DateType())))


def add_time_keys(df: DataFrame, column: str) -> DataFrame:
    """Add the date, time, day key, minute key and hour key of a timestamp."""
    ts = as_timestamp(df, column)
    return df.withColumns({name: F.date_format(ts, pattern) for name, pattern in TIME_KEYS.items()})


def add_elapsed(df: DataFrame, first: str, second: str) -> DataFrame:
    """Compare two times: ``is_before``, ``is_after`` and ``elapsed`` = first - second in seconds.

    Seconds are a bigint, cut toward zero. Malformed times give false, false and 0.
    """
    a, b = as_timestamp(df, first), as_timestamp(df, second)
    seconds = F.timestamp_diff("SECOND", b, a)
    return df.withColumns(
        {
            "is_before": F.coalesce(a < b, F.lit(False)),
            "is_after": F.coalesce(a > b, F.lit(False)),
            "elapsed": F.coalesce(seconds, F.lit(0).cast("bigint")),
        }
    )
