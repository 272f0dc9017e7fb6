"""Raw actions as text, checked column by column: what cannot be read is kept apart, with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitloom.functions.times import parse_time
from visitloom.schemas import USER_VISIT_ACTION

#: Columns that every action has.
NEEDED = ("date", "user_id", "session_id", "action_time")
LISTS = ("order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids")

RAW_ACTION = T.StructType([T.StructField(f.name, T.StringType()) for f in USER_VISIT_ACTION])
PROBLEM = "array<struct<column: string, reason: string>>"


def _reasons(name: str, kind: T.DataType) -> list[tuple[str, Column]]:
    """Reasons to refuse a text column, each with the condition; at most one holds."""
    value = F.col(name)
    reasons = [("missing", value.isNull() | (value == ""))] if name in NEEDED else []
    given = value.isNotNull() & (value != "")
    if isinstance(kind, T.LongType):
        reasons.append(("not a whole number", given & (~value.rlike(r"^[+-]?[0-9]+\z") | value.try_cast("bigint").isNull())))
    elif name == "date":
        is_date = value.rlike(r"^\d{4}-\d{2}-\d{2}\z") & value.try_cast("date").isNotNull()
        reasons.append(("not a date", given & ~is_date))
    elif name == "action_time":
        reasons.append(("not a time", given & parse_time(value).isNull()))
    elif name in LISTS:
        bad = F.exists(F.split(value, ","), lambda item: ~item.rlike(r"^[0-9]+\z") | item.try_cast("bigint").isNull())
        reasons.append(("not a list of whole numbers", given & bad))
    return reasons


def audited_actions(raw: DataFrame) -> DataFrame:
    """Every raw action with ``problems``: the columns that cannot be read, and why (empty if none).

    ``raw`` has the columns of actions as text, as files of separated values or JSON give them. Empty
    text counts as missing. The date must also be that of the time.
    """
    found = [
        F.when(holds, F.struct(F.lit(f.name).alias("column"), F.lit(reason).alias("reason")))
        for f in USER_VISIT_ACTION
        for reason, holds in _reasons(f.name, f.dataType)
    ]
    other_day = F.date_format(parse_time(F.col("action_time")), "yyyy-MM-dd") != F.col("date")
    other = F.struct(F.lit("action_time").alias("column"), F.lit("on another date").alias("reason"))
    is_date = F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}\z") & F.col("date").try_cast("date").isNotNull()
    found.append(F.when(other_day & is_date, other))
    return raw.select(*RAW_ACTION.fieldNames(), F.array_compact(F.array(*found)).cast(PROBLEM).alias("problems"))


def accepted(audited: DataFrame) -> DataFrame:
    """The rows without problems, in the types of actions; ``scan_actions`` takes them."""
    clean = audited.where(F.size("problems") == 0)
    return clean.select(*(F.nullif(f.name, F.lit("")).cast(f.dataType).alias(f.name) for f in USER_VISIT_ACTION))


def rejected(audited: DataFrame) -> DataFrame:
    """A row per problem: column, reason, the text found there, and the whole raw row as JSON."""
    names = RAW_ACTION.fieldNames()
    row = F.to_json(F.struct(*names)).alias("row")
    by_name = F.create_map(*(c for n in names for c in (F.lit(n), F.col(n))))
    told = audited.select(row, by_name.alias("texts"), F.explode("problems").alias("problem"))
    text = F.element_at("texts", F.col("problem.column")).alias("value")
    return told.select("problem.column", "problem.reason", text, "row")


def reject_counts(audited: DataFrame) -> DataFrame:
    """How many rows have each problem, and how many have any (reason ``any``) or none (``none``)."""
    reasons = F.transform("problems", lambda p: F.struct(p["column"].alias("column"), p["reason"].alias("reason")))
    whole = F.struct(F.lit("").alias("column"), F.when(F.size("problems") > 0, "any").otherwise("none").alias("reason"))
    each = audited.select(F.explode(F.array_append(reasons, whole)).alias("problem"))
    return each.groupBy("problem.column", "problem.reason").agg(F.count(F.lit(1)).alias("row_count"))


def store_audited(audited: DataFrame, path: str) -> None:
    """Clean and refused rows in one pass over the raw ones: folders ``clean=true`` and ``clean=false``."""
    marked = audited.withColumn("clean", F.size("problems") == 0)
    marked.write.mode("overwrite").partitionBy("clean").parquet(path)


def read_audited(spark: SparkSession, path: str, clean: bool) -> DataFrame:
    """One of the two folders of ``store_audited``; the other is not opened."""
    schema = T.StructType([*RAW_ACTION, *spark.createDataFrame([], f"problems {PROBLEM}, clean boolean").schema])
    return spark.read.schema(schema).parquet(path).where(F.col("clean") == clean).drop("clean")
