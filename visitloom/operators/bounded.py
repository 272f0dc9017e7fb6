"""Joins and cuts that stay balanced: small bounded sides, skewed keys, huge groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000
SALTS = 256


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only when ``df`` provably holds few rows.

    ``max_rows`` must follow from how ``df`` was built (a limit, a top-n, a
    quota). Beyond the limit Spark decides by measured size.
    """
    return F.broadcast(df) if max_rows <= BROADCAST_ROWS else df


def own_shuffle(df: DataFrame, key: str = "session_id") -> DataFrame:
    """Hide that ``df`` is already partitioned by a text key, so that what follows shuffles it.

    Spark splits a skewed join partition only when both sides come straight
    from a shuffle, and only when nothing after the join relies on its
    partitioning.
    """
    return df.withColumn(key, F.concat(key, F.lit("")))


def first_n_per_group(
    df: DataFrame, group: list[str], order: list[Column], n: int, salt_on: str, rank: str
) -> DataFrame:
    """Keep the first ``n`` rows of each group in ``order``, numbered in ``rank``.

    Up to Spark's group-limit threshold every task first cuts its own rows to
    ``n`` per group, so a huge group never meets in one task. For larger ``n``
    Spark drops that step; then the group is cut by salt first.
    """
    spark = df.sparkSession
    threshold = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > threshold:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_on), F.lit(SALTS)))
        by_salt = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = salted.withColumn(rank, F.row_number().over(by_salt)).where(F.col(rank) <= n)
        df = df.drop("_salt", rank)
    by_group = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(by_group)).where(F.col(rank) <= n)
