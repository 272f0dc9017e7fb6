"""Reading and storing the source tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from visitloom.functions.times import as_timestamp
from visitloom.schemas import PRODUCT_INFO, TASK, USER_INFO, USER_VISIT_ACTION


@dataclass(frozen=True)
class Tables:
    """The source tables of a job, as lazy DataFrames.

    ``days``: the states of all days of ``actions`` (``operators.days``), where they are kept.
    """

    actions: DataFrame
    users: DataFrame
    tasks: DataFrame | None = None
    days: DataFrame | None = None

    @classmethod
    def from_paths(cls, spark: SparkSession, root: str, fmt: str = "parquet") -> Tables:
        """Tables stored under ``root``; the schemas are declared, never inferred.

        Without a stored ``task`` there are no tasks.
        """

        def read(name: str, schema: object) -> DataFrame:
            return spark.read.format(fmt).schema(schema).load(f"{root}/{name}")

        try:
            tasks = read("task", TASK)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            tasks = None
        return cls(
            actions=read("user_visit_action", USER_VISIT_ACTION),
            users=read("user_info", USER_INFO),
            tasks=tasks,
        )

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None) -> Tables:
        """Tables or views registered in the catalog."""
        prefix = f"{database}." if database else ""
        return cls(
            actions=spark.table(f"{prefix}user_visit_action"),
            users=spark.table(f"{prefix}user_info"),
            tasks=spark.table(f"{prefix}task") if spark.catalog.tableExists(f"{prefix}task") else None,
        )


def typed(df: DataFrame, schema: T.StructType) -> list[str | Column]:
    """The columns of ``schema``, cast only where the stored type differs."""
    stored = df.schema
    return [
        f.name
        if stored[f.name].dataType == f.dataType
        else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in schema
    ]


def scan_actions(
    actions: DataFrame, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """Actions of an inclusive date range, with the parsed time as ``action_ts``.

    The bounds take the type of the stored ``date`` column, so they reach the
    scan as partition or parquet filters whether it is text or a date.
    """
    kind = actions.schema["date"].dataType
    scanned = actions
    if start_date is not None:
        scanned = scanned.where(F.col("date") >= F.lit(start_date).cast(kind))
    if end_date is not None:
        scanned = scanned.where(F.col("date") <= F.lit(end_date).cast(kind))
    time = as_timestamp(actions, "action_time").alias("action_ts")
    return scanned.select(*typed(actions, USER_VISIT_ACTION), time)


def scan_users(users: DataFrame) -> DataFrame:
    """The user dimension; unused columns are pruned by the optimizer."""
    return users.select(*typed(users, USER_INFO))


def scan_products(products: DataFrame) -> DataFrame:
    """The product dimension with its ``product_status`` read from the JSON attribute."""
    status = F.get_json_object("extend_info", "$.product_status").try_cast("int")
    return products.select(*typed(products, PRODUCT_INFO), status.alias("product_status"))


def store_actions(actions: DataFrame, path: str, partitions: int, sessions_per_file: int = 1_000_000) -> None:
    """Store actions as parquet, one directory per date, rows of a session side by side.

    Scans then prune by date, a map task sees most actions of its sessions (so
    the roll-up shrinks before its shuffle), and detail reads skip row groups.
    Range partitioning by time as the last key splits a hot date or session. The dates in
    ``actions`` replace what is stored of them; other dates stay.

    Every row group has a Bloom filter of its session ids, sized for at most ``sessions_per_file``
    different ones: reads of chosen sessions skip row groups by it whatever the ids' number and
    however the ids are spread, where the least and largest id of a row group tell nothing.
    """
    keys = ["date", "session_id", "action_time"]
    writer = (
        actions.repartitionByRange(partitions, *keys)
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
    )
    with_session_filter(writer, sessions_per_file).parquet(path)


def with_session_filter(writer: DataFrameWriter, sessions_per_file: int) -> DataFrameWriter:
    """The parquet writer, told to store Bloom filters of session_id.

    The filter takes the place of the column's dictionary, which the reader would consult instead.
    It grows with the ids a row group really has, up to ``sessions_per_file``.
    """
    return (
        writer.option("parquet.bloom.filter.enabled#session_id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.bloom.filter.expected.ndv#session_id", str(sessions_per_file))
        .option("parquet.enable.dictionary#session_id", "false")
    )


def store_actions_by_session(
    actions: DataFrame, table: str, buckets: int, path: str | None = None, sessions_per_file: int = 1_000_000
) -> None:
    """Store actions as a catalog table in ``buckets`` buckets by session, each sorted by session.

    What is keyed by session then needs no shuffle of the actions: the roll-up, clicks per session
    and joins of the table's own sessions run where the bucket is read. The price: a bucket is one
    task, so choose as many buckets as make them fit, and :func:`store_actions` where single
    sessions are huge. A table of that name is replaced; ``path`` puts the files elsewhere than the
    catalog's own folder.

    The actions are shuffled here once, to the very buckets, so each has one file.
    """
    writer = (
        actions.repartition(buckets, "session_id")
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "session_id")
        .sortBy("session_id", "action_time")
    )
    if path is not None:
        writer = writer.option("path", path)
    with_session_filter(writer, sessions_per_file).saveAsTable(table)
