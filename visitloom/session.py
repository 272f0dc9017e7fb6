"""Spark settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Advice, never forced on a session that the caller built.
RECOMMENDED_CONF = {
    # Plan again at run time: coalesce small shuffle partitions, split skewed
    # join partitions, switch to a broadcast join when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wall-clock text is parsed and shown without time zone shifts.
    "spark.sql.session.timeZone": "UTC",
    # Do not record a Python call site per column expression; only plan building gains.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shuffle_partitions(input_bytes: int, target_bytes: int = 256 << 20, minimum: int = 200) -> int:
    """Shuffle partitions so that one holds about ``target_bytes`` of the input."""
    return max(minimum, -(-input_bytes // target_bytes))


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
