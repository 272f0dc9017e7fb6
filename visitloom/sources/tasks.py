"""Tasks and their parameter documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitloom.params import TaskParams
from visitloom.schemas import TASK_PARAM_FIELDS


def read_jdbc_tasks(
    spark: SparkSession, url: str, properties: Mapping[str, str], table: str = "task"
) -> DataFrame:
    """Tasks kept in a database; filters are pushed into its query."""
    return spark.read.jdbc(url, table, properties=dict(properties))


def task_by_id(tasks: DataFrame, task_id: int) -> DataFrame:
    """The task with this primary key."""
    return tasks.where(F.col("task_id") == task_id)


def task_params(tasks: DataFrame) -> DataFrame:
    """One text column per parameter: the first element of its JSON array, else null."""
    layout = ", ".join(f"{name} array<string>" for name in TASK_PARAM_FIELDS)
    parsed = tasks.select("task_id", F.from_json("task_param", layout).alias("p"))
    return parsed.select(
        "task_id", *(F.get(f"p.{name}", F.lit(0)).alias(name) for name in TASK_PARAM_FIELDS)
    )


def load_params(tasks: DataFrame, task_id: int) -> TaskParams:
    """Fetch one task's parameters; its single row is all that reaches the driver."""
    found = task_by_id(tasks, task_id).select("task_param").head(2)
    if len(found) != 1:
        raise LookupError(f"expected one task with id {task_id}, found {len(found)}")
    return TaskParams.from_json(found[0]["task_param"])
