"""Helpers the operators share: stored tables, values for tasks, Arrow batches, rolling hashes of bytes."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitloom.plans.job import Stages

Value = TypeVar("Value")

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
NULL_ID = (1 << 63) - 1


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written once to the checkpoint folder that all executors share.

    The folder is the session's ``spark.checkpoint.dir``. Only a local session may go
    without one; it gets a temporary folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_local_folder(df.sparkSession))
    return df.checkpoint()


def _local_folder(spark: SparkSession) -> str:
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="visitloom-")


class Scratch:
    """Tables that a computation stores on its way, in a folder of its own below
    ``spark.checkpoint.dir``; at the end of a ``with`` block they are deleted."""

    def __init__(self, spark: SparkSession) -> None:
        known = spark.conf.get("spark.checkpoint.dir", None)
        self._stages = Stages(spark, None if known else _local_folder(spark))
        self._stored = 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self._stored += 1
        return self._stages.store(str(self._stored), df)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.delete()

    def delete(self) -> None:
        self._stages.delete()


def by_value(spark: SparkSession, value: Value) -> Callable[[], Value]:
    """Broadcast a value with the classes it is made of; tasks call the result to get it.

    A plain broadcast names its classes only, and then every executor would need this package.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)


def with_row(df: DataFrame, text: Column) -> DataFrame:
    """All columns as one struct ``row``, beside ``text``: no name of the table's can clash."""
    return df.select(F.struct("*").alias("row"), text.alias("text"))


def small_arrow_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are long: with so few rows an Arrow batch stays within some megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def id_and_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns, a null text as the empty one."""
    return df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def small_batches(batch: pa.RecordBatch, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows of about ``limit`` bytes; a longer row is a run alone."""
    if batch.num_rows == 0:
        return
    size = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            size += np.diff(text_buffer(column)[1])
    start, total = 0, 0
    for row, n in enumerate(size.tolist()):
        if total and total + n > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += n
    yield batch.slice(start)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, and where each row starts and the last ends."""
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Rolling:
    """Hashes of any substrings of a byte array, from prefix sums modulo 2**64."""

    def __init__(self) -> None:
        rng = np.random.default_rng(20240607)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            n = max(n + 1, 1 << 16)
            for name, base in (("powers", BASE), ("inverses", INVERSE)):
                steps = np.full(n + 1, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end]; equal bytes have equal hashes wherever they stand."""
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))

    def grams(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all substrings of ``width`` bytes."""
        n = max(0, len(sums) - width)
        return mixed((sums[width : width + n] - sums[:n]) * self.inverses[:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    if len(values) < width:
        return values[:0]
    low, reach = values, 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
