"""Writers of the result tables. One call writes one whole result of one task."""

from __future__ import annotations

import json
import secrets
from collections.abc import Mapping
from contextlib import closing
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession

from visitloom.schemas import RESULT_TABLES


class Sink(Protocol):
    """Where a job's results go: ``write`` once per table, then ``publish`` once."""

    def write(self, table: str, result: DataFrame, taskid: int) -> None:
        """Store ``result``, which has the layout of ``RESULT_TABLES[table]``."""

    def publish(self, spark: SparkSession, taskid: int) -> None:
        """All results of the task are written. Sinks without a switch have shown them already."""


class _AtOnce:
    """Results show as soon as each is written."""

    def publish(self, spark: SparkSession, taskid: int) -> None:
        pass


@dataclass(frozen=True)
class FileSink(_AtOnce):
    """One directory per table and task. Running a task again replaces its rows only,
    also when the new result is empty."""

    root: str
    fmt: str = "parquet"

    def write(self, table: str, result: DataFrame, taskid: int) -> None:
        target = f"{self.root}/{table}/taskid={taskid}"
        result.drop("taskid").write.mode("overwrite").format(self.fmt).save(target)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        schema = RESULT_TABLES[table]
        stored = spark.read.schema(schema).format(self.fmt).load(f"{self.root}/{table}")
        return stored.select(*schema.fieldNames())


@dataclass(frozen=True)
class TableSink(_AtOnce):
    """Catalog tables partitioned by task; a task's partition is replaced as a whole."""

    database: str = "default"
    fmt: str = "parquet"

    def write(self, table: str, result: DataFrame, taskid: int) -> None:
        spark, name = result.sparkSession, f"{self.database}.{table}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RESULT_TABLES[table])
        spark.sql(
            f"create table if not exists {name} ({columns}) using {self.fmt} partitioned by (taskid)"
        )
        values = result.drop("taskid")
        spark.sql(
            f"insert overwrite table {name} partition (taskid = {int(taskid)}) select * from {{rows}}",
            rows=values,
        )


@dataclass(frozen=True)
class JdbcSink(_AtOnce):
    """Existing database tables, appended in batches; each partition is one transaction.

    A task whose rows are there already is refused, as appending would repeat them: delete them
    before running it again, also after a failure between the transactions.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    batch_size: int = 1000
    connections: int = 8

    def write(self, table: str, result: DataFrame, taskid: int) -> None:
        written = f"(select taskid from {table} where taskid = {int(taskid)}) as written"
        if result.sparkSession.read.jdbc(self.url, written, properties=dict(self.properties)).head(1):
            raise ValueError(f"{table} has rows of task {taskid}")
        options = {**self.properties, "batchsize": str(self.batch_size)}
        # Dealt out anew: the option numPartitions would run what makes the rows in as few tasks.
        rows = result.repartition(self.connections)
        rows.write.jdbc(self.url, table, mode="append", properties=options)


class SnapshotSink:
    """Results in a folder of their own for each run; one switch shows them all.

    ``root/runs/<run>/<table>`` holds a run's rows, ``root/current/taskid=<n>`` names the run whose
    results are the task's. That small file is written aside and renamed over the old one, in one step
    on file systems whose rename is one (HDFS, local). So a reader finds all results of the old run
    or all of the new one, whenever the job stops. A task's earlier runs stay until ``prune``: who
    has opened them can read on.

    One object is one run: use a new one for the next.
    """

    def __init__(self, root: str, fmt: str = "parquet", run: str | None = None) -> None:
        self.root, self.fmt = root.rstrip("/"), fmt
        self.run = run or secrets.token_hex(8)
        self.tables: list[str] = []

    def write(self, table: str, result: DataFrame, taskid: int) -> None:
        result.write.format(self.fmt).save(self._folder(self.run, table))
        self.tables.append(table)

    def publish(self, spark: SparkSession, taskid: int) -> None:
        told = json.dumps({"run": self.run, "tables": sorted(self.tables)})
        files, pointer = _Files(spark, self.root), self._pointer(taskid)
        files.write(f"{pointer}.{self.run}", told)
        files.replace(f"{pointer}.{self.run}", pointer)

    def read(self, spark: SparkSession, table: str, taskid: int) -> DataFrame:
        """The task's published rows of a table; none before its first run."""
        return self.snapshot(spark, taskid)[table]

    def snapshot(self, spark: SparkSession, taskid: int) -> dict[str, DataFrame]:
        """All results of the task, of one and the same run."""
        shown = self._shown(spark, taskid)
        if shown is None:
            return {table: spark.createDataFrame([], schema) for table, schema in RESULT_TABLES.items()}
        reader = spark.read.format(self.fmt)
        return {t: reader.schema(RESULT_TABLES[t]).load(self._folder(shown["run"], t)) for t in shown["tables"]}

    def prune(self, spark: SparkSession) -> list[str]:
        """Delete the runs that no task shows, except this object's own; their names."""
        files = _Files(spark, self.root)
        shown = {json.loads(files.read(p))["run"] for p in files.children("current") if "." not in p.rpartition("/")[2]}
        gone = [p for p in files.children("runs") if p.rpartition("/")[2] not in shown | {self.run}]
        for path in gone:
            files.delete(path)
        return sorted(p.rpartition("/")[2] for p in gone)

    def _folder(self, run: str, table: str) -> str:
        return f"{self.root}/runs/{run}/{table}"

    def _pointer(self, taskid: int) -> str:
        return f"{self.root}/current/taskid={int(taskid)}"

    def _shown(self, spark: SparkSession, taskid: int) -> dict[str, Any] | None:
        told = _Files(spark, self.root).read(self._pointer(taskid))
        return None if told is None else json.loads(told)


class _Files:
    """Small files beside the results, on the file system that Spark writes them to."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf, self._root = spark._jsc.hadoopConfiguration(), root

    def _path(self, path: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str) -> Any:
        return self._path(path).getFileSystem(self._conf)

    def write(self, path: str, text: str) -> None:
        out = self._system(path).create(self._path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str | None:
        """The file's text, of any time: a file that is renamed over it leaves an opened one whole."""
        system = self._system(path)
        if not system.exists(self._path(path)):
            return None
        stream = system.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def replace(self, source: str, target: str) -> None:
        """Rename over what is there, in one step."""
        qualified = self._system(target).makeQualified(self._path(target))
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        context.rename(self._system(source).makeQualified(self._path(source)), qualified, how)

    def children(self, folder: str) -> list[str]:
        path = self._path(f"{self._root}/{folder}")
        system = path.getFileSystem(self._conf)
        return [s.getPath().toString() for s in system.listStatus(path)] if system.exists(path) else []

    def delete(self, path: str) -> None:
        self._system(path).delete(self._path(path), True)


@dataclass(frozen=True)
class TransactionSink:
    """Existing database tables; all rows of a task change in one transaction.

    ``write`` puts a result into a staging table of its own, ``<table>_stage_<taskid>``, over any that
    an earlier run left. ``publish`` then replaces the task's rows in every table: a delete and an
    ``insert … select`` for each, all in one transaction, inside the database. Whenever the job stops,
    the tables hold the task's old rows or all its new ones; running it again replaces them.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    batch_size: int = 1000
    connections: int = 8
    _staged: dict[int, list[str]] = field(default_factory=dict, repr=False, compare=False)

    def write(self, table: str, result: DataFrame, taskid: int) -> None:
        options = {**self.properties, "batchsize": str(self.batch_size)}
        # Dealt out anew: the option numPartitions would run what makes the rows in as few tasks.
        rows = result.repartition(self.connections)
        rows.write.jdbc(self.url, self._stage(table, taskid), mode="overwrite", properties=options)
        self._staged.setdefault(taskid, []).append(table)

    def publish(self, spark: SparkSession, taskid: int) -> None:
        tables = self._staged.pop(taskid, [])
        with closing(self._connect(spark)) as connection:
            connection.setAutoCommit(False)
            try:
                for table in tables:
                    for statement in self.statements(table, taskid):
                        _execute(connection, statement)
                connection.commit()
            except Exception:
                connection.rollback()
                raise
            # Staging tables that stay behind do no harm; the next run writes over them.
            for table in tables:
                _execute(connection, f"drop table {self._stage(table, taskid)}")
            connection.commit()

    def statements(self, table: str, taskid: int) -> list[str]:
        """What replaces the task's rows of a table."""
        names = ", ".join(RESULT_TABLES[table].fieldNames())
        return [
            f"delete from {table} where taskid = {int(taskid)}",
            f"insert into {table} ({names}) select {names} from {self._stage(table, taskid)}",
        ]

    @staticmethod
    def _stage(table: str, taskid: int) -> str:
        return f"{table}_stage_{int(taskid)}"

    def _connect(self, spark: SparkSession) -> Any:
        """A connection of the driver's own, with the driver class that the properties name."""
        jvm = spark._jvm
        if "driver" in self.properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        settings = jvm.java.util.Properties()
        for name, value in self.properties.items():
            settings.setProperty(name, value)
        return jvm.java.sql.DriverManager.getConnection(self.url, settings)


def _execute(connection: Any, statement: str) -> None:
    with closing(connection.createStatement()) as prepared:
        prepared.executeUpdate(statement)
