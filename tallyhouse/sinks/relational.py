"""Relational sink with one commit: rows are staged by task, and moved into the table in one transaction.

Spark's JDBC writer commits task by task, so a retried task repeats rows or is refused, and a run that
fails halfway leaves its half. Here every task writes to a staging table under its own name. When
all have ended, the driver replaces the rows with the same keys and inserts the staged ones, of
the attempts that ended well only, in a single transaction; when any has failed, it throws the
staged rows away. Writing a day again therefore replaces it, in tables that have a key.

A connection comes from a function of the user's, named as ``module:function``: it must be
importable on the executors and return a DB-API connection whose statements take ``%s`` marks.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import batched

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from tallyhouse.sinks.jdbc import BATCH_ROWS, flatten_for_jdbc

FORMAT = "tallyhouse_relational"
TASK = "staged_by"


@dataclass(frozen=True)
class RelationalTarget:
    """Where to write: ``connect`` is called with ``settings``. ``num_partitions`` bounds the connections."""

    connect: str
    settings: dict[str, str] = field(default_factory=dict)
    num_partitions: int = 16
    batch_size: int = BATCH_ROWS


@dataclass
class StagedTask(WriterCommitMessage):
    task: str
    rows: int


class StagedWriter(DataSourceWriter):
    """Writes the rows of one frame to ``table``; see the module."""

    def __init__(self, columns: Sequence[str], options: dict[str, str]):
        self.columns, self.table, self.stage = list(columns), options["table"], options["stage"]
        self.keys = json.loads(options["keys"])
        self.connect_with, self.settings = options["connect"], json.loads(options["settings"])
        self.batch_size = int(options["batch_size"])

    def connect(self):
        module, _, function = self.connect_with.partition(":")
        return getattr(importlib.import_module(module), function)(**self.settings)

    def write(self, iterator: Iterator[Row]) -> StagedTask:
        context = TaskContext.get()
        # Attempts of one task have different names, so what a lost attempt has left is not taken.
        return self.write_as(f"{context.partitionId()}-{context.taskAttemptId()}", iterator)

    def write_as(self, task: str, rows: Iterable[Row]) -> StagedTask:
        marks = ", ".join(["%s"] * (len(self.columns) + 1))
        statement = f"INSERT INTO {self.stage} ({', '.join([*self.columns, TASK])}) VALUES ({marks})"
        connection, count = self.connect(), 0
        try:
            cursor = connection.cursor()
            for batch in batched(rows, self.batch_size):
                cursor.executemany(statement, [(*row, task) for row in batch])
                count += len(batch)
            connection.commit()
        finally:
            connection.close()
        return StagedTask(task, count)

    def _run(self, statements: Iterable[tuple[str, Sequence[str]]]) -> None:
        """All of them, or none."""
        connection = self.connect()
        try:
            cursor = connection.cursor()
            for statement, values in statements:
                cursor.execute(statement, values)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    def prepare(self) -> None:
        names = ", ".join(self.columns)
        self._run([(f"CREATE TABLE {self.stage} AS SELECT {names}, '{' ' * 64}' AS {TASK} FROM {self.table} WHERE 1 = 0", ())])

    def drop(self) -> None:
        self._run([(f"DROP TABLE {self.stage}", ())])

    def commit(self, messages: list[StagedTask | None]) -> None:
        tasks = [message.task for message in messages if message is not None and message.rows]
        if not tasks:
            return
        names, marks = ", ".join(self.columns), ", ".join(["%s"] * len(tasks))
        statements = []
        if self.keys:
            same = " AND ".join(f"s.{key} = {self.table}.{key}" for key in self.keys)
            statements.append((f"DELETE FROM {self.table} WHERE EXISTS (SELECT 1 FROM {self.stage} s WHERE {same} AND s.{TASK} IN ({marks}))", tasks))
        statements.append((f"INSERT INTO {self.table} ({names}) SELECT {names} FROM {self.stage} WHERE {TASK} IN ({marks})", tasks))
        self._run(statements)

    def abort(self, messages: list[StagedTask | None]) -> None:
        """Nothing has reached the table; the staging table goes when the write has ended."""


class RelationalSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> StagedWriter:
        if overwrite:
            raise ValueError("rows are replaced by key; use mode append")
        return StagedWriter(schema.fieldNames(), dict(self.options))


def write_relational(df: DataFrame, target: RelationalTarget, table: str, keys: Sequence[str] = ()) -> None:
    """Insert ``df`` into ``table``, replacing rows with the same ``keys``; all of it or nothing."""
    spark = df.sparkSession
    spark.dataSource.register(RelationalSource)
    frame = flatten_for_jdbc(df)
    options = {
        "table": table,
        "stage": f"{table}_{uuid.uuid4().hex[:12]}",
        "keys": json.dumps(list(keys)),
        "connect": target.connect,
        "settings": json.dumps(target.settings),
        "batch_size": str(target.batch_size),
    }
    writer = StagedWriter(frame.columns, options)
    writer.prepare()
    try:
        frame.coalesce(target.num_partitions).write.format(FORMAT).mode("append").options(**options).save()
    finally:
        writer.drop()
