"""Tables of SQLite files as a Spark data source, read by ranges of rowids and written by parts.

``spark.dataSource.register(SqliteSource)``, then
``spark.read.format("sqlite").option("path", file).option("table", name).load()``, and
``df.write.format("sqlite").option("path", file).option("table", name).mode("append").save()``.
The file must lie where executors can open it.

A writing task fills a small file of its own beside the target; if all tasks have committed, the driver adds these
to the table in one transaction, with the columns that it lacks, so that a job that fails leaves the table as it was.
The target is one file, as that of any embedded database: for tables of the size that such files have.
"""

from __future__ import annotations

import contextlib
import datetime
import decimal
import os
import shutil
import sqlite3
import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

_KINDS = (("INT", "bigint"), ("CHAR", "string"), ("TEXT", "string"), ("CLOB", "string"), ("BLOB", "binary"), ("REAL", "double"), ("FLOA", "double"), ("DOUB", "double"))


def _name(text: str) -> str:
    return '"' + text.replace('"', '""') + '"'


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path.removeprefix('file://')}?mode=ro", uri=True)


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        with _open(self.options["path"]) as db:
            rows = db.execute(f"PRAGMA table_info({_name(self.options['table'])})").fetchall()
        if not rows:
            raise ValueError(f"no table {self.options['table']}")
        kind = lambda t: next((k for part, k in _KINDS if part in (t or "").upper()), "string")
        return ", ".join(f"`{r[1]}` {kind(r[2])}" for r in rows)

    def reader(self, schema) -> DataSourceReader:
        return SqliteReader(self.options, schema)


    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return SqliteWriter(self.options, schema, overwrite)


class SqliteReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path, self.table = options["path"], options["table"]
        self.parts, self.columns = int(options.get("numPartitions", "8")), [f.name for f in schema.fields]

    def partitions(self):
        with _open(self.path) as db:
            low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {_name(self.table)}").fetchone()
        if low is None:
            return [InputPartition((0, 0))]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [InputPartition((at, at + step)) for at in range(low, high + 1, step)]

    def read(self, partition):
        low, high = partition.value
        with _open(self.path) as db:
            cols = ", ".join(map(_name, self.columns))
            yield from db.execute(f"SELECT {cols} FROM {_name(self.table)} WHERE rowid >= ? AND rowid < ?", (low, high))


@dataclass
class Part(WriterCommitMessage):
    """The file of a task that has committed; none if it had no rows."""

    path: str | None


#: What Spark's types are in a table; other types are kept as text.
_SQL_KINDS = {"tinyint": "INTEGER", "smallint": "INTEGER", "int": "INTEGER", "bigint": "INTEGER", "boolean": "INTEGER", "float": "REAL", "double": "REAL", "binary": "BLOB"}


def _plain(x):
    """A value as SQLite holds it."""
    if isinstance(x, (datetime.datetime, datetime.date)):
        return x.isoformat(sep=" ") if isinstance(x, datetime.datetime) else x.isoformat()
    if isinstance(x, bytearray):
        return bytes(x)
    return x if x is None or isinstance(x, (bool, int, float, str, bytes)) else str(x) if isinstance(x, decimal.Decimal) else repr(x)


class SqliteWriter(DataSourceWriter):
    def __init__(self, options, schema, overwrite: bool):
        self.path, self.table, self.overwrite = options["path"].removeprefix("file://"), options["table"], overwrite
        self.columns = [(f.name, _SQL_KINDS.get(f.dataType.simpleString(), "TEXT")) for f in schema.fields]
        self.parts = f"{self.path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator) -> Part:
        rows = ([_plain(x) for x in row] for row in iterator)
        first = next(rows, None)
        if first is None:
            return Part(None)
        os.makedirs(self.parts, exist_ok=True)
        path = f"{self.parts}/{uuid.uuid4().hex}.db"  # another attempt of the task has another file
        with contextlib.closing(sqlite3.connect(path)) as db:
            db.execute(f"CREATE TABLE part ({', '.join(f'{_name(n)} {k}' for n, k in self.columns)})")
            into = f"INSERT INTO part VALUES ({', '.join('?' * len(self.columns))})"
            db.execute(into, first)
            db.executemany(into, rows)
            db.commit()
        return Part(path)

    def commit(self, messages) -> None:
        table, names = _name(self.table), ", ".join(_name(n) for n, _ in self.columns)
        try:
            with contextlib.closing(sqlite3.connect(self.path, isolation_level=None)) as db:
                db.execute("BEGIN IMMEDIATE")
                try:
                    db.execute(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(f'{_name(n)} {k}' for n, k in self.columns)})")
                    there = {r[1] for r in db.execute(f"PRAGMA table_info({table})")}
                    for n, k in self.columns:
                        if n not in there:
                            db.execute(f"ALTER TABLE {table} ADD COLUMN {_name(n)} {k}")
                    if self.overwrite:
                        db.execute(f"DELETE FROM {table}")
                    for m in messages:
                        if m is not None and m.path:
                            self._add(db, m.path, f"INSERT INTO {table} ({names}) VALUES ({', '.join('?' * len(self.columns))})")
                    db.execute("COMMIT")
                except BaseException:
                    db.execute("ROLLBACK")
                    raise
        finally:
            self._clear()

    def _add(self, db: sqlite3.Connection, path: str, into: str) -> None:
        """Row by row: databases cannot be attached within a transaction."""
        with _open(path) as part:
            db.executemany(into, part.execute("SELECT * FROM part ORDER BY rowid"))

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        shutil.rmtree(self.parts, ignore_errors=True)
