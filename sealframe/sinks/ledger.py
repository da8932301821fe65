"""Load a database table so that it is there as a whole or not at all, over many connections.

Spark's own writer commits each task by itself: a load that breaks off leaves a part, and a task that is run again after its commit
was lost from sight stores its rows twice. Here every task fills a side table and enters its part in a ledger, both in one transaction, so a
part is there once, however often a task is tried. When the ledger has all parts, one step gives the side table the name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from sealframe.session import staging_folder
from sealframe.sinks.tables import PLAIN_TEXT_WIDTH, check_name

# Rows that are sent at once.
ROWS = 10_000
TYPES = {T.DoubleType: "DOUBLE PRECISION", T.FloatType: "REAL", T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.ShortType: "SMALLINT"}


@dataclass(frozen=True)
class Statements:
    """What is said to the database. ``mark`` is the placeholder of its driver; ``renames`` whether it can rename several tables in one step, as
    MySQL can, whose other table statements end a transaction."""

    table: str
    columns: tuple[tuple[str, str], ...]
    load: str
    mark: str = "%s"
    renames: bool = True

    @classmethod
    def of(cls, schema: T.StructType, table: str, text_width: int = PLAIN_TEXT_WIDTH, **more) -> Statements:
        kinds = []
        for f in schema:
            if isinstance(f.dataType, T.StringType):
                kinds.append((check_name(f.name), f"VARCHAR({text_width})"))
            elif type(f.dataType) in TYPES:
                kinds.append((check_name(f.name), TYPES[type(f.dataType)]))
            else:
                raise TypeError(f"column {f.name} has a type that is not stored: {f.dataType.simpleString()}")
        return cls(check_name(table), tuple(kinds), uuid.uuid4().hex[:12], **more)

    @property
    def side(self) -> str:
        return f"{self.table}__{self.load}"

    @property
    def ledger(self) -> str:
        return f"{self.side}_parts"

    @property
    def before(self) -> str:
        return f"{self.side}_before"

    def begin(self) -> list[str]:
        columns = ", ".join(f"{name} {kind}" for name, kind in self.columns)
        return [f"CREATE TABLE {self.side} ({columns})", f"CREATE TABLE {self.ledger} (part INTEGER PRIMARY KEY, stored BIGINT NOT NULL)"]

    def insert(self) -> str:
        return f"INSERT INTO {self.side} ({', '.join(n for n, _ in self.columns)}) VALUES ({', '.join([self.mark] * len(self.columns))})"

    def enter(self) -> str:
        return f"INSERT INTO {self.ledger} (part, stored) VALUES ({self.mark}, {self.mark})"

    def entered(self) -> str:
        return f"SELECT stored FROM {self.ledger} WHERE part = {self.mark}"

    def totals(self) -> str:
        return f"SELECT COUNT(*), COALESCE(SUM(stored), 0), (SELECT COUNT(*) FROM {self.side}) FROM {self.ledger}"

    def switch(self, replaces: bool) -> list[str]:
        """One step or one transaction, after which the old table goes."""
        if self.renames and replaces:
            return [f"RENAME TABLE {self.table} TO {self.before}, {self.side} TO {self.table}"]
        old = [f"ALTER TABLE {self.table} RENAME TO {self.before}"] if replaces else []
        return [*old, f"ALTER TABLE {self.side} RENAME TO {self.table}"]

    def end(self) -> list[str]:
        return [f"DROP TABLE IF EXISTS {t}" for t in (self.ledger, self.side, self.before)]


def load_part(connection: Any, say: Statements, part: int, rows: Iterable[list[tuple]]) -> int:
    """Store the rows of a part and enter it in the ledger, in one transaction; the number of rows stored. Does nothing where the
    ledger has the part, and leaves it to another attempt that was quicker."""
    cursor = connection.cursor()
    cursor.execute(say.entered(), (part,))
    if (found := cursor.fetchone()) is not None:
        connection.rollback()
        return found[0]
    stored = 0
    try:
        for some in rows:
            if some:
                cursor.executemany(say.insert(), some)
                stored += len(some)
        # The key of the ledger lets one attempt through.
        cursor.execute(say.enter(), (part, stored))
        connection.commit()
        return stored
    except BaseException:
        connection.rollback()
        cursor.execute(say.entered(), (part,))
        found = cursor.fetchone()
        connection.rollback()
        if found is None:
            raise
        return found[0]


def switch(connection: Any, say: Statements, parts: int, rows: int) -> None:
    """Give the side table the name, if all parts and rows are there."""
    cursor = connection.cursor()
    cursor.execute(say.totals())
    found = tuple(map(int, cursor.fetchone()))
    if found != (parts, rows, rows):
        raise RuntimeError(f"{say.table}: parts, rows entered and rows stored are {found}, not {(parts, rows, rows)}")
    try:
        cursor.execute(f"SELECT COUNT(*) FROM {say.table} WHERE 1 = 0")
        cursor.fetchall()
        replaces = True
    except Exception:  # each driver has errors of its own
        connection.rollback()
        replaces = False
    for statement in say.switch(replaces):
        cursor.execute(statement)
    connection.commit()


def sink_dbapi(df: DataFrame, connect: Callable[[], Any], table: str, *, text_width: int = PLAIN_TEXT_WIDTH, connections: int = 8,
               mark: str = "%s", renames: bool = True) -> None:
    """Replace a database table by the rows of ``df``, in one step after all of them are stored.

    ``connect`` opens a connection of a Python database driver (DB-API 2.0), on the driver and in every task, with transactions on. The rows are
    staged in the shared folder first: the query runs once, and a task that is tried again loads the same rows. A load that
    breaks off leaves the table as it was and drops its side table; one whose driver dies leaves a side table, whose name has two underscores.
    """
    with staging_folder(df.sparkSession) as staged:
        df.write.parquet(staged, compression="zstd")
        rows = df.sparkSession.read.schema(df.schema).parquet(staged)
        say = Statements.of(rows.schema, table, text_width, mark=mark, renames=renames)

        def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            connection = connect()
            try:
                part = TaskContext.get().partitionId()
                some = (list(zip(*(c.to_pylist() for c in b.slice(i, ROWS).columns))) for b in batches for i in range(0, b.num_rows, ROWS))
                stored = load_part(connection, say, part, some)
            finally:
                connection.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([stored], pa.int64())], names=["part", "stored"])

        first = connect()
        try:
            _say(first, say.begin())
            try:
                done = rows.coalesce(connections).mapInArrow(load, "part int, stored bigint").collect()  # a row for each part
                switch(first, say, len(done), rows.count())
            finally:
                _say(first, say.end())
        finally:
            first.close()


def _say(connection: Any, statements: list[str]) -> None:
    cursor = connection.cursor()
    for statement in statements:
        cursor.execute(statement)
    connection.commit()
