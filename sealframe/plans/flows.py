"""The two batch jobs: filter, store, read back, chart; plain or with sealed cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, functions as F

from sealframe.functions.keyring import KEY_ID
from sealframe.functions.keys import Keys, is_ring
from sealframe.functions.text import cell
from sealframe.functions.tokens import check_batches_method
from sealframe.layout import Layout
from sealframe.operators.charts import chart_table
from sealframe.operators.cipher import decrypt_table
from sealframe.operators.ranks import present
from sealframe.operators.rows import filter_category, preview, project_columns
from sealframe.session import dealt
from sealframe.sinks.csv import sink_csv
from sealframe.sinks.tables import PLAIN_TEXT_WIDTH, TOKEN_WIDTH, sink_table, sink_table_encrypted
from sealframe.sources.tables import read_back


@dataclass(frozen=True)
class Target:
    """Where a job stores its rows. ``location`` is the folder of a database still to be made."""

    database: str
    table: str
    csv_folder: str
    source_name: str
    location: str | None = None


@dataclass(frozen=True)
class Stored:
    """What a job left behind: ``at_rest`` as stored, ``rows`` readable, ``measured`` the measures.

    As a context it keeps the readable measures while several charts are made, so that each
    cell is opened once. Executors spill them to their own disks: set
    ``spark.io.encryption.enabled``. ``count`` and ``ranges`` (least and most of each measure) were
    taken while the rows were written, by the tasks that wrote them.
    """

    table: str
    csv_path: str
    count: int
    at_rest: DataFrame
    rows: DataFrame
    measured: DataFrame
    layout: Layout
    ranges: dict[str, tuple[float | None, float | None]]

    def charts(self) -> DataFrame:
        """The layout's scatter and histogram, a box for each measure."""
        x, y, histogram = self.layout.chart_columns
        return chart_table(self.measured, x, y, histogram, self.measured.columns, span=self.ranges.get(histogram))

    def previews(self, n: int = 2) -> tuple[DataFrame, DataFrame]:
        """Some rows as stored, and some as they read."""
        return preview(self.at_rest, n), preview(self.rows, n)

    def __enter__(self) -> Stored:
        self.measured.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def __exit__(self, *_) -> None:
        self.measured.unpersist()


def _watched(rows: DataFrame, layout: Layout) -> tuple[DataFrame, Observation]:
    """Rows that are counted and measured on their way. Nothing may shuffle them afterwards, or a task that is run again
    would count again."""
    seen = Observation()
    values = {m: F.when(present(v), v) for m in layout.measures for v in [cell(m).cast("double")]}
    ends = [f(v).alias(f"{name}{i}") for i, v in enumerate(values.values()) for name, f in (("least", F.min), ("most", F.max))]
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *ends), seen


def _stored(table: str, csv_path: str, at_rest: DataFrame, rows: DataFrame, layout: Layout, seen: Observation) -> Stored:
    found = seen.get
    ranges = {m: (found[f"least{i}"], found[f"most{i}"]) for i, m in enumerate(layout.measures)}
    return Stored(table, csv_path, found["rows"], at_rest, rows, project_columns(rows, list(layout.measures)), layout, ranges)


def run_plain(source: DataFrame, layout: Layout, category: str, target: Target, *, text_width: int | None = PLAIN_TEXT_WIDTH) -> Stored:
    """The source is scanned once, into the table; all else reads the far smaller table."""
    wanted, seen = _watched(project_columns(filter_category(source, layout.category, category), layout.columns), layout)
    table = sink_table(wanted, target.database, target.table, text_width=text_width, location=target.location)
    stored = read_back(source.sparkSession, target.database, target.table, layout.columns)
    path = sink_csv(stored, target.csv_folder, target.source_name)
    return _stored(table, path, stored, stored, layout, seen)


def run_encrypted(source: DataFrame, layout: Layout, category: str, target: Target, key: Keys, method: str = "gcm", *,
                  token_width: int | None = TOKEN_WIDTH, partitions: int | None = None, slice_column: str | None = None,
                  batches: bool = False) -> Stored:
    """The same with sealed cells. Each cell is sealed once: the CSV holds the table's tokens. With a ``slice_column``, which is one of the
    layout's and stays clear, ``key`` has a key for each of its values; or ``key`` is a ring. ``batches`` as in ``encrypt_table``."""
    check_batches_method(method, batches)
    wanted = dealt(project_columns(filter_category(source, layout.category, category), layout.columns), partitions)
    wanted, seen = _watched(wanted, layout)
    table = sink_table_encrypted(wanted, target.database, target.table, key, method, token_width=token_width, location=target.location, slice_column=slice_column, batches=batches)
    stored = read_back(source.sparkSession, target.database, target.table, [*layout.columns, *([KEY_ID] if is_ring(key) else [])])
    path = sink_csv(stored, target.csv_folder, target.source_name)
    rows = decrypt_table(stored, key, method, layout.measures, slice_column=slice_column, batches=batches)
    return _stored(table, path, stored, rows, layout, seen)
