"""Table sinks: the Spark catalog, or a database over JDBC."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sealframe.functions.keys import Keys
from sealframe.functions.text import cell, cell_text
from sealframe.functions.tokens import token_length
from sealframe.operators.cipher import encrypt_table
from sealframe.session import staging_folder

# Widths of the text columns of stored tables.
PLAIN_TEXT_WIDTH = 50
TOKEN_WIDTH = 255


def check_name(name: str) -> str:
    """Letters, digits and underscores of ASCII, which is what Spark's catalog takes; refused before
    anything is created."""
    if not (name.isascii() and name.isidentifier()):
        raise ValueError(f"{name!r} is no plain name of a database or table")
    return name


def quoted(database: str, table: str) -> str:
    return f"`{check_name(database)}`.`{check_name(table)}`"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database if it is missing; ``location`` must be reachable by every executor."""
    place = "" if location is None else f" LOCATION {_text(location)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{check_name(database)}`{place}")


def sink_table(df: DataFrame, database: str, table: str, *, text_width: int | None = PLAIN_TEXT_WIDTH,
               location: str | None = None) -> str:
    """Store rows as a catalog table and let it take the place of what had the name; text columns are VARCHAR(``text_width``).

    Spark checks the width while it writes and fails on a longer cell, so no pass over the data is
    needed first. ``None`` stores text of any length.

    The rows go to a folder of their own below the database's location first. Only when all of them
    are there, the table is pointed to it, in one step of the catalog if its columns are the same; a table with
    other columns is renamed away and back if the step fails. So a write that fails, or a driver that dies, leaves the old rows
    as they were. Queries that already read the old rows go on: their files stay until the table is
    replaced once more. ``sweep_versions`` removes what dead drivers left.
    """
    spark = df.sparkSession
    name = quoted(database, table)
    ensure_database(spark, database, location)
    fields = [
        T.StructField(f.name, T.VarcharType(text_width) if text_width and isinstance(f.dataType, T.StringType) else f.dataType)
        for f in df.schema
    ]
    mark = uuid.uuid4().hex
    staged, place = f"{table}__{mark}", f"{_versions(spark, database, table)}/{VERSION}{mark}"
    # Tokens are Base64: only an entropy coder shortens them.
    spark.catalog.createTable(quoted(database, staged), path=place, source="parquet", schema=T.StructType(fields), compression="zstd")
    try:
        df.write.insertInto(quoted(database, staged), overwrite=True)
        _switch(spark, database, table, staged, place)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(database, staged)}")
        _remove(spark, place)
        raise
    return name


# How folders of stored versions begin, and the property that holds the place of the version before.
VERSION, BEFORE = "version_", "sealframe.version.before"


def _versions(spark: SparkSession, database: str, table: str) -> str:
    # No table can have this name, so no managed table has this folder.
    return f"{spark.catalog.getDatabase(f'`{database}`').locationUri.rstrip('/')}/{table}.versions"


def _files(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _remove(spark: SparkSession, place: str) -> None:
    system, path = _files(spark, place)
    system.delete(path, True)


def _described(spark: SparkSession, name: str) -> tuple[list[tuple[str, str]], str | None, str | None]:
    """Columns and types of a table, where it is, and where its version before is."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    ends = next((i for i, r in enumerate(rows) if r.col_name == "" or r.col_name.startswith("# ")), len(rows))
    place = next((r.data_type for r in rows[ends:] if r.col_name == "Location"), None)
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return [(r.col_name, r.data_type) for r in rows[:ends]], place, found.get(BEFORE)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _switch(spark: SparkSession, database: str, table: str, staged: str, place: str) -> None:
    """Let ``table`` be what ``staged`` is."""
    name, new = quoted(database, table), quoted(database, staged)
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
        return
    columns, old, older = _described(spark, name)
    ours = old is not None and f"/{table}.versions/{VERSION}" in old
    if ours and columns == _described(spark, new)[0]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(place)}")
        spark.catalog.refreshTable(name)
        spark.sql(f"DROP TABLE {new}")
    else:
        aside = quoted(database, f"{staged}_old")
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
        try:
            spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
        except BaseException:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
            raise
        spark.sql(f"DROP TABLE {aside}")
    if ours:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_text(BEFORE)} = {_text(old)})")
    if ours and older and older != old:
        _remove(spark, older)


def sweep_versions(spark: SparkSession, database: str, table: str) -> list[str]:
    """Remove the folders of versions that are neither the table's nor the one before, and name them. For times when nobody
    writes the table: a folder that is being filled is no version yet."""
    name = quoted(database, table)
    kept = [p.rsplit("/", 1)[-1] for p in _described(spark, name)[1:] if p] if spark.catalog.tableExists(name) else []
    system, root = _files(spark, _versions(spark, database, table))
    found = [f.getPath() for f in system.listStatus(root)] if system.exists(root) else []
    gone = [p for p in found if p.getName().startswith(VERSION) and p.getName() not in kept]
    for path in gone:
        system.delete(path, True)
    return [p.toString() for p in gone]


def sink_table_encrypted(df: DataFrame, database: str, table: str, key: Keys, method: str = "gcm", *,
                         token_width: int | None = TOKEN_WIDTH, location: str | None = None, partitions: int | None = None,
                         slice_column: str | None = None, batches: bool = False) -> str:
    """The same with every cell a token and every column VARCHAR(``token_width``). The cells of a ``slice_column`` stay clear, and
    ``key`` has a key for each of its values. ``batches`` as in ``encrypt_table``."""
    tokens = encrypt_table(df, key, method, partitions=partitions, slice_column=slice_column, batches=batches)
    return sink_table(tokens, database, table, text_width=token_width, location=location)


def sink_jdbc(df: DataFrame, url: str, table: str, *, text_width: int = PLAIN_TEXT_WIDTH,
              connections: int = 8, properties: dict[str, str] | None = None) -> None:
    """Drop, create and fill a database table over at most ``connections`` connections.

    Where the database itself may be missing, ask for it in the URL
    (``createDatabaseIfNotExist=true`` in MySQL's).

    The rows are staged in the shared folder first: the query keeps all its tasks, is run once, and
    a task that loads again loads the same rows. Each task commits its own rows, so one that is run
    again after its commit was lost from sight would store them twice: the database counts afterwards.
    """
    check_name(table)
    with staging_folder(df.sparkSession) as staged:
        df.write.parquet(staged, compression="zstd")
        _load(df.sparkSession.read.schema(df.schema).parquet(staged), url, table, text_width, connections, properties or {})


def _load(rows: DataFrame, url: str, table: str, text_width: int, connections: int, properties: dict[str, str]) -> None:
    rows.write.mode("overwrite").options(**jdbc_options(rows.schema, text_width, connections)).jdbc(url, table, properties=properties)
    stored = rows.sparkSession.read.jdbc(url, count_query(table), properties=properties).first()[0]
    expected = rows.count()
    if stored != expected:
        raise RuntimeError(f"{table}: {stored} rows stored, {expected} expected; write it again")


def count_query(table: str) -> str:
    """A derived table that the database itself makes of one row."""
    return f"(SELECT count(*) AS n FROM {check_name(table)}) counted"


def sink_jdbc_encrypted(df: DataFrame, url: str, table: str, key: Keys, method: str = "gcm", *,
                        token_width: int = TOKEN_WIDTH, connections: int = 8,
                        properties: dict[str, str] | None = None, partitions: int | None = None, slice_column: str | None = None) -> None:
    """The same with every cell a token, but for a ``slice_column``. Databases may cut long values silently, so the token
    lengths are derived from the plaintext first, before anything is sealed or dropped."""
    longest = df.select(*[
        F.max(F.char_length(cell(f.name).cast("string")) if f.name == slice_column else token_length(F.octet_length(cell_text(f.name, f.dataType)), method)).alias(f.name)
        for f in df.schema
    ]).first()
    wide = {name: n for name, n in longest.asDict().items() if n is not None and n > token_width}
    if wide:
        raise ValueError(f"tokens longer than {token_width} characters: {wide}")
    tokens = encrypt_table(df, key, method, partitions=partitions, slice_column=slice_column)
    sink_jdbc(tokens, url, table, text_width=token_width, connections=connections, properties=properties)


def jdbc_options(schema: T.StructType, text_width: int, connections: int) -> dict[str, str]:
    types = {
        T.StringType: f"VARCHAR({text_width})",
        T.DoubleType: "DOUBLE",
    }
    columns = ", ".join(f"{f.name} {types[type(f.dataType)]}" for f in schema if type(f.dataType) in types)
    return {"createTableColumnTypes": columns, "numPartitions": str(connections), "batchsize": "10000"}
