"""

Every query runs over whole tables. Ciphertext is random, so queries that seal report what is
not (counts, lengths) or open the tokens again; their SQL is over the plaintext.
"""

from __future__ import annotations

import importlib
import math
import os
import uuid
from collections.abc import Callable, Iterator

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from sealframe.functions.keyring import KEY_ID, KeyRing
from sealframe.functions.keys import with_key
from sealframe.functions.text import cell, cell_text
from sealframe.functions.tokens import METHODS
from sealframe.layout import ORDER_LINES
from sealframe.operators.charts import QUARTILES, box_outliers, box_stats, finest_level, histogram_bins, scatter_points, scatter_pyramid
from sealframe.operators.cipher import decrypt_table, encrypt_table, open_cells, seal_cells
from sealframe.operators.integrity import tamper_report, token_size_report
from sealframe.operators.places import TAG, column_manifest, place_report, seal_in_place
from sealframe.operators.rows import count_rows, filter_category, preview, project_columns
from sealframe.operators.sketches import merge_sketches, rank_errors, sketch_measures, sketch_quantiles
from sealframe.plans.flows import Target, run_encrypted, run_plain
from sealframe.session import shared_folder, staging_folder
from sealframe.sinks.csv import read_csv_sink, sink_csv, sink_csv_encrypted
from sealframe.sinks.tables import sink_table, sink_table_encrypted
from sealframe.sources.csv import scan_csv, scan_csv_headerless
from sealframe.sources.tables import read_back
from sealframe.sources.urls import url_manifest

# One key per process; it is never stored.
KEY = os.urandom(32)
MEASURES = list(ORDER_LINES.measures)
COLUMNS = ORDER_LINES.columns
CATEGORY = "A"
DATABASE = "sealframe_checks"
RANK_ERROR = 0.005
# Rows of a scatter plot of all lines.
CELLS = 3000
# Far below what a key could seal, so that the given tables need several.
CELLS_A_KEY = 20_000
# Cells whose tokens are stored at once, some 11 GB of fernet tokens.
CELLS_A_WAVE = 150_000_000


def entry(spark: SparkSession) -> DataFrame:
    """Filter, seal, store, read back, open, chart."""
    return _job_encrypted(spark, "/root/testdata/sf0.001")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _parts(spark: SparkSession) -> int:
    """The given tables are single files, so cell work asks for the session's partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_columns(_read(spark, sf_dir, "lineitem"), COLUMNS)


def _category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_category(_lines(spark, sf_dir), ORDER_LINES.category, CATEGORY)


def _target(spark: SparkSession) -> Target:
    folder = shared_folder(spark)
    return Target(DATABASE, f"t_{uuid.uuid4().hex}", folder, "lineitem.csv", f"{folder}/{DATABASE}")


def _scan_csv(spark, sf_dir):
    path = sink_csv(_lines(spark, sf_dir), shared_folder(spark), "lineitem.csv")
    return scan_csv(spark, path, ORDER_LINES)


def _raw_csv(spark, sf_dir):
    """Lines as they come from outside, of some files with and some without a header."""
    lines, folder = _lines(spark, sf_dir), shared_folder(spark)
    is_a = F.col(ORDER_LINES.category) == CATEGORY
    lines.where(is_a).write.csv(f"{folder}/bare", header=False)
    lines.where(~is_a).write.csv(f"{folder}/headed", header=True)
    return [f"{folder}/bare", f"{folder}/headed"]


def _scan_csv_headerless(spark, sf_dir):
    return scan_csv_headerless(spark, _raw_csv(spark, sf_dir), ORDER_LINES)


def _scan_csv_codecs(spark, sf_dir):
    """The same of compressed files."""
    lines, folder = _lines(spark, sf_dir), shared_folder(spark)
    is_a = F.col(ORDER_LINES.category) == CATEGORY
    lines.where(is_a).write.csv(f"{folder}/bare", header=False, compression="gzip")
    lines.where(~is_a).write.csv(f"{folder}/headed", header=True, compression="bzip2")
    return scan_csv_headerless(spark, [f"{folder}/bare", f"{folder}/headed"], ORDER_LINES)


def _read_back(spark, sf_dir):
    target = _target(spark)
    sink_table(_lines(spark, sf_dir), target.database, target.table, location=target.location)
    return read_back(spark, target.database, target.table, COLUMNS[::-1])


def _batches(method: str) -> dict[str, bool]:
    """Cells of many rows are sealed and opened together: whole tables at a call of the cipher for each cell or row take hours."""
    return {"batches" if method == "gcm" else "long_chains": True}


def _waves(spark: SparkSession, sf_dir: str, table: str, columns: list[str]) -> Iterator[DataFrame]:
    """All rows of a table, in as many waves as its cells need. A row's place in its file decides, not what it holds."""
    rows = _read(spark, sf_dir, table)
    waves = max(1, math.ceil(rows.count() * len(columns) / CELLS_A_WAVE))
    place = F.pmod(F.xxhash64("_metadata.file_path", "_metadata.row_index"), F.lit(waves))
    for i in range(waves):
        yield project_columns(rows if waves == 1 else rows.where(place == i), columns)


def _over_waves(spark: SparkSession, waves: Iterator[DataFrame], report: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """A report by column of each wave, which may store tokens in the folder that it gets; they are removed before the next wave. Then all reports in one."""
    path = f"{shared_folder(spark)}/reports"
    for lines in waves:
        with staging_folder(spark) as folder:
            report(lines, folder).write.mode("append").parquet(path)
    reports = spark.read.parquet(path)
    added = {"shortest": F.min, "longest": F.max}
    return reports.groupBy("column").agg(*[added.get(c, F.sum)(c).alias(c) for c in reports.columns if c != "column"])


def _encrypt(method: str):
    """What can be said about random tokens: how many, how long, of which shape, and how many of the
    cells open as what they were."""
    def report(lines, folder):
        spark = lines.sparkSession
        texts = {f"p{i}": cell_text(f.name, f.dataType) for i, f in enumerate(lines.schema)}
        plain = with_key(lines.repartition(_parts(spark)).select(*[t.alias(p) for p, t in texts.items()]), KEY)
        # Both are stored, as a token that is looked at twice would be sealed twice.
        path = f"{folder}/tokens"
        seal_cells(plain, {f"t{i}": cell(p) for i, p in enumerate(texts)}, method, list(texts), **_batches(method)).write.parquet(path, compression="zstd")
        tokens = with_key(spark.read.parquet(path), KEY)
        cells = open_cells(tokens, [f"t{i}" for i in range(len(COLUMNS))], method, list(texts), **_batches(method))
        opened = cells.select(*[(cell(f"t{i}") == cell(f"p{i}")).alias(c) for i, c in enumerate(COLUMNS)])
        same = opened.agg(*[F.count_if(cell(c)).alias(c) for c in COLUMNS]).unpivot([], COLUMNS, "column", "opened")
        sizes = token_size_report(tokens.select(*[cell(f"t{i}").alias(c) for i, c in enumerate(COLUMNS)]))
        return sizes.join(same, "column")
    return lambda spark, sf_dir: _over_waves(spark, _waves(spark, sf_dir, "lineitem", COLUMNS), report)


def _decrypt(method: str):
    def query(spark, sf_dir):
        tokens = encrypt_table(_lines(spark, sf_dir), KEY, method, partitions=_parts(spark), **_batches(method))
        return decrypt_table(tokens, KEY, method, MEASURES, **_batches(method))
    return query


def _encrypt_table(spark, sf_dir):
    return token_size_report(encrypt_table(_read(spark, sf_dir, "documents"), KEY, partitions=_parts(spark), batches=True))


def _decrypt_table(spark, sf_dir):
    tokens = encrypt_table(_read(spark, sf_dir, "orders"), KEY, partitions=_parts(spark), batches=True)
    return decrypt_table(tokens, KEY, "gcm", {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "no_such_column": "double"}, batches=True)


def _slices(spark, sf_dir):
    """A key of its own for every order status; the status stays readable."""
    keys = {status: os.urandom(32) for status in ("F", "O", "P")}
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    tokens = encrypt_table(orders, keys, partitions=_parts(spark), slice_column="o_orderstatus", batches=True)
    return decrypt_table(tokens, keys, "gcm", {"o_orderkey": "bigint", "o_totalprice": "double"}, slice_column="o_orderstatus", batches=True)


def _key_ring(spark, sf_dir):
    """Lines by their flag, each flag with as many stored keys as its cells need: cells and keys of each, and how many open."""
    lines, ring = _lines(spark, sf_dir), KeyRing(spark, shared_folder(spark), KEY, CELLS_A_KEY)
    path = sink_csv_encrypted(lines, shared_folder(spark), "lineitem.csv", ring, partitions=_parts(spark), slice_column="l_returnflag", batches=True)
    tokens = read_csv_sink(spark, path, ", ".join(f"{c} string" for c in [*COLUMNS, KEY_ID]))
    per_key = decrypt_table(tokens, ring, "gcm", MEASURES, batches=True).agg(F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity"))
    used = ring.usage(tokens).join(ring.keys().select(KEY_ID, "slice"), KEY_ID)
    slices = used.groupBy(F.substring("slice", 2, 1).alias("l_returnflag")).agg(F.sum("cells").alias("cells"), (F.max("cells") <= CELLS_A_KEY).alias("kept"), (F.count("*") > 1).alias("several"))
    return slices.crossJoin(per_key)


def _tamper(method: str):
    """Store tokens, change one character in the tax of returned and the discount of open lines."""
    def report(lines, folder):
        spark, path = lines.sparkSession, f"{folder}/tokens"
        marked = lines.repartition(_parts(spark)).select("*", F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))
        seal_cells(with_key(marked, KEY), {f.name: cell_text(f.name, f.dataType) for f in lines.schema}, method, ["flag", "status"], **_batches(method)) \
            .write.parquet(path, compression="zstd")
        changed = {"l_tax": F.col("flag") == "R", "l_discount": F.col("status") == "O"}
        stored = spark.read.parquet(path)
        return tamper_report(stored.select(*[
            F.when(changed[f.name], _flip(cell(f.name))).otherwise(cell(f.name)).alias(f.name)
            if f.name in changed else cell(f.name) for f in lines.schema
        ]), KEY, method, **_batches(method))
    return lambda spark, sf_dir: _over_waves(spark, _waves(spark, sf_dir, "lineitem", [*COLUMNS, "l_linestatus"]), report)


def _place_report(spark, sf_dir):
    """Stored orders in disorder: of every ten, the first has the price of the next one, the second its priority for its status,
    the third is gone, the fourth there twice, and the fifth has lost its date."""
    path, clear = f"{shared_folder(spark)}/sealed", ("o_orderkey",)
    seal_in_place(_read(spark, sf_dir, "orders"), KEY, ["o_orderkey"], "orders", partitions=_parts(spark), clear=clear).write.parquet(path, compression="zstd")
    stored = spark.read.parquet(path)
    manifest = column_manifest(stored, KEY, clear=clear)
    turn, price = F.col("o_orderkey") % 10, F.col("o_totalprice")
    following = stored.where(turn == 2).select((F.col("o_orderkey") - 1).alias("o_orderkey"), price.alias("other_price"))
    moved = stored.join(following, "o_orderkey", "left").where(turn != 3).select(
        "o_orderkey", "o_custkey", F.when(turn == 2, F.col("o_orderpriority")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.coalesce("other_price", price).alias("o_totalprice"), F.when(turn != 5, F.col("o_orderdate")).alias("o_orderdate"), "o_orderpriority", TAG)
    return place_report(moved.unionByName(moved.where(turn == 4)), manifest, KEY, clear=clear)


def _flip(token):
    return F.overlay(token, F.when(F.substring(token, 20, 1) == "A", "B").otherwise("A"), 20)


def _token_sizes(spark, sf_dir):
    """All three methods side by side, one scan."""
    lines = _lines(spark, sf_dir)
    texts = {f.name: cell_text(f.name, f.dataType) for f in lines.schema}
    rows, made = lines.repartition(_parts(spark)), []
    for method in METHODS:
        rows = seal_cells(with_key(rows, KEY), {f"{c}_{method}": t for c, t in texts.items()}, method, [*lines.columns, *made], **_batches(method))
        made += [f"{c}_{method}" for c in texts]
    tokens = rows.select(*made)
    return token_size_report(tokens)


def _sink_csv(spark, sf_dir):
    path = sink_csv(_category(spark, sf_dir), shared_folder(spark), "lineitem.csv")
    return read_csv_sink(spark, path, ORDER_LINES.schema)


def _sink_csv_encrypted(spark, sf_dir):
    path = sink_csv_encrypted(_category(spark, sf_dir), shared_folder(spark), "lineitem.csv", KEY, partitions=_parts(spark), batches=True)
    tokens = read_csv_sink(spark, path, ", ".join(f"{c} string" for c in COLUMNS))
    return decrypt_table(tokens, KEY, "gcm", MEASURES, batches=True)


def _texts(spark, sf_dir):
    """Orders with empty and with missing texts."""
    priority = F.when(F.col("o_orderpriority") == "5-LOW", "").when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority"))
    odd = F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit("\\N"), F.col("o_orderstatus"))).when(F.col("o_custkey") % 3 == 1, F.lit("\\N"))
    return _read(spark, sf_dir, "orders").select("o_orderkey", priority.alias("priority"), odd.alias("odd"))


def _csv_texts(spark, sf_dir):
    texts = _texts(spark, sf_dir)
    return read_csv_sink(spark, sink_csv(texts, shared_folder(spark), "orders.csv"), texts.schema)


def _csv_one_column(spark, sf_dir):
    """Tables of one column keep their rows without a text, plain and sealed."""
    texts, folder = _texts(spark, sf_dir).select("priority"), shared_folder(spark)
    plain = read_csv_sink(spark, sink_csv(texts, folder, "plain.csv"), texts.schema)
    tokens = read_csv_sink(spark, sink_csv_encrypted(texts, folder, "sealed.csv", KEY, partitions=_parts(spark), batches=True), texts.schema)
    return plain.unionByName(decrypt_table(tokens, KEY, batches=True)).groupBy("priority").agg(F.count("*").alias("n"))


def _sink_table(spark, sf_dir):
    target = _target(spark)
    sink_table(_category(spark, sf_dir), target.database, target.table, location=target.location)
    return read_back(spark, target.database, target.table, COLUMNS)


def _sink_table_replaced(spark, sf_dir):
    """A table of all lines is replaced by those of a category; the next write breaks off and changes nothing."""
    target, lines = _target(spark), _category(spark, sf_dir)
    sink_table(_lines(spark, sf_dir), target.database, target.table, location=target.location)
    sink_table(lines, target.database, target.table, location=target.location)
    broken = F.when(F.col("l_tax") == lines.agg(F.max("l_tax")).scalar(), F.raise_error(F.lit("broken off")).cast("double")).otherwise(F.col("l_tax"))
    try:
        sink_table(lines.withColumn("l_tax", broken), target.database, target.table, location=target.location)
    except PySparkException as error:
        if "broken off" not in str(error):
            raise
    return read_back(spark, target.database, target.table, COLUMNS)


def _box_sketch(spark, sf_dir):
    """Sketches of each line status are stored and merged; the ranks of what they say are then counted."""
    lines, path = _read(spark, sf_dir, "lineitem"), f"{shared_folder(spark)}/sketches"
    sketch_measures(lines, MEASURES, RANK_ERROR, by=["l_linestatus"]).write.parquet(path)
    quantiles = sketch_quantiles(merge_sketches(spark.read.parquet(path)), QUARTILES)
    return rank_errors(lines, quantiles, QUARTILES).select("measure", "probability", "n", (F.col("error") <= RANK_ERROR).alias("within"))


def _sink_table_encrypted(spark, sf_dir):
    target = _target(spark)
    sink_table_encrypted(_category(spark, sf_dir), target.database, target.table, KEY, location=target.location, partitions=_parts(spark), batches=True)
    return decrypt_table(read_back(spark, target.database, target.table, COLUMNS), KEY, "gcm", MEASURES, batches=True)


def _charts_of(spark, run, sf_dir):
    """From raw files to charts. The charts outlive the job's rows, table and files."""
    path = f"{shared_folder(spark)}/charts"
    with staging_folder(spark) as folder:
        target = Target(DATABASE, f"t_{uuid.uuid4().hex}", folder, "lineitem.csv", f"{folder}/{DATABASE}")
        with run(scan_csv_headerless(spark, _raw_csv(spark, sf_dir), ORDER_LINES), target) as stored:
            stored.charts().write.parquet(path)
        spark.sql(f"DROP TABLE {stored.table}")
        spark.sql(f"DROP DATABASE IF EXISTS {DATABASE} CASCADE")
    return spark.read.parquet(path)


def _job_plain(spark, sf_dir):
    return _charts_of(spark, lambda rows, target: run_plain(rows, ORDER_LINES, CATEGORY, target), sf_dir)


def _job_encrypted(spark, sf_dir):
    return _charts_of(spark, lambda rows, target: run_encrypted(rows, ORDER_LINES, CATEGORY, target, KEY, partitions=_parts(spark), batches=True), sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "scan_csv": _scan_csv,
        "scan_csv_headerless": _scan_csv_headerless,
        "scan_csv_codecs": _scan_csv_codecs,
        "read_back": _read_back,
        "url_manifest": lambda spark, d: url_manifest(_read(spark, d, "pages")),
        "filter_category": _category,
        "project_columns": lambda spark, d: project_columns(_read(spark, d, "lineitem"), ["l_tax", "l_returnflag"]),
        "count_category": lambda spark, d: count_rows(_category(spark, d)),
        "preview": lambda spark, d: preview(_category(spark, d), 2, COLUMNS),
        "encrypt_gcm": _encrypt("gcm"),
        "decrypt_gcm": _decrypt("gcm"),
        "encrypt_cbc": _encrypt("cbc"),
        "decrypt_cbc": _decrypt("cbc"),
        "encrypt_fernet": _encrypt("fernet"),
        "decrypt_fernet": _decrypt("fernet"),
        "encrypt_table": _encrypt_table,
        "decrypt_table": _decrypt_table,
        "key_per_slice": _slices,
        "key_ring": _key_ring,
        "tamper_report": _tamper("gcm"),
        "tamper_report_fernet": _tamper("fernet"),
        "place_report": _place_report,
        "token_size_report": _token_sizes,
        "sink_csv": _sink_csv,
        "sink_csv_encrypted": _sink_csv_encrypted,
        "sink_csv_texts": _csv_texts,
        "sink_csv_one_column": _csv_one_column,
        "sink_table": _sink_table,
        "sink_table_replaced": _sink_table_replaced,
        "sink_table_encrypted": _sink_table_encrypted,
        "scatter_points": lambda spark, d: scatter_points(_category(spark, d), "l_quantity", "l_discount"),
        "scatter_pyramid": lambda spark, d: scatter_pyramid(_lines(spark, d), "l_quantity", "l_extendedprice", CELLS),
        "histogram_bins": lambda spark, d: histogram_bins(_category(spark, d), "l_tax"),
        "box_stats": lambda spark, d: box_stats(_category(spark, d), MEASURES),
        "box_sketch": _box_sketch,
        "box_outliers": lambda spark, d: box_outliers(_read(spark, d, "events"), ["value"]),
        "job_plain": _job_plain,
        "job_encrypted": _job_encrypted,
    }
    return found | (_corpus().queries() if _corpus() else {})


def _corpus():
    """The queries of the corpus package, where that package is there."""
    try:
        return importlib.import_module("sealframe.llm.queries")
    except ModuleNotFoundError as missing:
        if missing.name in ("sealframe.llm", "sealframe.llm.queries", "corpus_pipeline"):
            return None
        raise


# Oracles

_ALL = "SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag FROM lineitem"
_A = f"{_ALL} WHERE l_returnflag = 'A'"

_TOKEN_CHARS = {
    "gcm": "4 * ceil((28 + n) / 3.0)",
    "cbc": "4 * ceil((16 + 16 * (n // 16 + 1)) / 3.0)",
    "fernet": "4 * ceil((57 + 16 * (n // 16 + 1)) / 3.0)",
}


def _sizes(table: str, columns: list[str], method: str, suffix: str = "") -> str:
    """Token lengths from the lengths of the texts."""
    texts = " UNION ALL ".join(
        f"SELECT '{c}{suffix}' AS name, strlen(CAST({c} AS VARCHAR)) AS n FROM {table}" for c in columns
    )
    return f"""
        SELECT name AS "column", count(n) AS cells,
               CAST(min({_TOKEN_CHARS[method]}) AS BIGINT) AS shortest,
               CAST(max({_TOKEN_CHARS[method]}) AS BIGINT) AS longest,
               CAST(sum({_TOKEN_CHARS[method]}) AS BIGINT) AS characters,
               count(n) AS well_formed
        FROM ({texts}) GROUP BY name"""


def _tampered() -> str:
    changed = {"l_tax": "l_returnflag = 'R'", "l_discount": "l_linestatus = 'O'"}
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS cells, "
        f"count(CASE WHEN {changed.get(c, 'FALSE')} THEN 1 END) AS bad_cells FROM lineitem"
        for c in [*COLUMNS, "l_linestatus"]
    )


def _disorder(column: str, bad: str) -> str:
    """What each kind of disorder does to the cells of a column that has no nulls; ``bad`` moves cells."""
    lost = "o_orderkey % 10 = 5" if column == "o_orderdate" else "FALSE"
    return f"""
        SELECT '{column}' AS "column", FALSE AS intact, count(*) - count_if(o_orderkey % 10 = 3 OR {lost}) + count_if(o_orderkey % 10 = 4) AS cells,
               count_if({bad}) AS bad_cells, count_if(o_orderkey % 10 = 4) AS repeated, count_if(o_orderkey % 10 = 3 OR {lost} OR {bad}) AS missing
        FROM orders"""


_DISORDER = " UNION ALL ".join(_disorder(c, {
    "o_totalprice": "o_orderkey % 10 = 1 AND o_orderkey + 1 IN (SELECT o_orderkey FROM orders)", "o_orderstatus": "o_orderkey % 10 = 2",
}.get(c, "FALSE")) for c in ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))


def _pyramid(table: str, x: str, y: str) -> str:
    """Each point's cell of every level from the edges of the finest one, whose parts are merged; whole levels that fit."""
    parts = 1 << finest_level(CELLS)

    def part(v: str) -> str:
        # The edges decide, not the rounded quotient.
        edge = lambda i: f"CASE WHEN {i} = {parts} THEN {v}_hi ELSE ({i}) * {v}_w + {v}_lo END"
        guess = f"least(CAST(floor(({v} - {v}_lo) / {v}_w) AS BIGINT), {parts - 1})"
        return f"""{guess} - CASE WHEN {v} < {edge(guess)} THEN 1 ELSE 0 END
                   + CASE WHEN {v} >= {edge(f'{guess} + 1')} AND {guess} < {parts - 1} THEN 1 ELSE 0 END"""

    return f"""
        WITH v AS (SELECT {x} AS x, {y} AS y FROM {table} WHERE {x} IS NOT NULL AND NOT isnan({x}) AND {y} IS NOT NULL AND NOT isnan({y})),
        s AS (SELECT min(x) AS x_lo, max(x) AS x_hi, (max(x) - min(x)) / {parts} AS x_w, min(y) AS y_lo, max(y) AS y_hi, (max(y) - min(y)) / {parts} AS y_w FROM v),
        c AS (SELECT {part('x')} AS cx, {part('y')} AS cy FROM v, s),
        every AS (SELECT CAST(level AS INTEGER) AS level, cx // d AS cell_x, cy // d AS cell_y, d, count(*) AS n
                  FROM c, (SELECT level, CAST(pow(2, {finest_level(CELLS)} - level) AS BIGINT) AS d FROM range({finest_level(CELLS) + 1}) AS r(level)) GROUP BY ALL),
        fit AS (SELECT level FROM (SELECT level, sum(count(*)) OVER (ORDER BY level) AS upto FROM every GROUP BY level) WHERE upto <= {CELLS})
        SELECT level, cell_x, cell_y, (cell_x * d) * x_w + x_lo AS x, (cell_y * d) * y_w + y_lo AS y, n FROM every JOIN fit USING (level), s"""


def _histogram(source: str, column: str) -> str:
    return f"""
        WITH v AS (SELECT {column} AS v FROM ({source}) WHERE {column} IS NOT NULL AND NOT isnan({column})),
        s AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 10 AS w FROM v),
        b AS (SELECT CAST(i AS BIGINT) AS bin, i * w + lo AS left_edge,
                     CASE WHEN i = 9 THEN hi ELSE (i + 1) * w + lo END AS right_edge, i = 9 AS final
              FROM s, range(10) AS r(i))
        SELECT bin, left_edge, right_edge, count(v) AS n
        FROM b LEFT JOIN v ON v >= left_edge AND (v < right_edge OR (final AND v = right_edge))
        GROUP BY bin, left_edge, right_edge"""


def _quartiles(source: str, measures: list[str]) -> str:
    """Quartiles from the sorted rows, then the fences."""
    rows = " UNION ALL ".join(
        f"SELECT '{m}' AS measure, {m} AS v FROM ({source}) WHERE {m} IS NOT NULL AND NOT isnan({m})" for m in measures
    )

    def quartile(p: float) -> str:
        at = f"({p} * (n - 1))"
        low, high = (f"max(CASE WHEN i = {side}({at}) THEN v END)" for side in ("floor", "ceil"))
        share = f"({at} - floor({at}))"
        return (f"CASE WHEN {share} >= 0.5 THEN {high} - ({high} - {low}) * (1 - {share}) "
                f"ELSE {low} + ({high} - {low}) * {share} END")

    return f"""
        values_ AS ({rows}),
        ranked AS (SELECT measure, v, row_number() OVER (PARTITION BY measure ORDER BY v) - 1 AS i,
                          CAST(count(*) OVER (PARTITION BY measure) AS DOUBLE) AS n FROM values_),
        box AS (SELECT measure, CAST(n AS BIGINT) AS n, {quartile(0.25)} AS q1, {quartile(0.5)} AS median,
                       {quartile(0.75)} AS q3 FROM ranked GROUP BY measure, n),
        fenced AS (SELECT *, q1 - (q3 - q1) * 1.5 AS low, q3 + (q3 - q1) * 1.5 AS high FROM box)"""


_BOX = """
        SELECT measure, f.n, q1, median, q3, least(min(CASE WHEN v >= low THEN v END), q1) AS whisker_low,
               greatest(max(CASE WHEN v <= high THEN v END), q3) AS whisker_high,
               count(CASE WHEN v < low OR v > high THEN 1 END) AS outliers
        FROM fenced f JOIN values_ USING (measure) GROUP BY measure, f.n, q1, median, q3"""
_BEYOND = """
        SELECT measure, v AS value, count(*) AS n
        FROM fenced f JOIN values_ USING (measure) WHERE v < low OR v > high GROUP BY measure, v"""


# Every quartile is within its error.
_RANKS_KEPT = " UNION ALL ".join(
    f"SELECT '{m}' AS measure, CAST({p} AS DOUBLE) AS probability, count({m}) AS n, TRUE AS within FROM lineitem" for m in MEASURES for p in QUARTILES
)


def _charts() -> str:
    stats = " UNION ALL ".join(
        f"SELECT 'box', measure, '{s}', NULL, {s}, n FROM boxes" for s in ("q1", "median", "q3", "whisker_low", "whisker_high")
    )
    return f"""
        WITH {_quartiles(_A, MEASURES)}, boxes AS ({_BOX}), beyond AS ({_BEYOND})
        SELECT 'scatter' AS chart, 'l_quantity|l_discount' AS series, 'point' AS item,
               l_quantity AS x, l_discount AS y, count(*) AS n
        FROM ({_A}) GROUP BY l_quantity, l_discount
        UNION ALL SELECT 'histogram', 'l_tax', 'bin', left_edge, right_edge, n FROM ({_histogram(_A, "l_tax")})
        UNION ALL {stats}
        UNION ALL SELECT 'box', measure, 'outlier', NULL, value, n FROM beyond"""


_URL_MANIFEST = r"""
    WITH named AS (
        SELECT url, regexp_replace(regexp_extract(regexp_replace(regexp_extract(
                   regexp_replace(regexp_replace(url, '^[\x00-\x20]+', ''), '[\t\r\n]', '', 'g'),
                   '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ';[^/]*$', ''), '[^/]*$', 0),
                   '[^A-Za-z0-9._-]', '_', 'g') AS file_name,
               starts_with(lower(url), 'https://') AS is_https
        FROM pages)
    SELECT url, is_https, file_name,
           CASE WHEN NOT is_https THEN 'not_https' WHEN file_name = '' THEN 'no_file_name' END AS error
    FROM named"""


_TEXTS = """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN '' WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS priority,
           CASE WHEN o_custkey % 3 = 0 THEN '\\N' || o_orderstatus WHEN o_custkey % 3 = 1 THEN '\\N' END AS odd FROM orders"""


def oracle_sql() -> dict[str, str]:
    # Every cell opens as what it was.
    sizes = {m: f"SELECT *, cells AS opened FROM ({_sizes('lineitem', COLUMNS, m)})" for m in METHODS}
    charts = _charts()
    found = {
        "scan_csv": _ALL,
        "scan_csv_headerless": _ALL,
        "scan_csv_codecs": _ALL,
        "read_back": _ALL,
        "url_manifest": _URL_MANIFEST,
        "filter_category": _A,
        "project_columns": "SELECT l_tax, l_returnflag FROM lineitem",
        "count_category": f"SELECT count(*) AS rows FROM ({_A})",
        "preview": f"{_A} ORDER BY {', '.join(COLUMNS)} LIMIT 2",
        "encrypt_gcm": sizes["gcm"],
        "decrypt_gcm": _ALL,
        "encrypt_cbc": sizes["cbc"],
        "decrypt_cbc": _ALL,
        "encrypt_fernet": sizes["fernet"],
        "decrypt_fernet": _ALL,
        "encrypt_table": _sizes("documents", ["doc_id", "text", "lang", "source", "n_chars"], "gcm"),
        "decrypt_table": """
            SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""",
        "key_per_slice": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
        "key_ring": f"""
            SELECT l_returnflag, CAST(5 * count(*) AS BIGINT) AS cells, TRUE AS kept, 5 * count(*) > {CELLS_A_KEY} AS several,
                   (SELECT count(*) FROM lineitem) AS rows, (SELECT sum(l_quantity) FROM lineitem) AS quantity FROM lineitem GROUP BY l_returnflag""",
        "tamper_report": _tampered(),
        "tamper_report_fernet": _tampered(),
        "place_report": _DISORDER,
        "token_size_report": " UNION ALL ".join(_sizes("lineitem", COLUMNS, m, f"_{m}") for m in METHODS),
        "sink_csv": _A,
        "sink_csv_encrypted": _A,
        "sink_csv_texts": _TEXTS,
        "sink_csv_one_column": f"SELECT priority, 2 * count(*) AS n FROM ({_TEXTS}) GROUP BY priority",
        "sink_table": _A,
        "sink_table_replaced": _A,
        "sink_table_encrypted": _A,
        "scatter_points": f"SELECT l_quantity, l_discount, count(*) AS n FROM ({_A}) GROUP BY 1, 2",
        "scatter_pyramid": _pyramid("lineitem", "l_quantity", "l_extendedprice"),
        "histogram_bins": _histogram(_A, "l_tax"),
        "box_stats": f"WITH {_quartiles(_A, MEASURES)} {_BOX}",
        "box_sketch": _RANKS_KEPT,
        "box_outliers": f"WITH {_quartiles('SELECT * FROM events', ['value'])} {_BEYOND}",
        "job_plain": charts,
        "job_encrypted": charts,
    }
    return found | (_corpus().oracle_sql() if _corpus() else {})
