"""URL filtering by hash prefixes of host-suffix and path-prefix expressions.

Every URL becomes the expressions ``suffix of its host + prefix of its path``; a rule is one such
expression. Both sides are hashed; they meet in an equi-join on the first 32 bits and are confirmed
by the whole digest. Of the rules that fit, the longest decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sealframe.llm.shared import kept

# Rules up to this many, and characters of them, are broadcast.
BROADCAST_RULES, BROADCAST_CHARS = 20_000, 4_000_000
# A host and path that more than this part of all rows have is hot; there are fewer than 1 / HOT of them.
HOT = 0.001
# Copies of each rule, and parts of each URL's expressions, where there are more rules.
SALTS = 64
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules ``("block", "example.org/es/")`` as the columns verdict, rule, host, path."""
    rows = spark.createDataFrame(rules, "verdict string, rule string")
    return rows.select("verdict", "rule", F.regexp_extract("rule", r"^([^/]*)", 1).alias("host"),
                       F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1).alias("path"))


def _digest(host: Column, path: Column) -> Column:
    # A line feed cannot be in a host that a rule names, so host and path cannot run together.
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), path), 256))


def _short(digest: Column) -> Column:
    return F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long")


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with host, path, rule and verdict; columns of these names are replaced.

    A rule fits its host and all subdomains if the path starts with its own. The longest host and
    path together win, then the longer host, then ``block`` over ``allow``. A URL that no rule fits
    has a null rule and the default verdict. Rows meet their verdict in a shuffle, so ``pages`` should
    hold only the columns that are wanted; those of the few hosts and paths that very many rows have meet it in a broadcast of fewer than 1,000 rows.
    A null URL or one without ``://`` has an empty host and path and fits none. Repeated rows stay repeated. A URL is hashed for
    every path length that any rule has, up to its own.
    """
    rules = rules.select("verdict", "rule", "host", "path").distinct()
    # As many numbers as the longest path of a rule has characters at most.
    lengths = sorted(r["n"] for r in rules.select(F.length("path").alias("n")).distinct().collect())
    size = rules.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("rule")), F.lit(0)).alias("chars")).first()
    few = size["n"] <= BROADCAST_RULES and size["chars"] <= BROADCAST_CHARS

    columns = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(
        prefixes, lambda n: _digest(s, F.substring(F.col("path"), F.lit(1), n)))))
    # Each different host and path is asked once, however many rows have it.
    different = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    asked = different.select("host", "path", "n", F.explode_outer(expressions).alias("digest")).withColumn("short", _short(F.col("digest")))

    listed = rules.withColumn("rule_digest", _digest(F.col("host"), F.col("path"))).select(
        _short(F.col("rule_digest")).alias("short"), "rule_digest",
        F.struct(
            (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
            (F.col("verdict") == "block").alias("blocks"), "rule", "verdict").alias("hit"))
    if few:
        hits = asked.join(F.broadcast(listed), "short", "left")
    else:
        # A frequent host's expressions would all meet in one task, so they are dealt to SALTS.
        salted = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = asked.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")).join(salted, ["short", "salt"], "left")
    fits = F.when(F.col("digest") == F.col("rule_digest"), F.col("hit"))
    best = kept(hits.groupBy("host", "path").agg(F.max(fits).alias("hit"), F.max("n").alias("n")))
    every = best.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_hot = F.col("n") > F.lit(HOT * every)
    hot = best.where(is_hot).select(F.col("host").alias("hot_host"), F.col("path").alias("hot_path"), F.col("hit").alias("hot_hit"))
    cold = best.where(~is_hot & F.col("hit").isNotNull()).select(F.concat("host", F.lit("\n"), "path").alias("key"), "hit")
    told = rows.join(F.broadcast(hot), (F.col("host") == F.col("hot_host")) & (F.col("path") == F.col("hot_path")), "left")
    # Hot rows get a key of their own, so that they spread.
    key = F.when(F.col("hot_host").isNull(), F.concat("host", F.lit("\n"), "path")).otherwise(F.concat(F.lit("\n"), F.monotonically_increasing_id().cast("string")))
    found = told.withColumn("key", key).join(cold, "key", "left").withColumn("hit", F.coalesce("hot_hit", "hit"))
    return found.select("row.*", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
