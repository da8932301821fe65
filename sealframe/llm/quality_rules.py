"""Quality rules whose cutoffs are calibrated on labelled rows to a bounded rate of false rejection.

Every rule rejects a document when its measure lies above a cutoff. The cutoff of a rule is chosen
per stratum (language) from a fixed ladder: the strictest one for which an exact binomial test says
that good documents are rejected at most at the allowed rate. All tests of all rules and strata
share one error probability (Bonferroni), and the rules share the allowed rate, so the bound holds
for all rules together. Only built-in expressions run over the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sealframe.llm.shared import SPACES

SYMBOLS = r"[#*$%&|<>]"
OTHER = "other"


@dataclass(frozen=True)
class Risk:
    """``share``: good documents that all rules together may reject. ``doubt``: chance that this fails.

    ``strata``: the languages with cutoffs of their own; all others, null too, are one stratum.
    ``ladder``: cutoffs in thousandths from lenient to strict; a rule without a passing one is off.
    """

    share: float = 0.02
    doubt: float = 0.05
    strata: tuple[str, ...] = ("de", "en", "es", "fr")
    ladder: tuple[int, ...] = (950, 900, 800, 700, 600, 500, 400, 300, 250, 200, 150, 100, 75, 50, 40, 30, 20, 10)


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measures(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words and _n_lines as numbers.

    A null text has none of anything. Columns of these names in ``docs`` are replaced. Repeated
    words are found within the row, by sorting its three-word windows, so nothing is shuffled and a
    very long text costs its length times the logarithm.
    """
    names = [*MEASURES, "_n_lines"]
    # The row apart, so that what is computed on the way cannot take the place of its columns.
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep) if c not in names])
    docs = docs.select(row.alias("_row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    content = F.col("_text")
    split = docs.withColumn("_words", F.filter(F.split(content, f"{SPACES}+"), lambda w: w != ""))
    n = F.size("_words")
    lines = F.filter(F.split(content, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # A window is its three words joined by a space, which no word holds, and its place.
    windows = F.when(n >= 3, F.transform(
        F.slice("_words", 1, F.greatest(n - 2, F.lit(0))),
        lambda w, i: F.struct(F.concat_ws(" ", w, F.get("_words", i + 1), F.get("_words", i + 2)).alias("w"), i.alias("i")),
    )).otherwise(F.array().cast("array<struct<w:string,i:int>>"))
    split = split.withColumn("_lines", lines).withColumn("_windows", F.sort_array(windows))
    size = F.size("_windows")

    def twice(x: Column, k: Column) -> Column:
        before, after = F.get("_windows", k - 1), F.get("_windows", k + 1)
        return ((k > 0) & (before["w"] == x["w"])) | ((k < size - 1) & (after["w"] == x["w"]))

    found = F.sort_array(F.transform(F.filter("_windows", twice), lambda x: x["i"]))
    split = split.withColumn("_found", found)
    # Windows cover three words each; of two that overlap, the second adds its distance to the first.
    covered = F.aggregate(
        "_found", F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("words")),
        lambda acc, i: F.struct(i.alias("last"), (acc["words"] + F.least(i - acc["last"], F.lit(3))).alias("words")),
        lambda acc: acc["words"])
    out = split.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.length(content) - F.length(F.regexp_replace(content, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": covered,
        "_n_lines": F.size("_lines"),
    })
    # The measures pass through a generator: a condition on one of them would else be moved below
    # them all, and each would be computed again for every element of the next.
    return out.select("_row", F.explode(F.array(F.struct(*names))).alias("_measured")).select("_row.*", "_measured.*")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


RULES = ("symbols", "repeats", "lines")


def rules() -> dict[str, Column]:
    """The measures that have cutoffs, in thousandths from 0; larger is worse."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbols": 1000 * F.col("n_symbols") / chars,
        "repeats": 1000 * F.col("n_repeat_words") / words,
        "lines": 1000 * F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)),
    }


def stratum(risk: Risk, lang: str = "lang") -> Column:
    return F.when(F.col(f"`{lang}`").isin(*risk.strata), F.col(f"`{lang}`")).otherwise(OTHER)


def calibrate(labelled: DataFrame, risk: Risk = Risk(), good: str = "good", lang: str = "lang") -> dict[tuple[str, str], int]:
    """The cutoff of each (stratum, rule) with one, from measured rows with a boolean ``good``.

    Bad and null labels take no part, nor what fails the base rules: the guarantee is about good
    documents that come as far as the cutoffs. A stratum without
    enough good rows passes no test and gets no cutoff. What comes to the driver is at most one row
    per stratum and rule.
    """
    names = list(rules())
    ladder = F.array(*[F.lit(c) for c in risk.ladder])
    tests = (len(risk.strata) + 1) * len(names) * len(risk.ladder)
    allowed, doubt = risk.share / len(names), risk.doubt / tests
    # Rejected rows per cutoff, summed map-side: strata x rules x cutoffs rows at most.
    counts = labelled.where(F.col(good) & ~base_failed()).select(
        stratum(risk, lang).alias("stratum"),
        F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("v")) for k, v in rules().items()])).alias("r"),
    ).groupBy("stratum", "r.rule").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum((F.col("r.v") > c).cast("long")).alias(f"k{c}") for c in risk.ladder])
    ladders = counts.select("stratum", "rule", "n", F.posexplode(F.array(*[F.col(f"k{c}") for c in risk.ladder])).alias("at", "k"))
    passed = ladders.select("stratum", "rule", F.get(ladder, F.col("at")).alias("cutoff"),
                            binomial_tail(F.col("k"), F.col("n"), allowed, doubt).alias("ok")).where("ok")
    best = passed.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))
    return {(r["stratum"], r["rule"]): r["cutoff"] for r in best.collect()}


def binomial_tail(k: Column, n: Column, rate: float, doubt: float) -> Column:
    """Whether P(at most k of n at ``rate``) <= doubt, which says with that doubt that the true rate is below.

    The terms are summed from the largest on down, in logarithms first, so that no n underflows.
    """
    odds = rate / (1 - rate)
    # ln of the term at k: ln C(n, k) + k ln rate + (n - k) ln(1 - rate).
    choose = F.aggregate(F.sequence(F.lit(1), F.greatest(k, F.lit(1)).cast("int")), F.lit(0.0),
                         lambda acc, i: acc + F.when(i <= k, F.log((n - k + i) / i)).otherwise(0.0))
    top = choose + k * F.log(F.lit(rate)) + (n - k) * F.log(F.lit(1 - rate))
    # Term j - 1 over term j is j / ((n - j + 1) odds); below the mean the terms fall from k on.
    down = F.aggregate(
        F.sequence(F.lit(0), F.greatest(k - 1, F.lit(0)).cast("int")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda acc, i: F.struct(
            (acc["term"] * F.when(i < k, (k - i) / ((n - k + i + 1) * odds)).otherwise(0.0)).alias("term"),
            (acc["sum"] + acc["term"] * F.when(i < k, (k - i) / ((n - k + i + 1) * odds)).otherwise(0.0)).alias("sum")),
        lambda acc: acc["sum"])
    return (k < n * rate) & (top + F.log(down) <= F.log(F.lit(doubt)))


def verdicts(measured: DataFrame, cutoffs: dict[tuple[str, str], int], risk: Risk = Risk(), lang: str = "lang") -> DataFrame:
    """``base_failed`` and ``kept``: false if the base rules fail or a measure is above its cutoff."""
    which, rejected = stratum(risk, lang), F.lit(False)
    for (place, rule), cutoff in sorted(cutoffs.items()):
        rejected = rejected | ((which == place) & (rules()[rule] > cutoff))
    return measured.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected)


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``good``: whether all labels of its doc_id say quality 1. Others are left out.

    Contradicting labels of a document count as not good. Null ids match nothing.
    """
    good = labels.where("quality is not null").groupBy(F.col("doc_id").alias("__labelled")).agg((F.min("quality") == 1).alias("good"))
    return docs.drop("good").join(good, F.col("doc_id") == F.col("__labelled")).drop("__labelled")
