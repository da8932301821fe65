"""A corpus from raw documents to packed sequences: quality, near duplicates, passages, mixture, packing.

Each stage takes the rows that the one before it wrote and returns its own; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sealframe.llm import quality_rules
from sealframe.llm.mixing import mix
from sealframe.llm.ngram_join import jaccard_classes, one_per_component
from sealframe.llm.packing import pack_documents
from sealframe.llm.passages import repeated_passages, without_passages
from sealframe.llm.shared import kept, read, with_package

END_ID = 2
# Target shares of the mixed corpus; the other sources share the rest as they stand.
WEIGHTS = {"src0": 0.2, "src1": 0.1, "src2": 0.1, "src3": 0.02}
SEED = 17


@with_package
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs calibrated on the labelled ones among them.

    Documents and measures are written side by side, so that the measures are computed once; the calibration reads
    them without the texts.
    """
    risk = quality_rules.Risk()
    # The row apart, so that no measure takes the place of one of its columns.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text", "lang", "doc_id")
    measured = kept(quality_rules.measures(rows, ["row", "lang", "doc_id"]))
    cutoffs = quality_rules.calibrate(quality_rules.labelled_rows(measured.drop("row"), read(spark, sf_dir, "labels")), risk)
    return quality_rules.verdicts(measured, cutoffs, risk).where("kept").select("row.*")


@with_package
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that links of similar documents connect."""
    return one_per_component(docs, kept(jaccard_classes(docs.select("doc_id", "text"))))


@with_package
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages that an earlier one has too; those with nothing else go."""
    return without_passages(docs, kept(repeated_passages(docs.select("doc_id", "text"))))


@with_package
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target shares of their sources, in a global random order."""
    return mix(docs, WEIGHTS, SEED, copy="__copy", place="__place").drop("__copy", "__place")


@with_package
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of up to 4096 ids."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("passages", passages), ("mixture", mixture), ("packing", packing)]

# Calibrated cutoffs, components, alignment and tokens are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir))
    return docs
