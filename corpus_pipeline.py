"""A training corpus from raw documents, in five stages.

Each stage's rows are written as Parquet in the cluster's shared folder and read
again as the next stage's documents.  All but the last return the columns of
documents; the last gives the pieces of the packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm import jaccard_join, line_dedup, mixing, packing, quality
from adpulse.llm.common import stored, table
from adpulse.llm.queries import byte_tokenizer

#: The learned quality model and packing have no SQL form; tests hold every stage's rows
#: and run()'s against a brute-force version.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the quality model."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines; those that had no other lines go."""
    kept = (line_dedup.cleaned(docs).where((F.col("_n_lines") == 0) | (F.col("_n_removed") < F.col("_n_lines")))
            .select("_row.*"))
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id."""
    return jaccard_join.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack(docs, byte_tokenizer())


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
