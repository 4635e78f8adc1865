"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (fill_in_middle, jaccard_join, langid, line_dedup, mixing, packing, quality, sharding, spelling, substring_dedup,
               token_counts, topk, toxicity)
from .common import columns, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """Where the installed vocabulary file lies (the same place on every executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_tokenizer() -> dict[str, str]:
    import public_tokenizers

    return {"path": tokenizer("byte_bpe_50k.json"), "ranks_path": tokenizer("byte_bpe_50k.tiktoken"),
            "pattern": public_tokenizers.PATTERN}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@_query("op1_line_dedup", line_dedup.SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return line_dedup.clean(docs).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@_query("op2_substring_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_repeats(table(spark, sf_dir, "documents")))


@_query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns(table(spark, sf_dir, "documents"), "doc_id", "text")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@_query("op4_jaccard_join", jaccard_join.SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


@_query("op5_mixing", mixing.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@_query("op6_topk_search", topk.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


@_query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@_query("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@_query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), byte_tokenizer())


@_query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"))


@_query("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = columns(table(spark, sf_dir, "documents"), "doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("spans").alias("n_spans"))


@_query("op12_spelling_variants", spelling.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


@_query("op13_fill_in_middle", fill_in_middle.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(fill_in_middle.transform(table(spark, sf_dir, "documents")))
