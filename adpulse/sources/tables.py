"""Readers for the driver's base tables and for the reference's raw formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; projections and filters applied later reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_partitioned_parquet(spark: SparkSession, path: str, **partition_eq) -> DataFrame:
    """Hive-partitioned Parquet table; equality filters on partition
    columns become PartitionFilters (pruned directories)."""
    df = spark.read.option("basePath", path).parquet(path)
    for k, v in partition_eq.items():
        df = df.where(df[k] == v)
    return df


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON-lines logs with an explicit (possibly nested) schema.

    An explicit schema avoids an inference pass over the whole input.
    """
    return spark.read.schema(schema).json(path)


def read_csv_dimension(spark: SparkSession, path: str, schema: T.StructType | None = None,
                       sep: str = ",") -> DataFrame:
    """CSV (quoted) or TSV dimension dumps with a header row."""
    r = spark.read.option("header", True).option("quote", '"').option("sep", sep)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)
