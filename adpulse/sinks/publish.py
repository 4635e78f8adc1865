"""Staged publish of report tables to a serving table.

The reference deletes the scope's rows in the serving database and inserts the new ones row
by row; a reader in between sees half.  Here the table after both steps is written as a new
version (``versions``), and readers go on with the version before until it is complete: its
completion is the one switch.  What is deleted follows the table's family: the whole scope,
or only those rows of it whose code is, or is not, in a list of codes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from . import versions
from .tables import scoped_replace, serving_projection


@dataclass(frozen=True)
class Family:
    """Serving tables whose names begin alike, and which rows of the scope a publish deletes:
    ``code_col`` None: all; ``among``: those with a code in the list, else those without."""
    prefixes: tuple[str, ...]
    code_col: str | None = None
    among: bool = False


def family_of(table: str, families: list[Family]) -> Family:
    """The first family with a prefix of ``table``; without one a publish deletes the whole scope."""
    return next((f for f in families if table.startswith(f.prefixes)), Family(()))


def read_published(spark: SparkSession, root: str) -> DataFrame | None:
    """The serving table as last published, or None before the first publish."""
    made = versions.complete(spark, root)
    return spark.read.parquet(made[-1][1]) if made else None


def publish(report: DataFrame, root: str, table: str, scope: Column | str, families: list[Family] = (), codes: DataFrame | None = None,
            keep: int = 2) -> DataFrame:
    """Publish a report's rows: the serving projection of ``report``, in place of the scope's
    rows of the serving table under ``root``.  Returns the table as readers now find it.
    A publish that died leaves no trace for readers, and its number is taken again."""
    spark = report.sparkSession
    made = versions.complete(spark, root)
    new = serving_projection(report, table)
    if made:
        family = family_of(table, list(families))
        rows = scoped_replace(spark.read.parquet(made[-1][1]), new, scope, codes if family.code_col else None,
                              family.code_col or "mediacd", "in" if family.among else "not_in")
    else:
        rows = new
    path = versions.write(rows, root, made[-1][0] + 1 if made else 0)
    versions.drop_old(spark, root, keep)
    return spark.read.parquet(path)
