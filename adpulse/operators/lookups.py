"""Lookup operators: scalar subqueries turned into small keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def previous_month_rate(rates: DataFrame, regd: str = "regd", rate: str = "exchangerate") -> DataFrame:
    """O3 for every month at once: the latest rate registered in the *previous*
    calendar month, keyed by the month it applies to (``rate_ym`` = yyyymm).

    One row per month with rates, so it stays tiny at any fact-table size.
    """
    d = F.to_date(F.col(regd).cast("string"), "yyyyMMdd")
    latest = (rates.where(d.isNotNull())
              .select(F.date_trunc("month", d).cast("date").alias("_m"),
                      F.struct(F.col(regd).cast("bigint").alias("r"),
                               F.col(rate).cast("double").alias("v")).alias("_s"))
              .groupBy("_m").agg(F.max("_s").alias("_s")))
    nxt = F.add_months("_m", 1)
    return latest.select((F.year(nxt) * 100 + F.month(nxt)).alias("rate_ym"),
                         F.col("_s.v").alias("EXCHANGEWON"))


def text_max(df: DataFrame, keys: list[str], value: str, out: str, numeric: bool = False) -> DataFrame:
    """Largest value per key.  On text this is lexicographic ('9.5' > '10.2'),
    like sorting an array of strings and taking the last; ``numeric`` compares
    as double instead."""
    v = F.col(value).cast("double") if numeric else F.col(value)
    return df.groupBy(*keys).agg(F.max(v).alias(out))
