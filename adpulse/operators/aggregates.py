"""Aggregation operators.

``distinct_flag_counts`` computes many ``COUNT(DISTINCT CASE WHEN cond THEN id END)``
in one pass without Catalyst's Expand (which copies every row once per distinct
aggregate): first one row per (keys, id) with max-flags and partial row sums
(map-side combined), then plain sums per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_flag_counts(df: DataFrame, keys: list[str], id_col: str,
                         distinct_conds: dict[str, Column],
                         row_sums: dict[str, Column] | None = None) -> DataFrame:
    """Exact conditional distinct counts of ``id_col`` plus plain row sums.

    distinct_conds: name -> boolean condition; result counts distinct non-null
        ids for which the condition held on at least one row.
    row_sums: name -> per-row numeric expression summed over the group (NULLs
        ignored, as SQL SUM).
    """
    row_sums = row_sums or {}
    idc = F.col(id_col)
    stage1 = [F.max(F.when(idc.isNotNull() & cond, F.lit(1)).otherwise(F.lit(0))).alias(n)
              for n, cond in distinct_conds.items()]
    stage1 += [F.sum(e).alias(n) for n, e in row_sums.items()]
    per_id = df.groupBy(*keys, id_col).agg(*stage1)
    stage2 = [F.sum(n).cast("bigint").alias(n) for n in distinct_conds]
    stage2 += [F.sum(n).alias(n) for n in row_sums]
    return per_id.groupBy(*keys).agg(*stage2)
