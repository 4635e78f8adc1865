"""Join helpers: size-checked broadcast, fan-out weights, day-shifted keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound (bytes) for a side that may be shipped to every executor.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def plan_size_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (an upper bound derived from the
    scanned files and the operators above them); no job is run."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_bounded(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its estimated size is under ``max_bytes``;
    otherwise leave the strategy to Catalyst/AQE, which still converts the join
    at runtime if the *measured* shuffle output turns out small.  Meant for
    dimensions and aggregates whose size does not grow with the fact table."""
    return F.broadcast(df) if plan_size_bytes(df) <= max_bytes else df


def match_weights(dim: DataFrame, dim_key: str, weight_col: str = "_w") -> DataFrame:
    """Collapse a dimension used only for its join fan-out into one row per key
    with the number of matches; a left join on it then never multiplies rows,
    and sums/counts are multiplied by the weight instead."""
    return dim.groupBy(dim_key).agg(F.count(F.lit(1)).alias(weight_col))
