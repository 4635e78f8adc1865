"""Presentation order of small reports (O1, O2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_listed_order(df: DataFrame, column: str, listed: Sequence[str]) -> DataFrame:
    """Rows with the listed values first, in the order of the list, then the others by value
    (NULL last).  A total sort: for reports that are read, not for tables."""
    place = F
    for k, value in enumerate(listed):
        place = place.when(F.col(column) == value, k)
    rank = [place.otherwise(len(listed))] if listed else []
    return df.orderBy(*rank, F.col(column).asc_nulls_last())
