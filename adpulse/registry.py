"""Registered jobs: one key per job/operator, each ``(spark, sf_dir) -> DataFrame``.

Every registered query reads the driver's tables (through the ``fx_*``
projections) in full; nothing is subset or capped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: Sums of doubles, whose last digits depend on the order of the rows.
ORDER_DEPENDENT = {"PAYMENT", "PAYMENTCNT", "ERRORPAYMENT", "revenue", "conversions", "metric_sum"}


def presented(df: DataFrame, digits: int = 4) -> DataFrame:
    """Order-dependent float sums rounded, by name, so that they compare exactly, and
    timestamps as UTC wall-clock values (independent of the client zone)."""
    def conv(f):
        if f.name in ORDER_DEPENDENT and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.col(f.name)
    return df.select(*[conv(f) for f in df.schema.fields])


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return presented(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import queries, stored_queries  # noqa: F401
