"""The nested bid logs: what is gathered per request, and the lists made from it."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from adpulse.sources import bidlog

LINES = [(1, 2, 7, 3, 10.5, 0.1, 0.02), (1, 1, 9, 4, 20.25, 0.2, 0.03), (1, 1, 9, 4, 20.25, 0.2, 0.03), (1, None, 5, 1, 1.0, 0.0, 0.0),
         (2, 3, None, 5, None, None, None), (None, 1, 1, 1, 1.0, 0.1, 0.1), (9, 1, 1, 1, 1.0, 0.1, 0.1)]


@pytest.fixture(scope="module")
def tables(spark):
    d = tempfile.mkdtemp(prefix="adpulse-bidlog-")
    spark.createDataFrame([(1, 10), (2, 20), (3, 30), (11, 40), (2, 20), (None, 50)], "o_orderkey long, o_custkey long") \
        .write.parquet(os.path.join(d, "orders.parquet"))
    spark.createDataFrame(LINES, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_extendedprice double, "
                                 "l_discount double, l_tax double").write.parquet(os.path.join(d, "lineitem.parquet"))
    return d


@pytest.mark.parametrize("log", ["fx_bid_nested", "fx_bid_native", "fx_bid_flat"])
def test_only_the_lines_are_gathered(spark, tables, log):
    df = getattr(bidlog, log)(spark, tables)
    gathered = [line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "collect_list" in line]
    assert len(gathered) == 1 and gathered[0].count("collect_list") == 1 and "concat" not in gathered[0], gathered
    rows = {r.id: r for r in df.select(F.coalesce(*[F.col(f"req.{c}") for c in df.schema["req"].dataType.names if c in ("id", "req_id")]).alias("id"),
                                       F.size("req.imp").alias("n"), F.col("req.imp.id").alias("imps"), F.size("res.seatbid").alias("bids"),
                                       F.col("res").isNull().alias("none")).collect()}
    assert rows["q1"].imps == [None, "imp1", "imp1", "imp2"] and rows["q1"].bids == 4      # by line number, NULL first
    assert rows["q2"].n == 2                                                               # the request listed twice
    assert rows["q3"].imps is None and not rows["q3"].none and rows["q11"].none
