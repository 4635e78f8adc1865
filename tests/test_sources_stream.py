import os
import tempfile

from pyspark.sql import functions as F

from adpulse.plans import flatten, mapping, quality
from adpulse.sources import bidlog
from adpulse.sources import fixtures as fx
from adpulse.sources import tables
from adpulse.streaming import jobs
from tests.conftest import SF_SMALL


def test_nested_json_lines_roundtrip_and_flatten(spark):
    bids = bidlog.fx_bid_nested(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="adpulse-json-")
    bids.write.mode("overwrite").partitionBy("year", "month", "day", "hour").json(d)
    back = tables.read_json_lines(spark, d, bids.drop("year", "month", "day", "hour").schema)
    assert back.count() == bids.count()
    one = tables.read_partitioned_parquet(spark, _parquet(bids), year="2024", month="01", day="05")
    assert flatten.flatten_bids(one).where(F.col("day") != "05").count() == 0


def _parquet(df):
    d = os.path.join(tempfile.mkdtemp(prefix="adpulse-pq-"), "t")
    df.write.mode("overwrite").partitionBy("year", "month", "day", "hour").parquet(d)
    return d


def test_csv_and_tsv_dimensions(spark):
    d = tempfile.mkdtemp(prefix="adpulse-csv-")
    with open(os.path.join(d, "regions.csv"), "w") as f:
        f.write('id,adm_code,name\n1,"1100000000","Seoul, Jongno"\n')
    with open(os.path.join(d, "dump.tsv"), "w") as f:
        f.write("a\tb\nx\ty\n")
    r = tables.read_csv_dimension(spark, os.path.join(d, "regions.csv")).first()
    assert r["name"] == "Seoul, Jongno"
    assert tables.read_csv_dimension(spark, os.path.join(d, "dump.tsv"), sep="\t").first()["b"] == "y"


def test_hour_completeness_counts_files(spark):
    pb = fx.fx_postback(spark, SF_SMALL).where((F.col("day") == "01") & (F.col("hour").isin("00", "01")))
    d = os.path.join(tempfile.mkdtemp(prefix="adpulse-logs-"), "t")
    pb.repartition(3).withColumn("feed", F.lit("APM")).write.mode("overwrite").partitionBy(
        "feed", "year", "month", "day", "hour").parquet(d)
    logs = spark.read.option("basePath", d).parquet(d)
    exp = spark.createDataFrame([("APM", 5)], "feed string, n_expected int")
    rows = quality.hour_completeness(logs, exp).collect()
    assert rows and all(r["missing"] for r in rows) and all(0 < r["n_files"] <= 3 for r in rows)


def test_foreach_batch_merge_state(spark):
    weekly = mapping.mapping_weekly(fx.fx_apm_flat(spark, SF_SMALL), fx.fx_addi_bid(spark, SF_SMALL),
                                    fx.fx_postback(spark, SF_SMALL), fx.fx_nhn_flat(spark, SF_SMALL),
                                    fx.fx_tg(spark, SF_SMALL), fx.OWN_MEDIA)
    root = tempfile.mkdtemp(prefix="adpulse-t6-")
    src = os.path.join(root, "weekly")
    weekly = weekly.cache()
    # Weeks land oldest first (one write each), as the weekly job produces them.
    for (w,) in sorted(weekly.select("batch_week").distinct().collect()):
        weekly.where(F.col("batch_week") == w).coalesce(1).write.mode("append").partitionBy("batch_week").parquet(src)
    state = os.path.join(root, "state")
    q = (spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
         .writeStream.foreachBatch(jobs.merge_batches_into_state(state))
         .option("checkpointLocation", os.path.join(root, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = sorted(tuple(r) for r in jobs.read_state(spark, state).select(*mapping.CURRENT_COLS).collect())
    want = sorted(tuple(r) for r in mapping.merge_fold(weekly).select(*mapping.CURRENT_COLS).collect())
    assert got == want
