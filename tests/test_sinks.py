import os
import tempfile

from pyspark.sql import functions as F

from adpulse.plans import backfill, quality
from adpulse.sinks import tables as sinks


def test_replace_partitions_is_idempotent_and_scoped(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="adpulse-sink-"), "t")
    day1 = spark.createDataFrame([(1, "2024", "01", "01"), (2, "2024", "01", "02")], "v int, year string, month string, day string")
    assert sinks.replace_partitions(day1, path, sinks.PARTS_DAY)["rows"] == 2
    redo = spark.createDataFrame([(9, "2024", "01", "02")], "v int, year string, month string, day string")
    sinks.replace_partitions(redo, path, sinks.PARTS_DAY)
    sinks.replace_partitions(redo, path, sinks.PARTS_DAY)
    got = sorted((r["v"], r["day"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, "01"), (9, "02")]


def test_requested_partitions_that_come_back_empty_are_removed(spark):
    schema = "v int, year string, month string, day string"
    rows = [(1, "2024", "01", "01"), (2, "2024", "01", "02"), (3, "2024", "01", "03")]
    paths = [os.path.join(tempfile.mkdtemp(prefix="adpulse-sink-"), "t") for _ in range(2)]
    for path in paths:
        sinks.replace_partitions(spark.createDataFrame(rows, schema), path, sinks.PARTS_DAY)
    new = spark.createDataFrame([(9, "2024", "01", "01")], schema)

    def job(start, end):
        return new.where(F.concat_ws("-", "year", "month", "day").between(start, end))

    assert backfill.backfill_range(job, "2024-01-01", "2024-01-02", paths[0])["rows"] == 1
    assert backfill.backfill_by_day(job, "2024-01-01", "2024-01-02", paths[1]) == {"2024-01-01": 1, "2024-01-02": 0}
    got = [sorted((r["v"], r["day"]) for r in spark.read.parquet(p).collect()) for p in paths]
    assert got[0] == got[1] == [(3, "03"), (9, "01")]


def test_serving_projection_renames_date(spark):
    df = spark.createDataFrame([("2024-01-01", 1, "2024", "01", "01")], "DATE string, IMPS int, year string, month string, day string")
    assert sinks.serving_projection(df, "report_summary_daily").columns == ["IMPS", "day"]
    assert sinks.serving_projection(df, "report_addi_conv_app").columns == df.columns


def test_scoped_replace_code_filters(spark):
    ex = spark.createDataFrame([("2024-01-01", "A", 1), ("2024-01-01", "B", 2), ("2024-01-02", "A", 3),
                                ("2024-01-01", None, 4)], "day string, mediacd string, v int")
    new = spark.createDataFrame([("2024-01-01", "A", 10)], "day string, mediacd string, v int")
    codes = spark.createDataFrame([("B",)], "c string")
    out = sorted(r["v"] for r in sinks.scoped_replace(ex, new, F.col("day") == "2024-01-01", codes).collect())
    assert out == [2, 3, 4, 10]          # A deleted (not in list), B kept, NULL code kept, other day kept
    with_null = spark.createDataFrame([("B",), (None,)], "c string")
    out2 = sorted(r["v"] for r in sinks.scoped_replace(ex, new, F.col("day") == "2024-01-01", with_null).collect())
    assert out2 == [1, 2, 3, 4, 10]      # NOT IN with a NULL deletes nothing
    out3 = sorted(r["v"] for r in sinks.scoped_replace(ex, new, F.col("day") == "2024-01-01").collect())
    assert out3 == [3, 10]


def test_tsv_sanitising(spark):
    df = spark.createDataFrame([("a\tb\nc|d", 'say "hi"', "  x   y  ", "None", None)],
                               "a string, b string, c string, d string, e string")
    assert tuple(sinks.sanitize_for_tsv(df).first()) == ("a b c d", "say 'hi'", "x y", "", "")


def test_rename_columns(spark):
    df = spark.createDataFrame([(1, 2)], "m1 int, other int")
    assert sinks.rename_columns(df, {"m1": "installs", "zz": "x"}).columns == ["installs", "other"]


def test_consistency_checks_equal_unequal_empty(spark):
    h = spark.createDataFrame([("2024", "01", "01", 5, 1, None, None, None, None)],
                              "year string, month string, day string, IMPS bigint, CLICKS bigint, Q1 bigint, "
                              "Q2 bigint, Q3 bigint, Q4 bigint")
    d_same = h
    d_diff = h.withColumn("IMPS", F.lit(6).cast("bigint"))
    assert [r["error_cnt"] for r in quality.check_hour_vs_daily(h, d_same).collect()] == [0]
    assert [r["error_cnt"] for r in quality.check_hour_vs_daily(h, d_diff).collect()] == [1]
    assert quality.expect(quality.check_hour_vs_daily(h, d_same)).first()["passed"] is True


def test_created_table_appends_and_registers(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="adpulse-created-"), "t")
    rows = spark.createDataFrame([(1, ["a"], "2024-01-01"), (2, None, "2024-01-08")], "v bigint, tags array<string>, week string")
    sinks.create_table(spark, "created_t", rows.schema, path, ["week"])
    assert spark.table("created_t").schema == rows.schema and spark.table("created_t").count() == 0
    sinks.append_rows(rows.where("v = 1").select("week", "tags", "v"), "created_t")       # by name, not by place
    sinks.create_table(spark, "created_t", rows.schema, path, ["week"])                   # stays as it is
    sinks.write_partitioned(rows.where("v = 2"), path, ["week"])
    assert [r.v for r in spark.table("created_t").collect()] == [1]                       # the other folder is not known yet
    sinks.register_partitions(spark, "created_t")
    assert sorted(map(tuple, spark.table("created_t").collect())) == [(1, ["a"], "2024-01-01"), (2, None, "2024-01-08")]
    spark.sql("DROP TABLE created_t")
