"""Consistency checks (Q1-Q4) and log completeness (S21), one row per day.

The reference checks one day by cross-joining two one-row aggregates; here
both sides are aggregated per day and joined on the day key (full outer, so a
day present on one side only is compared with zeros)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_bounded

DAY = ["year", "month", "day"]


def _sums(df: DataFrame, cols: dict[str, str], zero: set[str]) -> DataFrame:
    aggs = [(F.coalesce(F.sum(src), F.lit(0)) if name in zero else F.sum(src)).alias(name)
            for name, src in cols.items()]
    return df.groupBy(*DAY).agg(*aggs)


def _compare(a: DataFrame, b: DataFrame, metrics: list[str]) -> DataFrame:
    j = a.alias("a").join(b.alias("b"), DAY, "full_outer")
    diff = reduce(lambda x, y: x | y, [(F.coalesce(F.col(f"a.{m}"), F.lit(0)) - F.coalesce(F.col(f"b.{m}"), F.lit(0)))
                                       != 0 for m in metrics])
    return j.select(*DAY, F.when(diff, 1).otherwise(0).cast("bigint").alias("error_cnt"))


def check_hour_vs_daily(hourly: DataFrame, daily: DataFrame) -> DataFrame:
    """Q1: hour and day summaries agree on imps, clicks, q1-q4 (error_cnt 0/1 per day)."""
    m = {"imps": "IMPS", "clicks": "CLICKS", "q1": "Q1", "q2": "Q2", "q3": "Q3", "q4": "Q4"}
    return _compare(_sums(hourly, m, {"imps", "clicks"}), _sums(daily, m, {"imps", "clicks"}), list(m))


def check_daily_vs_channel(daily: DataFrame, channel: DataFrame) -> DataFrame:
    """Q2: inventory rows of the daily summary agree with the channel report."""
    d = _sums(daily.where(F.col("INVENTORYNM") != ""), {"imps": "IMPS", "q4": "Q4"}, {"imps"})
    c = _sums(channel, {"imps": "impcnt", "q4": "q4cnt"}, {"imps"})
    return _compare(c, d, ["imps", "q4"])


def check_reach_negative(reach: DataFrame) -> DataFrame:
    """Q3: rows of the reach report with any negative metric, per day."""
    neg = reduce(lambda x, y: x | y, [F.col(c) < 0 for c in
                                      ("UNIQUEREACH", "DAILYFREQUENCY", "REACH1", "REACH2", "REACH3")])
    return reach.groupBy(*DAY).agg(F.count(F.when(neg, 1)).alias("error_cnt"))


def expect(check: DataFrame, expected: int = 0, col: str = "error_cnt") -> DataFrame:
    """Q4: pass/fail per checked row against an expected value."""
    return check.withColumn("passed", F.col(col) == F.lit(expected))


def hour_completeness(logs: DataFrame, expected: DataFrame, file_col: str = "_file",
                      marker: str | None = None) -> DataFrame:
    """Distinct producer files per hour; an hour with some but fewer than
    the expected files is reported missing (``expected``: feed, n_expected)."""
    f = logs.select("feed", *DAY, "hour", F.input_file_name().alias(file_col))
    if marker is not None:
        f = f.where(F.col(file_col).contains(marker))
    per_hour = f.groupBy("feed", *DAY, "hour").agg(F.count_distinct(file_col).alias("n_files"))
    return (per_hour.join(broadcast_if_bounded(expected), "feed")
            .withColumn("missing", (F.col("n_files") > 0) & (F.col("n_files") < F.col("n_expected"))))


def landed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Every file below ``path`` with its hour folder: feed, year, month, day, hour, path,
    length and time of last change.  Only the listing is read, no file's content."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
             .select("path", "length", "modificationTime"))
    part = lambda name: F.regexp_extract("path", rf"/{name}=([^/]+)/", 1).alias(name)
    return files.select(*[part(c) for c in ("feed", *DAY, "hour")], "path", "length", "modificationTime")


def hour_calendar(feeds: DataFrame, start: str, end: str) -> DataFrame:
    """Every (feed, hour) from ``start`` to ``end`` ('yyyy-MM-dd HH', both included)."""
    at = F.explode(F.sequence(F.to_timestamp(F.lit(start), "yyyy-MM-dd HH"), F.to_timestamp(F.lit(end), "yyyy-MM-dd HH"), F.expr("INTERVAL 1 HOUR")))
    return feeds.select("feed", "n_expected", at.alias("_t")).select(
        "feed", "n_expected", F.date_format("_t", "yyyy").alias("year"), F.date_format("_t", "MM").alias("month"),
        F.date_format("_t", "dd").alias("day"), F.date_format("_t", "HH").alias("hour"))


def file_completeness(files: DataFrame, calendar: DataFrame) -> DataFrame:
    """S21 over the expected hours: files found, ``missing`` as the reference flags it (some
    files, but fewer than expected) and ``empty`` for the hours without any file."""
    keys = ["feed", *DAY, "hour"]
    found = files.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_files"))
    n = F.coalesce("n_files", F.lit(0))
    return calendar.join(found, keys, "left").select(
        *keys, "n_expected", n.alias("n_files"), ((n > 0) & (n < F.col("n_expected"))).alias("missing"), (n == 0).alias("empty"))


def load_summary(tables: dict[str, DataFrame], date_col: str = "mall_dt") -> DataFrame:
    """Q5: per table and date, rows, distinct ips and campaigns (the load check)."""
    out = None
    for name, df in tables.items():
        part = df.groupBy(F.col(date_col).alias(date_col)).agg(
            F.count(F.lit(1)).alias("row_cnt"), F.count_distinct("mall_ip").alias("unique_ip_cnt"),
            F.count_distinct("cmp_no").alias("cmp_no_cnt")).select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def report_load_summary(tables: dict[str, tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Q6: per report table and date, rows, the sum of the table's own metric and the
    number of its campaigns; ``tables``: name -> (table, date, metric, campaign column)."""
    out = None
    for name, (df, date, metric, campaign) in tables.items():
        part = df.groupBy(F.col(date).cast("string").alias("dt")).agg(
            F.count(F.lit(1)).alias("row_cnt"), F.sum(F.col(metric).cast("double")).alias("metric_sum"),
            F.count_distinct(campaign).alias("campaign_cnt")).select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out
