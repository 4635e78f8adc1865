"""Channel report (R8): postbacks by carrier and content, per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import carrier_channel
from ..operators.joins import broadcast_if_bounded


def _day(df: DataFrame):
    return F.to_date(F.concat_ws("-", "year", "month", "day"))


def channel_daily(apm_postback: DataFrame, abi_postback: DataFrame, bids: DataFrame, media: DataFrame, target_id: str,
                  start: str | None = None, end: str | None = None) -> DataFrame:
    """Per day D: APM postbacks (distinct rows) left-joined on req_id to the
    bids of D and D-1 for carrier/content; ABI postbacks of the target carry their own.

    The "today or yesterday" partition filter becomes an equi-join key: each
    bid is offered to its own day and to the next one (2 copies), so every day
    of a range is handled in one job with a plain hash join.
    """
    m = broadcast_if_bounded(media.where(F.lower("logparsefg") == "y").select("mediacd").distinct())

    def in_range(df):
        d = F.date_format(_day(df), "yyyy-MM-dd")
        c = F.lit(True)
        if start is not None:
            c = c & (d >= start)
        if end is not None:
            c = c & (d <= end)
        return df.where(c)

    apm = (in_range(apm_postback).where(F.col("cmp_no").isNotNull() & F.col("ag_no").isNotNull())
           .join(m, F.col("media_id") == F.col("mediacd"), "left_semi")
           .select(F.concat("year", F.lit("-"), "month", F.lit("-"), "day").alias("date"), "req_id",
                   F.col("cmp_no").alias("cmpno"), F.col("ag_no").alias("agno"), F.col("media_id").alias("mediacd"),
                   "log_type", "year", "month", "day").distinct())
    # Bids of the reported days and of the day before the first: a filter on the partition columns.
    if start is not None:
        first = F.date_format(F.date_sub(F.to_date(F.lit(start)), 1), "yyyy-MM-dd")
        bids = bids.where(F.concat_ws("-", "year", "month", "day") >= first)
    if end is not None:
        bids = bids.where(F.concat_ws("-", "year", "month", "day") <= F.lit(end))
    b = (bids.join(m, F.col("req.media_id") == F.col("mediacd"), "left_semi")
         .select(F.col("req.req_id").alias("_rid"), carrier_channel(F.col("req.app_bundle"), "uplus").alias("carrier"),
                 F.col("req.content_id").alias("contentid"),
                 F.explode(F.array(_day(bids), F.date_add(_day(bids), 1))).alias("_for_day")))
    apm_j = (apm.withColumn("_pd", F.to_date(F.concat_ws("-", "year", "month", "day")))
             .join(b, (F.col("req_id") == F.col("_rid")) & (F.col("_pd") == F.col("_for_day")), "left"))
    keys = ["date", "cmpno", "agno", "carrier", "contentid", "mediacd", "year", "month", "day"]

    def report(df):
        return df.groupBy(*keys).agg(
            F.count_distinct("req_id").alias("reqidcnt"),
            F.sum(F.when(F.col("log_type") == "i", 1).otherwise(0)).cast("bigint").alias("impcnt"),
            F.sum(F.when(F.col("log_type") == "v_complete", 1).otherwise(0)).cast("bigint").alias("q4cnt"))
    abi = (in_range(abi_postback).where(F.col("cmp_no").isNotNull() & F.col("ag_no").isNotNull()
                                        & (F.col("g_targetid") == target_id))
           .join(m, F.col("media_id") == F.col("mediacd"), "left_semi")
           .select(F.concat("year", F.lit("-"), "month", F.lit("-"), "day").alias("date"), "req_id",
                   F.col("media_id").alias("mediacd"), F.col("cmp_no").alias("cmpno"), F.col("ag_no").alias("agno"),
                   "log_type", carrier_channel("ctv_media", "lguplus").alias("carrier"),
                   F.col("content_id").alias("contentid"), "year", "month", "day").distinct())
    cols = ["date", "cmpno", "agno", "carrier", "contentid", "mediacd", "reqidcnt", "impcnt", "q4cnt",
            "year", "month", "day"]
    return report(abi).select(*cols).unionByName(report(apm_j).select(*cols))
