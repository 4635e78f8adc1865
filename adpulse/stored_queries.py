"""Jobs whose subject is a stored table or a stream: partitioned writes, publishes, file
listings and streaming runs, registered over the driver's whole tables.

Each run writes to a new folder of the shared folder, as the job does to its table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .oracle import attribution_sql as asql
from .oracle import mapping_sql as msql
from .oracle import stored_sql as sql
from .plans import attribution as attr
from .plans import backfill, mapping, quality, summary
from .registry import register
from .sinks import publish
from .sinks import tables as sinks
from .sources import fixtures as fx
from .sources.tables import read_partitioned_parquet
from .streaming import hourly
from .streaming.jobs import file_stream


@register("stream_summary_hour", sql.STREAM_SUMMARY_HOUR)
def q_stream_summary_hour(spark, sf):
    """The hourly figures as a stream.  Postbacks land in three parts by time, and the
    stream is started anew after each; it puts out the hours that the watermark has passed."""
    logs, root = fx.fx_postback(spark, sf), sinks.scratch(spark, "hourly")
    at = F.to_timestamp("created_at")
    first, last = logs.agg(F.min(at), F.max(at)).first()                     # one row
    cuts = [first + (last - first) * k / 3 for k in (1, 2)]
    part = F.when(at < F.lit(cuts[0]), 0).when(at < F.lit(cuts[1]), 1).otherwise(2)
    for k in range(3):
        logs.where(part == k).write.parquet(f"{root}/landing/part={k}")
        stream = file_stream(spark, f"{root}/landing/*", logs.schema)
        (hourly.hourly_summary(stream, fx.fx_media(spark, sf), fx.fx_rate(spark, sf)).writeStream.format("parquet")
         .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{root}/out")


@register("backfill_days", asql.ATTR_RANGE_DIRECT)
def q_backfill_days(spark, sf):
    """B1: a table of days, first filled day by day for the days before the range's last,
    then once more by one job over the whole range, which replaces every day of it."""
    inputs = dict(postback=fx.fx_postback(spark, sf), gtm=fx.fx_gtm(spark, sf), info=fx.fx_info(spark, sf), visits=None, skb=None, tg=None)
    root = sinks.scratch(spark, "backfill")
    days = backfill.date_range(asql.RANGE_START, asql.RANGE_END)

    def job(start, end):
        return attr.attribute_v1(**inputs, start=start, end=end, routes=("direct",))

    backfill.backfill_by_day(job, days[0], days[2], root)
    backfill.backfill_range(job, days[1], days[-1], root)
    return read_partitioned_parquet(spark, root)


@register("mapping_weekly_table", msql.MAPPING_WEEKLY)
def q_mapping_weekly_table(spark, sf):
    """The weekly mapping's table is created without rows, the odd weeks are
    inserted, the even ones are written to its folder by themselves and then registered."""
    weekly = sinks.stored(mapping.mapping_weekly(fx.fx_apm_flat(spark, sf), fx.fx_addi_bid(spark, sf), fx.fx_postback(spark, sf),
                                                 fx.fx_nhn_flat(spark, sf), fx.fx_tg(spark, sf), fx.OWN_MEDIA), "weekly")
    root = sinks.scratch(spark, "weekly-table")
    name = f"weekly_{root.rsplit('-', 1)[1]}"
    sinks.create_table(spark, name, weekly.schema, root, ["batch_week"])
    odd = F.weekofyear(F.to_date("batch_week")) % 2 == 1
    sinks.append_rows(weekly.where(odd), name)
    sinks.write_partitioned(weekly.where(~odd), root, ["batch_week"])
    sinks.register_partitions(spark, name)
    return spark.table(name)


def _publish(spark, sf, table, codes):
    """The serving table after a first publish of older figures and a second one of three days."""
    pb, root = fx.fx_postback(spark, sf), sinks.scratch(spark, "serving")
    older = summary.summary_daily(pb, pb, pb, fx.DAILY_RULES, fx.fx_media(spark, sf), area=fx.fx_area(spark, sf))    # before rates were known
    publish.publish(older, root, table, F.lit(True), sql.FAMILIES)
    report = summary.summary_daily(pb, pb, pb, fx.DAILY_RULES, fx.fx_media(spark, sf), fx.fx_rate(spark, sf), fx.fx_area(spark, sf))
    return publish.publish(report.where(F.col("DATE").between(*sql.SCOPE)), root, table, F.col("day").between(*sql.SCOPE), sql.FAMILIES, codes)


@register("publish_scope_not_in", sql.PUBLISH_NOT_IN)
def q_publish_scope_not_in(spark, sf):
    """A table whose listed codes are kept when the scope is replaced."""
    return _publish(spark, sf, "own_report_daily", fx.fx_media(spark, sf).where("logparsefg = 'N'").select("mediacd"))


@register("publish_scope_in", sql.PUBLISH_IN)
def q_publish_scope_in(spark, sf):
    """A table of whose scope only the listed codes are replaced."""
    return _publish(spark, sf, "customer_report_daily", fx.fx_media(spark, sf).where("logparsefg = 'Y'").select("mediacd"))


@register("publish_scope_date", sql.PUBLISH_DATE)
def q_publish_scope_date(spark, sf):
    """A table whose whole scope is replaced."""
    return _publish(spark, sf, "plain_report_daily", None)


def partitioned_days(spark, sf, root):
    """Postbacks written by day, a second part appended, and read again for the
    days that a table names at run time; only those days' folders are scanned."""
    logs = fx.fx_postback(spark, sf)
    early = F.col("day") <= "15"
    sinks.write_partitioned(logs.where(early), root, sinks.PARTS_DAY, mode="overwrite")
    sinks.write_partitioned(logs.where(~early), root, sinks.PARTS_DAY, mode="append")
    start = F.to_timestamp("startdt")
    days = (fx.fx_adgroup(spark, sf).where(F.col("logparsefg") == "N")
            .select(F.date_format(start, "yyyy").alias("year"), F.date_format(start, "MM").alias("month"), F.date_format(start, "dd").alias("day")).distinct())
    # One row for each day on which a flight starts: a few hundred bytes.
    return (read_partitioned_parquet(spark, root).join(F.broadcast(days), sinks.PARTS_DAY)
            .groupBy(*sinks.PARTS_DAY).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("req_id").alias("requests")))


@register("partitioned_days", sql.PARTITIONED_DAYS)
def q_partitioned_days(spark, sf):
    """A table by day, written in two parts, pruned by a table of dates."""
    return partitioned_days(spark, sf, sinks.scratch(spark, "days"))


@register("log_completeness", sql.LOG_COMPLETENESS)
def q_log_completeness(spark, sf):
    """Files of each feed and hour against its producers, hours without a file included."""
    root = sinks.scratch(spark, "landing")
    feed = F.when(F.col("hour").cast("int") % 2 == 0, "A").otherwise("B")    # each feed lands every other hour
    producer = F.when(F.col("hour").isin("05", "11", "16", "22"), F.lit(0)).otherwise(F.col("creative_no") % 2)
    keys = ["feed", *sinks.PARTS_HOUR]
    logs = fx.fx_postback(spark, sf).select(feed.alias("feed"), producer.alias("producer"), *sinks.PARTS_HOUR, "req_id")
    for k in (0, 1):                                                         # one file a producer and hour
        logs.where(F.col("producer") == k).repartition(*keys).write.mode("append").partitionBy(*keys).json(root)
    feeds = spark.createDataFrame([("A", 2), ("B", 2)], "feed string, n_expected int")
    files = sinks.stored(quality.landed_files(spark, root, "*.json"), "files")
    first, last = files.agg(F.min(F.concat_ws("-", *sinks.PARTS_DAY)), F.date_add(F.max(F.to_date(F.concat_ws("-", *sinks.PARTS_DAY))), 1)).first()
    return quality.file_completeness(files, quality.hour_calendar(feeds, f"{first} 00", f"{last} 23"))
