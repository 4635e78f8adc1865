"""Daily conversion reports (D1-D6).  Each takes an optional [start, end]
event-date range; ``None`` bounds mean every date in the input, which is the
range (backfill) form D6 in one job instead of a day loop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import event_name, is_present, nullif_blank, regexp_extract_or_null
from ..operators.joins import broadcast_if_bounded


def _between(c, start: str | None, end: str | None):
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start))
    if end is not None:
        cond = cond & (c <= F.lit(end))
    return cond


def _parts(dt_col: str):
    c = F.col(dt_col).cast("string")
    return [F.substring(c, 1, 4).alias("year"), F.substring(c, 6, 2).alias("month"), F.substring(c, 9, 2).alias("day")]


def report_web(raw: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Distinct event ips per (campaign, pixel, event, day) of the attribution table."""
    r = raw.where(_between(F.col("mall_dt"), start, end))
    return (r.groupBy("cmp_no", "pid", "ev", "mall_dt").agg(F.count_distinct("mall_ip").alias("daily_unique_ip"))
            .select("cmp_no", "pid", "ev", F.to_date("mall_dt").alias("dt"), "daily_unique_ip",
                    F.substring("mall_dt", 1, 4).alias("year"), F.substring("mall_dt", 6, 2).alias("month"),
                    F.substring("mall_dt", 9, 2).alias("day")))


def report_web_imp(raw_imp: DataFrame, start: str | None = None, end: str | None = None,
                   window_days: int = 8) -> DataFrame:
    """Impression-date x event-date matrix; events within ``window_days``
    (half-open) after the impression."""
    post = F.to_timestamp("post_datetime")
    mall = F.to_timestamp("mall_datetime")
    r = raw_imp.where(_between(F.col("mall_dt"), start, end) & (mall >= post)
                      & (mall < post + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(window_days))))
    return (r.groupBy("imp_dt", "mall_dt", "cmp_no", "pid", "ev")
            .agg(F.count_distinct("mall_ip").alias("daily_unique_ip"))
            .select("imp_dt", F.to_date("mall_dt").alias("mall_dt"), "cmp_no", "pid", "ev", "daily_unique_ip",
                    F.substring("mall_dt", 1, 4).alias("year"), F.substring("mall_dt", 6, 2).alias("month"),
                    F.substring("mall_dt", 9, 2).alias("day")))


def report_app(app_log: DataFrame, info: DataFrame, start: str | None = None,
               end: str | None = None) -> DataFrame:
    """D3: app postbacks per (day, tracker, campaign, event): distinct ips and
    revenue (unparseable revenue ignored); test clicks dropped."""
    cmps = info.groupBy("cmp_no").agg(F.max("app_mmp_cd").alias("app_mmp_cd"))
    dt = F.substring("created_at", 1, 10)
    base = (app_log.where(is_present("ip") & (F.col("click_id").isNull() | (F.trim("click_id") != "TEST"))
                          & _between(dt, start, end))
            .withColumn("_cmp", nullif_blank("cmp").try_cast("bigint"))
            .join(broadcast_if_bounded(cmps), F.col("_cmp") == F.col("cmp_no"))
            .select(dt.alias("dt"), "tracker", "cmp", "event", "ip", "app_mmp_cd",
                    nullif_blank("revenue").try_cast("double").alias("revenue")))
    daily = base.groupBy("dt", "tracker", "cmp", "event", "app_mmp_cd").agg(
        F.count_distinct("ip").alias("daily_unique_ip"), F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("revenue"))
    return daily.select("tracker", "cmp", "event", "dt", "daily_unique_ip", "revenue", "app_mmp_cd", *_parts("dt"))


def report_click_utm(gtm: DataFrame, gclids: DataFrame, info: DataFrame, start: str | None = None,
                     end: str | None = None, utm_pattern: str = r"utm_campaign=([^&]+)") -> DataFrame:
    """Web events credited to an ad-platform campaign by click id (gclid
    route) or by the campaign tag in the url (utm route); distinct ips per day."""
    day = F.date_format(F.to_date(F.substring("log_time", 1, 10), "yyyy/MM/dd"), "yyyy-MM-dd")
    # Distinct ips are counted, so copies of a click id or of a campaign change nothing: they
    # go before the events meet them, which they would multiply.
    g = (gtm.withColumn("dt", day).where(_between(F.col("dt"), start, end))
         .select("dt", "pid", regexp_extract_or_null("url", utm_pattern).alias("utm_campaign"), "gclid",
                 event_name("ev", F.col("conv_type").cast("string"), F.col("click").cast("string")).alias("ev"), "ip"))
    inf = info.where(F.col("cmp_no").isNotNull())
    clicks = (gclids.select(F.col("cmp_you_no").cast("string").alias("cmp_you_no"), "gclid")
              .join(broadcast_if_bounded(inf.select("cmp_no", "cmp_you_no").distinct()), "cmp_you_no").distinct())
    by_click = (g.join(broadcast_if_bounded(clicks), "gclid")
                .select("dt", "cmp_no", "pid", "cmp_you_no", "ev", "ip"))
    pixels = inf.select("cmp_no", F.col("pixel_id").alias("pid"), "cmp_you_no").distinct()
    by_utm = (g.withColumnRenamed("utm_campaign", "cmp_you_no").join(broadcast_if_bounded(pixels), ["pid", "cmp_you_no"])
              .select("dt", "cmp_no", "pid", "cmp_you_no", "ev", "ip"))
    agg = (by_click.unionByName(by_utm)
           .groupBy("cmp_no", "pid", "cmp_you_no", "ev", "dt").agg(F.count_distinct("ip").alias("daily_unique_ip")))
    return agg.select("cmp_no", "pid", "cmp_you_no", "ev", F.to_date("dt").alias("dt"), "daily_unique_ip",
                      *_parts("dt"))


def report_metrics(metrics: DataFrame, info: DataFrame, yt_list: DataFrame, start: str | None = None,
                   end: str | None = None) -> DataFrame:
    """Ad-platform metrics per (campaign map, platform campaign, day); the
    campaign map is the distinct union of our info table and the platform list."""
    cmap = (info.select("cmp_no", "cmp_you_no")
            .union(yt_list.select(F.col("campaign_no").alias("cmp_no"), F.col("campaign_id").alias("cmp_you_no")))
            .distinct().select("cmp_no", F.col("cmp_you_no").cast("bigint").alias("_cy")))
    m = metrics.where(_between(F.col("date"), start, end))
    agg = (m.join(broadcast_if_bounded(cmap), F.col("_cy") == F.col("campaign_no"), "left")
           .groupBy("cmp_no", "campaign_no", "campaign_name", "date")
           .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("impressions", "trueviews", "clicks")],
                F.coalesce(F.sum("conversions"), F.lit(0.0)).alias("conversions")))
    return agg.select(F.coalesce("cmp_no", F.lit(0)).alias("cmp_no"), "campaign_no",
                      F.coalesce("campaign_name", F.lit("")).alias("campaign_name"), "date", "impressions",
                      "trueviews", "clicks", "conversions", *_parts("date"))
