"""The hourly postback report as a stream (T2): the figures of ``summary.summary_lookup``.

Three aggregations in a row, each over hour windows of the event time, in append mode:

1. one row per (hour, request, report key) with flags and row counts, so that a request's
   repeated rows take no further room;
2. per (hour, request) the largest readable price of any of its rows, with the list of its
   keys (as many as the request has keys);
3. per (hour, report key) the sums.

An hour is put out once, when the watermark has passed its end; then its state is dropped.
Rows of an hour that has been put out are late and ignored, as the hourly run ignores what
lands after it.  Media weights and exchange rates are static tables that join the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_bounded, match_weights
from ..operators.lookups import previous_month_rate

KEYS = ["media_id", "cmp_no", "ag_no", "creative_no"]
_QUARTILES = {"Q1": "v_firstQ", "Q2": "v_mid", "Q3": "v_thirdQ", "Q4": "v_complete"}


def hourly_summary(postbacks: DataFrame, media: DataFrame | None = None, rates: DataFrame | None = None, lateness: str = "1 hour") -> DataFrame:
    """``postbacks`` is a stream with created_at as ISO text; columns as ``summary_lookup``
    gives them at the grain of hours, with the hour taken from created_at."""
    lt = F.col("log_type")
    rows = (postbacks.where(F.col("cmp_no").isNotNull() & F.col("ag_no").isNotNull() & F.col("creative_no").isNotNull())
            .withColumn("event_time", F.to_timestamp("created_at")).withWatermark("event_time", lateness))
    flags = {"IMPS": lt == "i", "PAYMENTCNT": (lt != "e_i") & (F.col("is_cpvc") == "1"), **{q: lt == v for q, v in _QUARTILES.items()}}
    named = F.col("req_id").isNotNull()
    one = rows.groupBy(F.window("event_time", "1 hour").alias("w1"), "req_id", *KEYS).agg(
        F.max(F.when(F.col("price").try_cast("double").isNotNull(), F.col("price"))).alias("price"),       # largest as text
        *[F.max(F.when(named & c, 1).otherwise(0)).alias(n) for n, c in flags.items()],
        F.sum(F.when(lt == "c", 1).otherwise(0)).alias("clicks"), F.sum(F.when(lt == "i", 1).otherwise(0)).alias("shown"),
        F.sum(F.when(lt == "e_i", 1).otherwise(0)).alias("errors"), F.count(F.lit(1)).alias("all"))
    part = F.struct(*KEYS, *flags, "clicks", "shown", "errors", "all")
    # Rows without a request id have no price to share, so they are not one hot group: they are
    # told apart by their keys.
    request = F.coalesce(F.col("req_id"), F.concat_ws("\t", F.lit(""), *KEYS))
    two = one.groupBy(F.window("w1", "1 hour").alias("w2"), request.alias("_r"), named.alias("named")).agg(
        F.max("price").alias("price"), F.collect_list(part).alias("parts"))
    flat = two.select("w2", "named", F.when(F.col("named"), F.col("price")).cast("double").alias("price"), F.explode("parts").alias("p")).select("w2", "named", "price", "p.*")
    p, shown, errors = F.col("price"), F.col("shown"), F.col("errors")
    # As SUM over rows: an impression without a price is NULL, any other row gives 0.
    paid = F.when(p.isNotNull(), shown * p).when(F.col("all") > shown, F.lit(0.0))
    lost = F.when(p.isNotNull(), errors * p).when(F.col("all") > errors, F.lit(0.0))
    three = flat.groupBy(F.window("w2", "1 hour").alias("w"), *KEYS).agg(
        *[F.sum(n).alias(n) for n in flags], F.sum(F.when(F.col("named"), F.col("clicks")).otherwise(0)).alias("CLICKS"),
        F.sum(paid).alias("PAYMENT"), F.sum(F.when(F.col("named"), errors).otherwise(0)).alias("ERRORIMPS"), F.sum(lost).alias("ERRORPAYMENT"))
    return _presented(three, media, rates)


def _presented(sums: DataFrame, media: DataFrame | None, rates: DataFrame | None) -> DataFrame:
    at = F.col("w.start")
    out = sums.withColumns({"year": F.date_format(at, "yyyy"), "month": F.date_format(at, "MM"), "day": F.date_format(at, "dd"),
                            "hour": F.date_format(at, "HH"), "DATETIME": F.date_format(at, "yyyy-MM-dd HH:00:00")})
    if media is None:
        out = out.withColumn("_w", F.lit(1))
    else:
        weight = broadcast_if_bounded(match_weights(media.where(F.col("logparsefg") == "Y"), "mediacd"))
        out = out.join(weight, out["media_id"] == weight["mediacd"], "left").withColumn("_w", F.coalesce("_w", F.lit(1)))
    if rates is None:
        out = out.withColumn("EXCHANGEWON", F.lit(0.0))
    else:
        out = (out.withColumn("rate_ym", F.col("year").cast("int") * 100 + F.col("month").cast("int"))
               .join(broadcast_if_bounded(previous_month_rate(rates)), "rate_ym", "left")
               .withColumn("EXCHANGEWON", F.coalesce("EXCHANGEWON", F.lit(0.0))))
    weighted = {n: F.col(n) * F.col("_w") for n in ("CLICKS", "PAYMENT", "ERRORIMPS", "ERRORPAYMENT")}
    big = lambda n: weighted.get(n, F.col(n)).cast("bigint").alias(n)
    real = lambda n: weighted.get(n, F.col(n)).cast("double").alias(n)
    return out.select("DATETIME", F.col("media_id").alias("MEDIACD"), F.col("cmp_no").cast("int").alias("CMPNO"), F.col("ag_no").cast("int").alias("AGNO"),
                      F.col("creative_no").cast("int").alias("CREATIVENO"), "EXCHANGEWON", big("IMPS"), big("CLICKS"), real("PAYMENT"),
                      real("PAYMENTCNT"), *[big(q) for q in _QUARTILES], big("ERRORIMPS"), real("ERRORPAYMENT"), "year", "month", "day", "hour")
