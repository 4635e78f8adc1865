"""Hourly and daily postback summaries.

The reference runs these once per hour/day partition; here one job covers every
partition present in the input (the grain columns are part of every key), so a
single-hour run is the same call on a partition-filtered input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import area_code
from ..operators.aggregates import distinct_flag_counts
from ..operators.joins import broadcast_if_bounded, match_weights
from ..operators.lookups import previous_month_rate, text_max
from .rules import DailyRules

HOUR = ["year", "month", "day", "hour"]
DAY = ["year", "month", "day"]
METRICS = ["IMPS", "CLICKS", "PAYMENT", "PAYMENTCNT", "Q1", "Q2", "Q3", "Q4",
           "ERRORIMPS", "ERRORPAYMENT"]


def _label(grain: list[str]) -> Column:
    if grain == HOUR:
        return F.concat(F.col("year"), F.lit("-"), F.col("month"), F.lit("-"), F.col("day"),
                        F.lit(" "), F.col("hour"), F.lit(":00:00")).alias("DATETIME")
    return F.concat(F.col("year"), F.lit("-"), F.col("month"), F.lit("-"), F.col("day")).alias("DATE")


def _ids_present(pb: DataFrame) -> DataFrame:
    return pb.where(F.col("cmp_no").isNotNull() & F.col("ag_no").isNotNull()
                    & F.col("creative_no").isNotNull())


def _with_rate(df: DataFrame, rates: DataFrame | None) -> DataFrame:
    """Attach EXCHANGEWON: latest rate of the month before the row's month, else 0."""
    ym = F.col("year").cast("int") * 100 + F.col("month").cast("int")
    if rates is None:
        return df.withColumn("EXCHANGEWON", F.lit(0.0))
    r = broadcast_if_bounded(previous_month_rate(rates))
    return (df.withColumn("rate_ym", ym).join(r, "rate_ym", "left").drop("rate_ym")
            .withColumn("EXCHANGEWON", F.coalesce(F.col("EXCHANGEWON"), F.lit(0.0))))


def _with_media_weight(df: DataFrame, media: DataFrame | None) -> DataFrame:
    """``LEFT JOIN media ON mediacd = media_id AND logparsefg = 'Y'`` keeps every
    row and only multiplies rows whose media code repeats; carry that as a weight."""
    if media is None:
        return df.withColumn("_w", F.lit(1))
    w = broadcast_if_bounded(match_weights(media.where(F.col("logparsefg") == "Y"), "mediacd"))
    return (df.join(w, df["media_id"] == w["mediacd"], "left").drop("mediacd")
            .withColumn("_w", F.coalesce(F.col("_w"), F.lit(1))))


def summary_lookup(pb: DataFrame, grain: list[str] = HOUR, media: DataFrame | None = None,
                   rates: DataFrame | None = None, dims: dict[str, Column] | None = None,
                   area: DataFrame | None = None, numeric_price: bool = False,
                   older_price_rule: bool = False) -> DataFrame:
    """R1/R4 (and the ABI/NHN part of R5): price-lookup feeds.

    price per request = largest castable price text of that request within the
    partition; IMPS/PAYMENTCNT/Q1-Q4 count distinct requests; CLICKS and
    ERRORIMPS count rows; PAYMENT sums the looked-up price on every 'i' row.
    ``older_price_rule`` (R4) drops the castability filter on the lookup.
    """
    base = _ids_present(pb)
    priced = base if older_price_rule else base.where(F.col("price").try_cast("double").isNotNull())
    price = text_max(priced.where(F.col("req_id").isNotNull()), grain + ["req_id"], "price",
                     "_lp", numeric=numeric_price)
    raw = base.join(price, grain + ["req_id"], "left")
    raw = _with_media_weight(raw, media)
    if area is not None:
        amap = broadcast_if_bounded(area.select("areacd", F.col("google_ab_region").alias("_rg")).distinct())
        raw = raw.join(amap, raw["region"] == amap["_rg"], "left").drop("_rg")
    dims = dims or {}
    raw = raw.select(_label(grain), F.col("media_id").alias("MEDIACD"),
                     *[e.alias(n) for n, e in dims.items()],
                     F.col("cmp_no").cast("int").alias("CMPNO"), F.col("ag_no").cast("int").alias("AGNO"),
                     F.col("creative_no").cast("int").alias("CREATIVENO"),
                     "req_id", "log_type", "is_cpvc",
                     (F.col("_lp").try_cast("double") if older_price_rule else F.col("_lp").cast("double"))
                     .alias("price"), "_w", *grain)
    raw = _with_rate(raw, rates)
    lt, w, p = F.col("log_type"), F.col("_w"), F.col("price")
    keys = [raw.columns[0], "MEDIACD", *dims, "CMPNO", "AGNO", "CREATIVENO", "EXCHANGEWON", *grain]
    rid = F.col("req_id").isNotNull()
    out = distinct_flag_counts(
        raw, keys, "req_id",
        distinct_conds={"IMPS": lt == "i", "PAYMENTCNT": (lt != "e_i") & (F.col("is_cpvc") == "1"),
                        "Q1": lt == "v_firstQ", "Q2": lt == "v_mid", "Q3": lt == "v_thirdQ",
                        "Q4": lt == "v_complete"},
        row_sums={"CLICKS": F.when((lt == "c") & rid, w).otherwise(0),
                  # the older rule has no ELSE 0: PAYMENT is NULL for a group without impressions
                  "PAYMENT": (F.when(lt == "i", p * w) if older_price_rule
                              else F.when(lt == "i", p * w).otherwise(F.lit(0.0))),
                  "ERRORIMPS": F.when((lt == "e_i") & rid, w).otherwise(0),
                  "ERRORPAYMENT": F.when(lt == "e_i", p * w).otherwise(F.lit(0.0))})
    return _finish(out, keys, grain)


def summary_dedup(pb: DataFrame, grain: list[str] = HOUR, media: DataFrame | None = None,
                  rates: DataFrame | None = None, dims: dict[str, Column] | None = None) -> DataFrame:
    """R2 (and the APM part of R5): DISTINCT rows, then sums; error metrics are 0."""
    dims = dims or {}
    base = _ids_present(pb).where(F.col("req_id").isNotNull())
    # The media left join only duplicates rows, which DISTINCT removes again.
    raw = base.select(_label(grain), "req_id", F.col("cmp_no").cast("int").alias("CMPNO"),
                      F.col("ag_no").cast("int").alias("AGNO"),
                      F.col("creative_no").cast("int").alias("CREATIVENO"),
                      F.col("media_id").alias("MEDIACD"), *[e.alias(n) for n, e in dims.items()],
                      "log_type", "is_cpvc", "price", *grain).distinct()
    raw = _with_rate(raw, rates)
    lt = F.col("log_type")
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    keys = [raw.columns[0], "MEDIACD", *dims, "CMPNO", "AGNO", "CREATIVENO", "EXCHANGEWON", *grain]
    out = raw.groupBy(*keys).agg(
        one(lt == "i").alias("IMPS"), one(lt == "c").alias("CLICKS"),
        F.sum(F.when(F.col("is_cpvc") == "1", F.col("price").cast("double")).otherwise(0.0)).alias("PAYMENT"),
        F.sum(F.when(lt != "e_i", F.col("is_cpvc").cast("double")).otherwise(0.0)).alias("PAYMENTCNT"),
        one(lt == "v_firstQ").alias("Q1"), one(lt == "v_mid").alias("Q2"),
        one(lt == "v_thirdQ").alias("Q3"), one(lt == "v_complete").alias("Q4"),
        F.lit(0).cast("bigint").alias("ERRORIMPS"), F.lit(0.0).alias("ERRORPAYMENT"))
    return _finish(out, keys, grain)


def _finish(df: DataFrame, keys: list[str], grain: list[str]) -> DataFrame:
    """Fix the column order/types so the feeds union by name."""
    lead = [k for k in keys if k not in grain]
    return df.select(*lead, F.col("IMPS").cast("bigint").alias("IMPS"),
                     F.col("CLICKS").cast("bigint").alias("CLICKS"),
                     F.col("PAYMENT").cast("double").alias("PAYMENT"),
                     F.col("PAYMENTCNT").cast("double").alias("PAYMENTCNT"),
                     *[F.col(q).cast("bigint").alias(q) for q in ("Q1", "Q2", "Q3", "Q4")],
                     F.col("ERRORIMPS").cast("bigint").alias("ERRORIMPS"),
                     F.col("ERRORPAYMENT").cast("double").alias("ERRORPAYMENT"), *grain)


def summary_hour(abi: DataFrame, apm: DataFrame, nhn: DataFrame, media: DataFrame | None = None,
                 rates: DataFrame | None = None) -> DataFrame:
    """ABI (lookup) + APM (dedup) + NHN (lookup), bound by name."""
    parts = [summary_lookup(abi, HOUR, media, rates), summary_dedup(apm, HOUR, media, rates),
             summary_lookup(nhn, HOUR, media, rates)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def summary_daily(abi: DataFrame, apm: DataFrame, nhn: DataFrame, rules: DailyRules, media: DataFrame | None = None,
                  rates: DataFrame | None = None, area: DataFrame | None = None) -> DataFrame:
    """Day grain plus INVENTORYNM (N10) and AREACD (N11), one rule set per feed."""
    abi_dims = {"INVENTORYNM": F.when(F.col("g_targetid") == rules.target_id, F.col("app_bundle")).otherwise(""),
                "AREACD": F.when(F.col("areacd").isNotNull(), F.col("areacd")).otherwise("-1")}
    apm_dims = {"AREACD": F.when(F.col("media_id") != rules.area_media, F.lit(""))
                .when(F.col("area_cd") == "undefined", F.lit("-1")).otherwise(F.col("area_cd")),
                "INVENTORYNM": F.when(F.col("media_id").isin(*rules.app_media), F.col("app_id"))
                .when(F.col("media_id") == rules.test_media, F.lit("test")).otherwise(F.lit(""))}
    nhn_dims = {"INVENTORYNM": F.lit(""), "AREACD": area_code("area_cd", ("", "-99"))}
    parts = [summary_lookup(abi, DAY, media, rates, abi_dims, area=area),
             summary_dedup(apm, DAY, media, rates, apm_dims),
             summary_lookup(nhn, DAY, media, rates, nhn_dims)]
    cols = parts[0].columns
    return parts[0].unionByName(parts[1].select(*cols)).unionByName(parts[2].select(*cols))
