"""Unique-reach reports (R6 ad group, R7 campaign) for one report date.

Cumulative k+ reach ("devices with at least k completed views since the
earliest flight start") is counted per device and compared with k -- the same
number the reference gets from ROW_NUMBER ranks, without a sort per device.
What the earlier days of the flight already reported (the job's own prior
output, or ``reach_reported``, which computes them all in one job) is subtracted.  The flight window comes from a scalar subquery, so the history
scan is pruned to [earliest start, report date].
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_bounded
from .rules import ReachRules


def _inventory(rules: ReachRules):
    e = F
    for ag, name in rules.group_inventory.items():
        e = e.when(F.col("ag_no") == ag, name)
    return (e.when(F.col("media_id").isin(*rules.app_media), F.col("app_id"))
            .when(F.col("media_id") == rules.test_media, F.lit("test")).otherwise(F.lit(None).cast("string")))


def _day():
    return F.concat(F.col("year"), F.lit("-"), F.col("month"), F.lit("-"), F.col("day"))


def _d(c):
    return F.date_format(F.to_timestamp(F.col(c)), "yyyy-MM-dd")


def _feeds(apm: DataFrame, abi: DataFrame, media: tuple[str, ...], cols: list[str]) -> DataFrame:
    abi_ctv = F.col("ctv_media").isNotNull() & (F.col("ctv_media") != "")
    return (apm.where(F.col("media_id").isin(*media)).select(_day().alias("_d"), *cols)
            .unionByName(abi.where(abi_ctv).select(_day().alias("_d"), *cols)))


def reach_reported(apm: DataFrame, abi: DataFrame, flights: DataFrame, input_date: str, rules: ReachRules,
                   grain: str = "ag") -> DataFrame:
    """What the daily runs from each flight's start to the day before ``input_date`` reported,
    one row for each flight running on ``input_date`` and day (its rows of the day together),
    in one job: the prior table of ``reach_daily``.  A flight key has one flight.

    A day's views count from the earliest start of the flights that run on that day, so days
    with the same earliest start share one pass over each device's views.  A row reports the
    cumulative reach less all that was reported before; with N rows a day the day's total is
    sum(cumulative) - N * before, which is folded day by day."""
    ag = grain == "ag"
    fkey, pkey, name = ("agno", "ag_no", "AGNO") if ag else ("cmpno", "cmp_no", "CMPNO")
    keys = ["cmp_no", "ag_no"] if ag else ["cmp_no"]
    fl = flights.where(F.col("logparsefg") == "Y") if ag else flights
    fl = fl.select(F.col(fkey).alias(pkey), _d("startdt").alias("_s"), _d("enddt").alias("_e"))
    running = fl.where(F.lit(input_date).between(F.col("_s"), F.col("_e")))
    last = F.date_sub(F.to_date(F.lit(input_date)), 1)
    days = (running.agg(F.to_date(F.min("_s")).alias("_s")).where(F.col("_s") <= last)
            .select(F.explode(F.sequence("_s", last)).alias("_d")).select(F.date_format("_d", "yyyy-MM-dd").alias("_d")))
    since = (days.join(broadcast_if_bounded(fl), F.col("_d").between(F.col("_s"), F.col("_e")))
             .groupBy("_d").agg(F.min("_s").alias("_from")))       # one row a day
    spans = since.groupBy("_from").agg(F.max("_d").alias("_to"))
    flight = broadcast_if_bounded(running.select(pkey, "_s"))
    yesterday = F.date_format(last, "yyyy-MM-dd")
    views = (_feeds(apm, abi, rules.media, ["cmp_no", "ag_no", "log_type", "ifa"])
             .where((F.col("log_type") == "v_complete") & F.col("ifa").isNotNull()
                    & (F.col("_d") >= F.lit(spans.agg(F.min("_from")).scalar())) & (F.col("_d") <= yesterday))
             .join(flight.select(pkey), pkey)
             .groupBy(*keys, "ifa", "_d").agg(F.count(F.lit(1)).alias("_n"))
             .join(F.broadcast(spans), F.col("_d").between(F.col("_from"), F.col("_to")))
             .withColumn("_after", F.sum("_n").over(Window.partitionBy("_from", *keys, "ifa").orderBy("_d"))))
    gained = views.groupBy("_from", *keys, F.col("_d").alias("_v")).agg(*[
        F.count(F.when((F.col("_after") >= k) & (F.col("_after") - F.col("_n") < k), 1)).alias(f"_new{k}") for k in (1, 2, 3)])
    rows = (_feeds(apm, abi, (rules.daily_media,), ["cmp_no", "ag_no", "media_id", "app_id"])
            .withColumn("_inv", _inventory(rules) if ag else F.lit(None).cast("string")).join(flight, pkey)
            .where(F.col("_d").between(F.col("_s"), yesterday)).select("_d", *keys, "_inv").distinct()
            .groupBy("_d", *keys).agg(F.count(F.lit(1)).alias("_rows")).join(F.broadcast(since), "_d"))
    cumulative = (rows.join(gained, ["_from", *keys]).where(F.col("_v") <= F.col("_d"))
                  .groupBy("_d", *keys, "_rows").agg(*[F.sum(f"_new{k}").alias(f"_cum{k}") for k in (1, 2, 3)]))
    big = "decimal(38,0)"
    daily = cumulative.groupBy(pkey, "_d").agg(F.sum("_rows").cast(big).alias("n"), *[
        F.sum(F.col("_rows") * F.col(f"_cum{k}")).cast(big).alias(f"c{k}") for k in (1, 2, 3)])
    start = ", ".join(f"cast(0 as {big}) as s{k}" for k in (1, 2, 3))
    step = ", ".join(f"cast(acc.s{k} + x.c{k} - x.n * acc.s{k} as {big}) as s{k}" for k in (1, 2, 3))
    day = ", ".join(f"cast(x.c{k} - x.n * acc.s{k} as {big}) as REACH{k}" for k in (1, 2, 3))
    fold = (f"aggregate(days, named_struct('acc', struct({start}), 'out', cast(array() as array<struct<DATE:string,"
            + ",".join(f"REACH{k}:{big}" for k in (1, 2, 3)) + ">>)), (z, x) -> named_struct("
            f"'acc', struct({step.replace('acc.', 'z.acc.')}), 'out', concat(z.out, array(struct(x._d as DATE, {day.replace('acc.', 'z.acc.')})))), z -> z.out)")
    return (daily.groupBy(pkey).agg(F.sort_array(F.collect_list(F.struct("_d", "n", "c1", "c2", "c3"))).alias("days"))  # a row a day
            .select(F.col(pkey).alias(name), F.expr(f"inline({fold})")))


def reach_daily(apm: DataFrame, abi: DataFrame, flights: DataFrame, input_date: str, rules: ReachRules,
                grain: str = "ag", prior: DataFrame | None = None) -> DataFrame:
    """R6 (``grain='ag'``, flights = ad groups with logparsefg) / R7 (``'cmp'``,
    flights = campaigns) for ``input_date`` ('yyyy-MM-dd')."""
    ag = grain == "ag"
    fkey = "agno" if ag else "cmpno"
    pkey = "ag_no" if ag else "cmp_no"
    fl = flights.where(F.lit(input_date).between(_d("startdt"), _d("enddt")))
    if ag:
        fl = fl.where(F.col("logparsefg") == "Y")
    fl = broadcast_if_bounded(fl.select(fkey, "startdt"))
    min_start = F.date_format(F.to_timestamp(fl.agg(F.min("startdt")).scalar()), "yyyy-MM-dd")
    abi_ctv = F.col("ctv_media").isNotNull() & (F.col("ctv_media") != "")
    cols = ["cmp_no", "ag_no", "log_type", "ifa", "media_id", "app_id"]
    hist = (apm.where(F.col("media_id").isin(*rules.media)).select(_day().alias("_d"), *cols)
            .unionByName(abi.where(abi_ctv).select(_day().alias("_d"), *cols))
            .where((F.col("_d") >= min_start) & (F.col("_d") <= input_date))
            .join(fl.select(F.col(fkey).alias(pkey)), pkey))
    keys = ["cmp_no", "ag_no"] if ag else ["cmp_no"]
    views = (hist.where((F.col("log_type") == "v_complete") & F.col("ifa").isNotNull())
             .groupBy(*keys, "ifa").agg(F.count(F.lit(1)).alias("_n")))
    cum = views.groupBy(*keys).agg(*[F.sum(F.when(F.col("_n") >= k, 1).otherwise(0)).cast("bigint")
                                     .alias(f"_cum{k}") for k in (1, 2, 3)])
    y, m, dd = input_date.split("-")
    today = (apm.where(F.col("media_id") == rules.daily_media).select(*cols, "year", "month", "day")
             .unionByName(abi.where(abi_ctv).select(*cols, "year", "month", "day"))
             .where((F.col("year") == y) & (F.col("month") == m) & (F.col("day") == dd)))
    dkeys = keys + (["_inv"] if ag else [])
    daily = (today.withColumn("_inv", _inventory(rules)).groupBy(*dkeys).agg(
        F.count(F.when(F.col("log_type") == "i", 1)).alias("impressions"),
        F.count(F.when(F.col("log_type") == "v_complete", 1)).alias("views"),
        F.count_distinct(F.when(F.col("log_type") == "v_complete", F.col("ifa"))).alias("unique_reach")))
    out = daily.join(cum, keys)
    if prior is not None:
        pk = "AGNO" if ag else "CMPNO"
        since = fl.select(F.col(fkey).alias("_k"), _d("startdt").alias("_s"))
        yesterday = F.date_format(F.date_sub(F.to_date(F.lit(input_date)), 1), "yyyy-MM-dd")
        psum = (prior.join(since, F.col(pk) == F.col("_k"))
                .where((F.col("DATE") >= F.col("_s")) & (F.col("DATE") <= yesterday))
                .groupBy(F.col("_k")).agg(*[F.coalesce(F.sum(f"REACH{k}"), F.lit(0)).alias(f"_sum{k}")
                                            for k in (1, 2, 3)]))
        out = out.join(psum, F.col(pkey) == F.col("_k"), "left")
    else:
        out = out.select("*", *[F.lit(None).cast("bigint").alias(f"_sum{k}") for k in (1, 2, 3)])
    lead = [F.lit(input_date).alias("DATE"), F.col("cmp_no").alias("CMPNO")]
    if ag:
        lead.append(F.col("ag_no").alias("AGNO"))
    body = [F.coalesce("unique_reach", F.lit(0)).alias("UNIQUEREACH")]
    if ag:
        body.append(F.lit("").alias("INVENTORYNM"))
    body.append(F.coalesce(F.col("views").cast("double") / F.nullif(F.col("unique_reach"), F.lit(0)),
                           F.lit(0.0)).alias("DAILYFREQUENCY"))
    body += [(F.col(f"_cum{k}") - F.coalesce(F.col(f"_sum{k}"), F.lit(0))).cast("bigint").alias(f"REACH{k}")
             for k in (1, 2, 3)]
    return out.select(*lead, *body, F.lit(y).alias("year"), F.lit(m).alias("month"), F.lit(dd).alias("day"))
