"""

1. conditional distinct counts: Catalyst's Expand plan vs pre-aggregated flags
2. month-range theta join: nested-loop join vs exploded months + equi-join
3. backfill: one range job vs a day loop

Usage: python tools/compare_strategies.py [sf_dir]   (prints one JSON line)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from adpulse.operators.aggregates import distinct_flag_counts  # noqa: E402
from adpulse.plans import attribution as attr  # noqa: E402
from adpulse.plans import backfill, reports  # noqa: E402
from adpulse.session import get_session  # noqa: E402
from adpulse.sources import fixtures as fx  # noqa: E402


def timed(df, reps=2):
    df.write.format("noop").mode("overwrite").save()
    best = None
    for _ in range(reps):
        t = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        el = time.perf_counter() - t
        best = el if best is None else min(best, el)
    return round(best, 3)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_session()
    out = {"sf": os.path.basename(sf.rstrip("/"))}
    pb = fx.fx_postback(spark, sf).where(F.col("cmp_no").isNotNull())
    keys = ["year", "month", "day", "hour", "cmp_no", "ag_no", "creative_no", "media_id"]
    lt = F.col("log_type")
    conds = {"IMPS": lt == "i", "PAYMENTCNT": (lt != "e_i") & (F.col("is_cpvc") == "1"), "Q1": lt == "v_firstQ",
             "Q2": lt == "v_mid", "Q3": lt == "v_thirdQ", "Q4": lt == "v_complete"}
    expand = pb.groupBy(*keys).agg(*[F.count_distinct(F.when(c, F.col("req_id"))).alias(n) for n, c in conds.items()])
    flags = distinct_flag_counts(pb, keys, "req_id", conds)
    out["distinct_expand_sec"] = timed(expand)
    out["distinct_flags_sec"] = timed(flags)

    views = attr.completed_views(pb, None, None, "ifa")
    skb = fx.fx_skb(spark, sf)
    starts = views.groupBy("cmp_no").agg(F.min("post_datetime").alias("_s")).select(
        "cmp_no", F.date_format(F.add_months(F.trunc(F.col("_s").cast("date"), "month"), -5), "yyyyMM")
        .cast("int").alias("lo"), F.date_format(F.col("_s"), "yyyyMM").cast("int").alias("hi"))
    ym = F.concat("year", F.lpad("month", 2, "0")).cast("int")
    theta = skb.withColumn("ym", ym).join(F.broadcast(starts), F.col("ym").between(F.col("lo"), F.col("hi")))
    months = starts.select("cmp_no", F.explode(F.sequence(F.to_date(F.col("lo").cast("string"), "yyyyMM"),
                                                          F.to_date(F.col("hi").cast("string"), "yyyyMM"),
                                                          F.expr("interval 1 month"))).alias("m"))
    months = months.select("cmp_no", F.date_format("m", "yyyyMM").cast("int").alias("ym"))
    explode = skb.withColumn("ym", ym).join(F.broadcast(months), "ym")
    out["theta_nested_loop_sec"] = timed(theta.select("cmp_no", "ad_id"))
    out["theta_month_explode_sec"] = timed(explode.select("cmp_no", "ad_id"))

    inputs = dict(postback=fx.fx_postback(spark, sf), gtm=fx.fx_gtm(spark, sf), info=fx.fx_info(spark, sf),
                  visits=fx.fx_visit(spark, sf), skb=skb, tg=fx.fx_tg(spark, sf))

    def job(s, e):
        return reports.report_web(attr.attribute_v1(**inputs, start=s, end=e), s, e)
    root = tempfile.mkdtemp(prefix="adpulse-backfill-")
    t = time.perf_counter()
    backfill.backfill_range(job, "2024-01-01", "2024-01-30", os.path.join(root, "range"))
    out["backfill_range_30d_sec"] = round(time.perf_counter() - t, 3)
    t = time.perf_counter()
    backfill.backfill_by_day(job, "2024-01-01", "2024-01-30", os.path.join(root, "loop"))
    out["backfill_day_loop_30d_sec"] = round(time.perf_counter() - t, 3)
    a = spark.read.parquet(os.path.join(root, "range"))
    b = spark.read.parquet(os.path.join(root, "loop"))
    out["backfill_same_rows"] = a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
