import datetime as dt
import hashlib
import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from adpulse.plans import summary, weather
from adpulse.sources import fixtures as fx
from adpulse.sources import weather_fx as wfx
from adpulse.streaming import alerts as alert_stream
from adpulse.streaming import hourly, jobs
from tests.conftest import SF_SMALL

HF = jobs.ALERT_HASH_FIELDS
ACOLS = ("areaCode string, warnVar string, command string, cancel string, tmFc string, tmSeq string, "
         "stnId string, warnStress string, fetched_at timestamp")


def test_alert_hash_matches_python_json(spark):
    row = ("L1", "2", "1", None, "2024010100", "0", "108", "1", dt.datetime(2024, 1, 1))
    got = spark.createDataFrame([row], ACOLS).select(jobs.alert_hash()).first()[0]
    item = dict(zip(["areaCode", "warnVar", "command", "cancel", "tmFc", "tmSeq", "stnId", "warnStress"], row))
    want = hashlib.sha256(json.dumps({k: item.get(k) for k in HF}, sort_keys=True,
                                     ensure_ascii=False).encode()).hexdigest()
    assert got == want


def test_dedup_alerts_matches_replay(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(300):
        t = base + dt.timedelta(days=rnd.randint(0, 40), hours=rnd.randint(0, 7) * 3)
        rows.append((f"L{rnd.randint(0, 2)}", str(rnd.randint(1, 2)), "1", "0", "2024010100", "0", "108", "0", t))
    df = spark.createDataFrame(rows, ACOLS)
    got = sorted((r["areaCode"], r["warnVar"], r["fetched_at"]) for r in weather.dedup_alerts(df).collect())
    seen, want = {}, []
    for t in sorted({r[-1] for r in rows}):            # one run: check, note, then forget
        for key in sorted({(r[0], r[1]) for r in rows if r[-1] == t}):
            if key not in seen:
                want.append((*key, t))
                seen[key] = t.date()
        seen = {k: d for k, d in seen.items() if d >= t.date() - dt.timedelta(days=8)}
    assert got == sorted(want)


def test_alert_is_stored_again_only_after_the_run_that_forgets_it(spark):
    at = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 10, 0), dt.datetime(2024, 1, 10, 3)]
    rows = [("L1", "1", "1", "0", "x", "0", "108", "0", t) for t in at]
    got = sorted(r["fetched_at"] for r in weather.dedup_alerts(spark.createDataFrame(rows, ACOLS)).collect())
    assert got == [at[0], at[2]]                       # the first run of day 10 still knows it


def test_forecast_parity_zero_temperature(spark):
    items = spark.createDataFrame(
        [(1, "20240101", "00", 1, "20240101", "0600", "TMP", "0"), (1, "20240101", "00", 2, "20240101", "0600", "REH", "0"),
         (1, "20240101", "00", 3, "20240101", "0600", "SKY", "0"), (1, "20240101", "00", 4, "20240101", "0600", "PTY", "3")],
        "region_id int, dt string, hr string, seq bigint, fcstDate string, fcstTime string, category string, "
        "fcstValue string")
    p = weather.classify_forecast(items, parity=True).first()
    assert (p["tmp"], p["reh"], p["sky"], p["weather_code"]) == (20.0, 50.0, 1, "B001_001_004")
    q = weather.classify_forecast(items, parity=False).first()
    assert (q["tmp"], q["reh"], q["sky"]) == (0.0, 0.0, 0)
    assert p["tmn"] is None


def test_pm10_gap(spark):
    df = spark.createDataFrame([(30.5,), (30.0,), (31.0,)], "v double")
    assert [r[0] for r in df.select(weather.pm10_code(F.col("v"), True)).collect()] == [
        "B001_003_004", "B001_003_001", "B001_003_002"]
    assert [r[0] for r in df.select(weather.pm10_code(F.col("v"), False)).collect()] == [
        "B001_003_001", "B001_003_001", "B001_003_002"]


def test_alert_cancel_and_lift_rules(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("L1", "1", "1", "0", "2024010100", "0", "108", "0", t),
            ("L1", "1", "1", "1", "2024010100", "0", "108", "0", t + dt.timedelta(hours=1)),   # newest version cancelled
            ("L2", "2", "1", None, "2024010100", "0", "108", "0", t),                           # NULL cancel dropped
            ("L3", "3", "2", "0", "2024010200", "0", "108", "0", t),                            # lifted in L3
            ("L4", "3", "1", "0", "2024010200", "0", "108", "0", t)]                            # active in L4
    regions = spark.createDataFrame([(1, "11", "st", "RC1", "L3"), (1, "11", "st", "RC1", "L4"),
                                     (2, "12", "st", "RC2", "L1"), (3, "13", "st", "RC3", "L2")],
                                    "id int, adm_code string, rep_station string, region_code string, areaCode string")
    got = sorted(tuple(r) for r in weather.active_alerts(spark.createDataFrame(rows, ACOLS), regions).collect())
    assert got == [("RC1", "B001_005_002")]


def run_stream(spark, make, parts):
    """Feed the parts one file after the other through a stream; the rows it wrote."""
    src, out = tempfile.mkdtemp(prefix="adpulse-stream-src-"), tempfile.mkdtemp(prefix="adpulse-stream-out-")
    for k, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(os.path.join(src, f"f{k}"))
        q = (make(jobs.file_stream(spark, os.path.join(src, "*"), parts[0].schema, max_files_per_trigger=1)).writeStream.format("parquet")
             .option("path", os.path.join(out, "data")).option("checkpointLocation", os.path.join(out, "ckpt"))
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination(300)
    return spark.read.parquet(os.path.join(out, "data"))


def test_streaming_hourly_counts_equal_batch(spark):
    pb = fx.fx_postback(spark, SF_SMALL)
    day = pb.orderBy("created_at")
    cut = [r[0] for r in pb.select(F.substring("created_at", 1, 10)).distinct().orderBy(1).collect()]
    parts = [day.where(F.substring("created_at", 1, 10).between(cut[i], cut[min(i + 9, len(cut) - 1)])) for i in range(0, len(cut), 10)]
    late = parts[0].limit(5).withColumn("req_id", F.lit("late-request"))
    got = run_stream(spark, lambda s: jobs.hourly_request_counts(s, "1 hour"), [*parts, late])
    batch = jobs.hourly_request_counts_batch(pb)
    last = batch.agg(F.max("hour_start")).first()[0]
    closed = batch.where(F.col("hour_start") < F.lit(last) - F.expr("interval 2 hours"))
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert len(rows) > 500
    assert set(map(tuple, closed.collect())) <= set(rows) <= set(map(tuple, batch.collect()))   # the late rows added nothing


def replay(rows, retention=8):
    """The runs one after the other: store what is unknown, note the day, then forget."""
    seen, kept = {}, []
    for t in sorted({r[-1] for r in rows}):
        for key in sorted({r[:-1] for r in rows if r[-1] == t}):
            if key not in seen:
                kept.append((*key, t))
                seen[key] = t.date()
        seen = {k: d for k, d in seen.items() if d >= t.date() - dt.timedelta(days=retention)}
    return kept


def test_alert_stream_follows_the_runs(spark):
    """One file a run; the stream is started anew twice on the way."""
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1, 3)
    times = sorted({base + dt.timedelta(days=d, hours=h) for d in (0, 1, 5, 8, 9, 9, 10, 18, 19, 30) for h in rnd.sample((0, 3, 6), 2)})
    runs = [[(f"L{k}", "1", "1", "0", "x", "0", "108", "0", t) for k in sorted(rnd.sample(range(5), 3))] * rnd.randint(1, 2) for t in times]
    src, out = tempfile.mkdtemp(prefix="adpulse-runs-"), tempfile.mkdtemp(prefix="adpulse-alerts-")
    shuffle = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for k, run in enumerate(runs):
            spark.createDataFrame(run, ACOLS).coalesce(1).write.parquet(os.path.join(src, f"r{k:02d}"))
            if k in (6, 11, len(runs) - 1):
                q = (alert_stream.dedup_alert_runs(jobs.file_stream(spark, os.path.join(src, "*"), spark.createDataFrame(run, ACOLS).schema, max_files_per_trigger=1))
                     .writeStream.format("parquet").option("path", os.path.join(out, "data")).option("checkpointLocation", os.path.join(out, "ckpt"))
                     .outputMode("append").trigger(availableNow=True).start())
                q.awaitTermination(300)
                assert q.exception() is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    names = [c.split()[0] for c in ACOLS.split(", ")]
    got = sorted(tuple(r[c] for c in names) for r in spark.read.parquet(os.path.join(out, "data")).collect())
    rows = [r for run in runs for r in run]
    assert got == sorted(replay(rows)) and len(got) > len({r[:-1] for r in rows})
    batch = weather.dedup_alerts(spark.createDataFrame(rows, ACOLS))
    assert got == sorted(tuple(r[c] for c in names) for r in batch.collect())


def test_hourly_figures_of_the_stream_equal_the_report(spark):
    """Three landings with a restart between them and late rows in the last: the closed hours'
    figures are those of the batch report, and no state is left of them."""
    pb = fx.fx_postback(spark, SF_SMALL)
    first, last = pb.agg(F.min("created_at"), F.max("created_at")).first()
    days = [r[0] for r in pb.select(F.substring("created_at", 1, 10)).distinct().orderBy(1).collect()]
    cuts = [days[len(days) // 3], days[2 * len(days) // 3], "9999"]
    src, out = tempfile.mkdtemp(prefix="adpulse-hours-"), tempfile.mkdtemp(prefix="adpulse-hours-out-")
    media = spark.createDataFrame([("EXCHANGE1", "Y"), ("EXCHANGE1", "Y"), ("M4", "N")], "mediacd string, logparsefg string")
    low = ""
    for k, cut in enumerate(cuts):
        part = pb.where((F.col("created_at") >= low) & (F.col("created_at") < cut))
        if k == 2:          # rows of the first day, long put out
            part = part.unionByName(pb.where(F.col("created_at") < cuts[0]).limit(7).withColumn("creative_no", F.lit(77).cast("long")))
        part.coalesce(1).write.parquet(os.path.join(src, f"p{k}"))
        low = cut
        q = (hourly.hourly_summary(jobs.file_stream(spark, os.path.join(src, "*"), pb.schema), media, fx.fx_rate(spark, SF_SMALL))
             .writeStream.format("parquet").option("path", os.path.join(out, "data")).option("checkpointLocation", os.path.join(out, "ckpt"))
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(out, "data"))
    batch = summary.summary_lookup(pb, summary.HOUR, media, fx.fx_rate(spark, SF_SMALL))
    mark = dt.datetime.strptime(last, "%Y-%m-%dT%H:%M:%SZ") - dt.timedelta(hours=2)
    closed = batch.where(F.to_timestamp("DATETIME") <= F.lit(mark))
    assert got.columns == batch.columns and [f.dataType for f in got.schema] == [f.dataType for f in batch.schema]

    def rows(df):
        return sorted(repr([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())
    assert rows(got) == rows(closed) and got.count() > 300
    # What is left in the state is of the last open hours only: a few rows of two hours.
    left = [s["numRowsTotal"] for s in q.lastProgress["stateOperators"]]
    opened = pb.where(F.col("created_at") >= (mark - dt.timedelta(hours=1)).strftime("%Y-%m-%dT%H:%M:%SZ")).count()
    assert max(left) <= opened and first < last


def test_alert_stream_drops_repeats_within_retention(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("L1", "1", "1", "0", "x", "0", "108", "0", t + dt.timedelta(hours=h)) for h in (0, 3, 6)]
    other = [("L2", "1", "1", "0", "x", "0", "108", "0", t + dt.timedelta(hours=9))]
    got = run_stream(spark, jobs.dedup_alert_stream, [spark.createDataFrame(r, ACOLS) for r in (rows[:1], rows[1:], other)])
    assert sorted((r.areaCode, r.fetched_at) for r in got.collect()) == [("L1", t), ("L2", t + dt.timedelta(hours=9))]


def weekly_rows(spark, week):
    return spark.createDataFrame([("MAPPING", "box", f"ad{k}", "1.1.1.1", "KT", "NHN", dt.datetime(2024, 1, week), dt.datetime(2024, 1, week),
                                   dt.datetime(2024, 1, week), dt.datetime(2024, 1, week), 1, 1, 2, ["APM"], f"2024-01-{week:02d}") for k in (1, week)],
                                 "record_type string, plattform_id string, ad_id string, ip string, carrier string, cate string, "
                                 "stb_first_seen_at timestamp, stb_last_seen_at timestamp, mobile_first_seen_at timestamp, "
                                 "mobile_last_seen_at timestamp, stb_observation_count bigint, mobile_observation_count bigint, "
                                 "ip_adid_cardinality bigint, stb_sources array<string>, batch_week string")


def test_state_goes_on_after_a_restart_and_a_retry(spark):
    state = tempfile.mkdtemp(prefix="adpulse-state-") + "/s"
    merge = jobs.merge_batches_into_state(state)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "first")
    merge(weekly_rows(spark, 2), 0)
    merge(weekly_rows(spark, 8), 1)
    merge(weekly_rows(spark, 8), 1)                    # a retried batch replaces its own version
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "second")
    merge(weekly_rows(spark, 15), 0)                   # a fresh checkpoint starts at batch 0
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    got = {r.ad_id: (r.stb_observation_count, r.last_batch_week) for r in jobs.read_state(spark, state).collect()}
    assert got == {"ad1": (3, "2024-01-15"), "ad2": (1, "2024-01-02"), "ad8": (1, "2024-01-08"), "ad15": (1, "2024-01-15")}
    assert len([d for d in os.listdir(state) if d.startswith("v")]) == 2


def test_unreadable_state_is_an_error_not_a_new_start(spark):
    state = tempfile.mkdtemp(prefix="adpulse-state-") + "/s"
    jobs.merge_batches_into_state(state)(weekly_rows(spark, 2), 0)
    folder = os.path.join(state, os.listdir(state)[0])
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            with open(os.path.join(folder, f), "wb") as out:
                out.write(b"broken")
    with pytest.raises(Exception):
        jobs.merge_batches_into_state(state)(weekly_rows(spark, 8), 1)


def test_incremental_extract(spark):
    df = spark.createDataFrame([(1,), (5,), (9,)], "campaign_no int")
    new, mark = jobs.incremental_extract(df, "campaign_no", 5)
    assert [r[0] for r in new.collect()] == [9] and mark.first()[0] == 9
    new2, mark2 = jobs.incremental_extract(df, "campaign_no", 9)
    assert new2.count() == 0 and mark2.first()[0] == 9


def test_weather_fixture_pipeline_runs(spark):
    regions = wfx.fx_regions(spark, SF_SMALL)
    codes = weather.weather_codes(weather.classify_forecast(wfx.fx_fcst(spark, SF_SMALL)),
                                  weather.classify_dust(wfx.fx_dust(spark, SF_SMALL), regions),
                                  weather.classify_uv(wfx.fx_uv(spark, SF_SMALL)), wfx.fx_alert(spark, SF_SMALL),
                                  regions, "2024-01-30")
    assert codes.count() > 0
