"""Published, synced, partitioned and admitted tables."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from adpulse import stored_queries
from adpulse.operators.joins import BROADCAST_MAX_BYTES, broadcast_if_bounded, plan_size_bytes
from adpulse.plans import flatten, quality
from adpulse.sinks import publish, sync, versions
from adpulse.sources import bidlog
from adpulse.sources import fixtures as fx
from adpulse.streaming import admission, jobs
from tests.conftest import SF_SMALL

FAMILIES = [publish.Family(("own",), "mediacd"), publish.Family(("customer",), "mediacd", among=True)]
ROWS = "date string, mediacd string, imps long, year string, month string, day string"


def folder(name):
    return os.path.join(tempfile.mkdtemp(prefix=f"adpulse-{name}-"), "t")


def report(spark, rows):
    return spark.createDataFrame([(d, m, n, *d.split("-")) for d, m, n in rows], ROWS)


@pytest.mark.parametrize("table,kept", [("own_daily", {("2024-01-02", "LIST", 2), ("2024-01-02", None, 3)}),
                                        ("customer_daily", {("2024-01-02", "x", 1), ("2024-01-02", None, 3)}), ("other_daily", set())])
def test_publish_replaces_the_scope_by_family(spark, table, kept):
    root = folder("serving")
    codes = spark.createDataFrame([("LIST",)], "code string")
    old = [("2024-01-01", "x", 9), ("2024-01-02", "x", 1), ("2024-01-02", "LIST", 2), ("2024-01-02", None, 3)]
    publish.publish(report(spark, old), root, table, F.lit(True), FAMILIES)
    got = publish.publish(report(spark, [("2024-01-02", "x", 50)]), root, table, "day = '2024-01-02'", FAMILIES, codes)
    want = {("2024-01-01", "x", 9), ("2024-01-02", "x", 50)} | kept
    assert {(r.day, r.mediacd, r.imps) for r in got.collect()} == want and got.columns == ["mediacd", "imps", "day"]
    again = publish.publish(report(spark, [("2024-01-02", "x", 50)]), root, table, "day = '2024-01-02'", FAMILIES, codes)
    if not kept:
        assert {(r.day, r.mediacd, r.imps) for r in again.collect()} == want         # a rerun changes nothing


def test_a_publish_that_dies_is_not_seen(spark):
    root = folder("serving")
    publish.publish(report(spark, [("2024-01-01", "x", 1)]), root, "t_daily", F.lit(True))
    open_reader = publish.read_published(spark, root)
    half = versions.write(report(spark, [("2024-01-01", "y", 2)]).limit(0), root, 1)
    os.remove(os.path.join(half, "_SUCCESS"))                          # died before it was complete
    assert [r.mediacd for r in publish.read_published(spark, root).collect()] == ["x"]
    for n in (3, 4):
        publish.publish(report(spark, [("2024-01-01", "z", n)]), root, "t_daily", "day = '2024-01-01'")
        if n == 3:
            assert [r.imps for r in open_reader.collect()] == [1]      # a reader of the version before goes on
    assert [r.imps for r in publish.read_published(spark, root).collect()] == [4]
    assert [n for n, _ in versions.complete(spark, root)] == [1, 2]


def test_sync_survives_a_crash_between_rows_and_mark(spark):
    root = folder("sync")
    rows = lambda n: spark.createDataFrame([(k, f"v{k}") for k in range(1, n + 1)], "id long, v string")
    assert sync.run(rows(3), root, "id") == {"batch": 1, "rows": 3, "mark": "3"}

    def crash():
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        sync.run(rows(5), root, "id", before_mark=crash)
    assert sync.synced(spark, root).count() == 3                       # its rows do not count yet
    assert sync.run(rows(6), root, "id") == {"batch": 2, "rows": 3, "mark": "6"}
    assert sync.run(rows(6), root, "id") == {"batch": 2, "rows": 0, "mark": "6"}
    assert sorted(r.id for r in sync.synced(spark, root).collect()) == [1, 2, 3, 4, 5, 6]
    assert sorted(r.id for r in sync.synced(spark, root, 2).collect()) == [4, 5, 6]


def test_sync_of_times_and_null_marks(spark):
    root, t = folder("sync"), dt.datetime(2024, 1, 1, 5, 6, 7, 890)
    rows = spark.createDataFrame([(1, t), (2, None)], "id long, at timestamp")
    assert sync.run(rows, root, "at")["rows"] == 2
    more = spark.createDataFrame([(1, t), (2, None), (3, t + dt.timedelta(microseconds=1))], "id long, at timestamp")
    assert sync.run(more, root, "at")["rows"] == 1
    assert sync.stored_mark(spark, folder("none")) == (0, None) and sync.synced(spark, folder("none")) is None


def test_days_named_at_run_time_prune_the_folders(spark):
    root = folder("days")
    got = stored_queries.partitioned_days(spark, SF_SMALL, root)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = stored_queries.partitioned_days(spark, SF_SMALL, folder("days"))
        n = got.count()
        plan = got._jdf.queryExecution().executedPlan()
        assert "dynamicpruning" in plan.toString()
        got.collect()
        leaves = plan.collectLeaves()
        read = [leaves.apply(i).metrics().get("numPartitions").get().value() for i in range(leaves.size())
                if "FileScan" in leaves.apply(i).toString() and leaves.apply(i).metrics().contains("numPartitions")]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    written = sum(f.startswith("day=") for _, dirs, _ in os.walk(root) for f in dirs)
    assert n and n == max(read) < written, (n, read, written)


def test_broadcast_follows_the_size(spark):
    small, large = spark.range(1000).withColumnRenamed("id", "k"), spark.range(1 << 26).withColumnRenamed("id", "k")
    assert plan_size_bytes(small) <= 8000 < BROADCAST_MAX_BYTES < plan_size_bytes(large)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lambda d: large.join(broadcast_if_bounded(d), "k")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in joined(small) and "BroadcastHashJoin" not in joined(large.withColumn("x", F.lit(1)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_completeness_lists_hours_without_files(spark):
    root = tempfile.mkdtemp(prefix="adpulse-landing-")
    for hour, n in (("00", 3), ("01", 1), ("03", 2)):
        d = os.path.join(root, "feed=A", "year=2024", "month=01", "day=01", f"hour={hour}")
        os.makedirs(d)
        for k in range(n):
            with open(os.path.join(d, f"p{k}.json"), "w") as f:
                f.write("{}")
    files = quality.landed_files(spark, root, "*.json")
    feeds = spark.createDataFrame([("A", 3), ("B", 1)], "feed string, n_expected int")
    got = quality.file_completeness(files, quality.hour_calendar(feeds, "2024-01-01 00", "2024-01-01 03")).collect()
    assert {(r.feed, r.hour): (r.n_files, r.missing, r.empty) for r in got} == {
        ("A", "00"): (3, False, False), ("A", "01"): (1, True, False), ("A", "02"): (0, False, True), ("A", "03"): (2, True, False),
        **{("B", f"0{h}"): (0, False, True) for h in range(4)}}


def test_files_are_admitted_or_refused_whole(spark):
    src, out = tempfile.mkdtemp(prefix="adpulse-admit-"), tempfile.mkdtemp(prefix="adpulse-admit-out-")
    due = dt.datetime(2024, 1, 1, 1, 2, tzinfo=dt.timezone.utc).timestamp()       # of hour 00, with two minutes' wait
    landed = {"hour=00/a": due - 1, "hour=00/b": due + 5, "hour=01/c": due + 1800, "hour=01/d": due + 7200}
    schema = spark.createDataFrame([(1, "x")], "n long, name string").schema

    def land(names):
        for name in names:
            tmp = tempfile.mkdtemp(prefix="adpulse-one-")
            spark.createDataFrame([(k, name) for k in range(4)], schema).coalesce(1).write.mode("overwrite").parquet(tmp)
            one = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
            to = os.path.join(src, "year=2024/month=01/day=01", name + ".parquet")
            os.makedirs(os.path.dirname(to), exist_ok=True)
            with open(os.path.join(tmp, one), "rb") as f, open(to, "wb") as g:
                g.write(f.read())
            os.utime(to, (landed[name], landed[name]))

    for names in (["hour=00/a", "hour=00/b"], ["hour=01/c", "hour=01/d"]):
        land(names)
        stream = admission.with_file(jobs.file_stream(spark, src, schema))
        q = (stream.writeStream.foreachBatch(admission.admit_into(f"{out}/good", f"{out}/bad"))
             .option("checkpointLocation", f"{out}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination(300)
        assert q.exception() is None
    count = lambda p: {r[0]: r[1] for r in spark.read.parquet(f"{out}/{p}").groupBy("name").count().collect()}
    assert count("good") == {"hour=00/a": 4, "hour=01/c": 4} and count("bad") == {"hour=00/b": 4, "hour=01/d": 4}


def test_flattened_columns_stand_in_the_published_order(spark):
    native = flatten.flatten_bids_nested(bidlog.fx_bid_native(spark, SF_SMALL))
    flat = flatten.flatten_bids_flat(bidlog.fx_bid_flat(spark, SF_SMALL))
    assert native.columns[:8] == ["req_id", "req_at", "req_tmax", "currency_list", "req_bcat", "req_badv", "media_id", "created_at"]
    assert native.columns[-12:] == ["res_id", "fail_code", "impid", "price", "crid", "cmp_no", "ag_no", "crtv_no", "year", "month", "day", "hour"]
    assert flat.columns[-11:] == ["res_id", "res_price", "res_deal_id", "res_bid_crtv_no", "res_bid_cmp_no", "res_bid_ag_no",
                                  "created_at", "year", "month", "day", "hour"]
    assert len(native.columns) == 96 and len(flat.columns) == 49
    # Only bids on the first impression; a request without any still has its row.
    bids = bidlog.fx_bid_flat(spark, SF_SMALL)
    first = F.get("req.imp", 0)["id"]
    n = F.coalesce(F.size(F.filter("res.seatbid", lambda b: b["imp_id"] == first)), F.lit(0))
    assert flat.count() == bids.agg(F.sum(F.greatest(n, F.lit(1)))).first()[0]
    assert flat.where("res_price IS NULL AND res_id IS NULL").count() > 0 and fx.MEDIA_CODES
