import datetime as dt
import random

from pyspark.sql import functions as F

from adpulse.operators.temporal import next_event_within
from adpulse.plans import attribution as attr


def _ts(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


def test_next_event_within_matches_brute_force(spark):
    rnd = random.Random(7)
    probes = [(k, _ts(rnd.randint(0, 60), rnd.randint(0, 23)), i) for i, k in
              enumerate(rnd.choice("ab") for _ in range(60))]
    events = [(k, _ts(rnd.randint(0, 60), rnd.randint(0, 23))) for k in (rnd.choice("abc") for _ in range(40))]
    events.append(("a", probes[0][1]))  # an event at exactly the probe time counts
    p = spark.createDataFrame(probes, "k string, t timestamp, pid int")
    e = spark.createDataFrame(events, "k string, et timestamp")
    got = {r["pid"]: r["nx"] for r in next_event_within(p, e, ["k"], "t", "et", 10, "nx").collect()}
    for k, t, pid in probes:
        cands = [et for ek, et in events if ek == k and t <= et <= t + dt.timedelta(days=10)]
        assert got[pid] == (min(cands) if cands else None), pid


def test_first_match_equals_pairwise_row_number(spark):
    # views and events on one (cmp, ip): event before view, equal times, two views, ties on time
    views = [(1, "ip1", _ts(1)), (1, "ip1", _ts(2)), (1, "ip2", _ts(5))]
    mall = [("2024-01-01", _ts(0, 5), "ev", "p", "ip1", 1),   # before every view
            ("2024-01-02", _ts(1), "ev", "p", "ip1", 1),      # equal to the first view: not later
            ("2024-01-02", _ts(1, 3), "b", "p", "ip1", 1),    # tie on time, ev decides
            ("2024-01-02", _ts(1, 3), "a", "p", "ip1", 1),
            ("2024-01-03", _ts(2, 1), "x", "p", "ip1", 1),    # another day
            ("2024-01-05", _ts(4), "x", "p", "ip2", 1)]       # before ip2's view
    touch = attr.touch_direct(spark.createDataFrame(views, "cmp_no int, post_ip string, post_datetime timestamp"))
    m = spark.createDataFrame(mall, "mall_dt string, mall_datetime timestamp, ev string, pid string, ip string, "
                                    "cmp_no int")
    got = sorted((r["mall_dt"], r["ev"], r["post_datetime"]) for r in attr.first_match(touch, m, "Addi").collect())
    brute = {}
    for c, ip, p in views:
        for d, t, ev, pid, mip, mc in mall:
            if mc == c and mip == ip and t > p:
                key = (c, ip, d)
                cand = (p, t, pid, ev)
                brute[key] = min(brute.get(key, cand), cand)
    want = sorted((k[2], v[3], v[0].strftime("%Y-%m-%d %H:%M:%S")) for k, v in brute.items())
    assert got == want


def test_campaign_bounds_go_back_five_months(spark):
    v = spark.createDataFrame([(1, "2024-02-10 00:00:00"), (1, "2024-04-01 00:00:00"), (2, "2024-07-31 23:59:59")],
                              "cmp_no int, t string").select("cmp_no", F.to_timestamp("t").alias("post_datetime"))
    assert sorted(map(tuple, attr.campaign_bounds(v).collect())) == [(1, 202309, 202402), (2, 202402, 202407)]


def test_range_equals_union_of_daily_runs(spark):
    from adpulse.queries import _attr_inputs
    from tests.conftest import SF_SMALL
    inp = _attr_inputs(spark, SF_SMALL)
    days = ["2024-01-10", "2024-01-11", "2024-01-12"]
    for fn in (attr.attribute_v1, attr.attribute_v3):
        rng = sorted(map(tuple, fn(**inp, start=days[0], end=days[-1]).collect()))
        daily = sorted(r for d in days for r in map(tuple, fn(**inp, start=d, end=d).collect()))
        assert rng == daily and len(rng) > 0, fn.__name__


def test_home_lookback_leaves_out_old_views_and_raw_names_stay(spark):
    """The log that reaches further back gives other first views without the lookback; the
    initial table's event names are the logged ones."""
    from adpulse.queries import _attr_inputs, _home
    from adpulse.oracle.attribution_sql import HOME_END
    from adpulse.sources import fixtures as fx
    from tests.conftest import SF_SMALL
    inp = _attr_inputs(spark, SF_SMALL)
    home = _home(spark, SF_SMALL).where("cate = 'Addi'")
    whole = attr.attribute_v2(**inp | dict(postback=fx.fx_postback_long(spark, SF_SMALL)), end=HOME_END).where("cate = 'Addi'")
    assert home.agg(F.min("post_datetime")).first()[0] >= "2023-07-30" > whole.agg(F.min("post_datetime")).first()[0]
    raw = {r.ev for r in attr.attribute_v1(**inp, routes=("direct",), raw_ev=True).select("ev").collect()}
    named = {r.ev for r in attr.attribute_v1(**inp, routes=("direct",)).select("ev").collect()}
    assert "conversion" in raw and raw <= {"conversion", "click", "view", "signup", "error"} and named - raw


def test_mapping_attribution_equals_pairs(spark):
    """Both routes against every (view, id, ip, event) pair; an id on two ips, an ip of two ids,
    events before the view, ids and ips in other spellings."""
    views = [(1, "STB-1", "2024-01-02T00:00:00Z", "9.9.9.1"), (1, "stb-2", "2024-01-01T00:00:00Z", "9.9.9.2"), (2, "stb-1", "2024-01-03T00:00:00Z", "9.9.9.1")]
    pb = spark.createDataFrame([("v_complete", c, i, t, ip, t[:4], t[5:7], t[8:10]) for c, i, t, ip in views],
                               "log_type string, cmp_no long, ifa string, created_at string, request_ip string, year string, month string, day string")
    weekly = [("stb-1", "ad-1", "1.1.1.1", "KT"), ("stb-2", "AD-1", "1.1.1.2", "SKB"), ("stb-2", "ad-2", "1.1.1.1", "SKB"), ("stb-1", None, "1.1.1.3", "KT")]
    visits = [("ad-1", "::ffff:1.1.1.4", "2024-01-01"), ("ad-2", "1.1.1.4", "2024-01-02"), (" ", "1.1.1.5", "2024-01-01")]
    gtm = [(f"2024/01/{d:02d}/0{h}:00:00", "px", ip) for d in (1, 2, 4) for h in (1, 5) for ip in ("1.1.1.1", "1.1.1.2", "1.1.1.4", "1.1.1.5")]
    g = spark.createDataFrame([(t, "view", None, None, None, None, p, ip, t[:4], t[5:7], t[8:10]) for t, p, ip in gtm],
                              "log_time string, ev string, click string, conv_type string, conv_value string, conv_meta string, pid string, ip string, year string, month string, day string")
    info = spark.createDataFrame([(1, "px"), (2, "px")], "cmp_no long, pixel_id_web string")
    vis = spark.createDataFrame([(a, ip, *d.split("-")) for a, ip, d in visits], "ifa string, request_ip string, year string, month string, day string")
    wk = spark.createDataFrame(weekly, "plattform_id string, ad_id string, ip string, carrier string")
    got = sorted((r.cmp_no, r.mall_ip, r.cate, r.mall_datetime, r.post_datetime, r.stp_id, r.m_adid, r.carrier)
                 for r in attr.attribute_via_mapping(pb, g, info, wk, vis).collect())
    ips = {(a.lower(), ip.removeprefix("::ffff:"), "ABI") for a, ip, _ in visits if a.strip()} | {(a.lower(), ip, "STB_MOBILE_MAPPING") for _, a, ip, _ in weekly if a}
    best = {}
    for c, box, t, raw in views:
        for b, a, _, carrier in weekly:
            if a and b == box.lower():
                for a2, ip, cate in ips:
                    if a2 == a.lower():
                        touch = (t[:10] + " " + t[11:19], b, a2, raw, carrier)
                        best[c, ip, cate] = min(best.get((c, ip, cate), touch), touch)
    want = []
    for (c, ip, cate), (t, b, a, _, carrier) in best.items():
        later = [e for e in (f"{x[0][:10].replace('/', '-')} {x[0][11:]}" for x in gtm if x[2] == ip) if e > t]
        if later:
            want.append((c, ip, cate, min(later), t, b, a, carrier))
    assert got == sorted(want) and {w[2] for w in want} == {"ABI", "STB_MOBILE_MAPPING"}


def test_listed_order(spark):
    from adpulse.operators.ordering import in_listed_order
    df = spark.createDataFrame([(c,) for c in ("x", None, "KT", "SKB", "a", "U+")], "c string")
    assert [r.c for r in in_listed_order(df, "c", ("SKB", "U+", "KT")).collect()] == ["SKB", "U+", "KT", "a", "x", None]
    assert [r.c for r in in_listed_order(df, "c", ()).collect()][-1] is None


def test_v3_groups_its_rows_no_further(spark):
    mall = "cmp_no int, pid string, eid string, log_time string, ev string, scroll long, click string, conv_type string, " \
           "conv_value string, conv_meta string, mall_dt string, mall_datetime timestamp, ip string"
    row = lambda eid, ip, day: (1, "p", eid, str(_ts(day)), "ev", None, None, None, None, None, "d", _ts(day), ip)
    m = spark.createDataFrame([row("e1", "a", 2), row("e2", "a", 2), row("e2", None, 2), row("e1", "a", 0), row("e1", "b", 2)], mall)
    first = attr.first_view_direct(spark.createDataFrame(
        [(1, "a", _ts(1), "x"), (1, "a", _ts(1), "x"), (1, "a", _ts(1, 5), "w"), (1, None, _ts(1), "y")],
        "cmp_no int, post_ip string, post_datetime timestamp, ifa string"))
    out = attr.all_after(first, m, "Addi")
    assert sorted((r.eid, r.mall_ip, r.stp_id) for r in out.collect()) == [("e1", "a", "x"), ("e2", "a", "x")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1       # the first views' own

    from adpulse.queries import _attr_inputs
    from tests.conftest import SF_SMALL
    v3 = attr.attribute_v3(**_attr_inputs(spark, SF_SMALL)).cache()
    assert v3.count() == v3.distinct().count() > 0
