"""Conversion attribution (C1-C11): link completed CTV views to later web events.

One parametrised job instead of one copy per route.  Every route reduces to
the same shape before it meets the web events: the earliest qualifying view
time per (campaign, ip) -- ``touch(cmp_no, ip, post_datetime, ...)`` -- so the
join with the events is one-row-per-key on the touch side and never builds
all (view, event) pairs, even when one ip carries a large share of traffic.

* direct  (C1): view ip = event ip.
* visit   (C2): view device -> mobile ids (bridge) -> their visits within
  ``visit_days`` before the view -> visit ip = event ip.
* graph   (C3): view device -> mobile ids -> known ips (id graph) = event ip.

``first_match`` keeps, per (campaign, ip[, event day]), the first
(view, event) pair in (view time, event time) order; ``all_after`` (v3) keeps
every event after the first view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import event_name, is_present, norm_id, norm_ip, valid_id_attr, yyyymmdd
from ..operators.joins import broadcast_if_bounded
from ..operators.temporal import next_event_within

TS_FMT = "yyyy-MM-dd HH:mm:ss"


def _day_int(d: str | None) -> int | None:
    return None if d is None else int(d.replace("-", ""))


PAYLOAD = ("conv_meta", "conv_value")


def web_events(gtm: DataFrame, info: DataFrame, start: str | None = None, end: str | None = None,
               blank_aware: bool = False, extra: bool = False, payload: bool = False, ip: Column | None = None,
               raw_ev: bool = False) -> DataFrame:
    """Distinct web events of tracked pixels with a non-blank ip, events in [start, end];
    ``payload`` adds the conversion payload, ``extra`` every column of v3, ``ip`` is the
    form in which the address is compared; ``raw_ev`` leaves event names as they were logged."""
    day = yyyymmdd("year", F.lpad("month", 2, "0"), F.lpad("day", 2, "0"))
    g = gtm.where(is_present(F.col("ip").cast("string")))
    if start is not None:
        g = g.where(day >= _day_int(start))
    if end is not None:
        g = g.where(day <= _day_int(end))
    pixels = info.where(F.col("pixel_id_web").isNotNull()).select("cmp_no", F.col("pixel_id_web").alias("pid")).distinct()
    cols = [F.regexp_replace(F.substring("log_time", 1, 10), "/", "-").alias("mall_dt"),
            F.to_timestamp("log_time", "yyyy/MM/dd/HH:mm:ss").alias("mall_datetime"),
            F.col("ev") if raw_ev else event_name("ev", F.col("conv_type").cast("string"), F.col("click").cast("string"),
                                                  blank_aware).alias("ev"), "pid", (F.col("ip") if ip is None else ip).alias("ip"), "cmp_no"]
    if extra:
        cols += ["log_time", "eid",
                 F.nullif(F.trim(F.col("scroll").cast("string")), F.lit("")).try_cast("bigint").alias("scroll"),
                 "click", "conv_type", "conv_value", "conv_meta"]
    elif payload:
        cols += list(PAYLOAD)
    return g.join(broadcast_if_bounded(pixels), "pid").select(*cols).distinct()


def completed_views(postback: DataFrame, end: str | None = None, cmps: DataFrame | None = None,
                    need: str = "ip") -> DataFrame:
    """Distinct completed views (v_complete) up to ``end``; ``need`` is the
    field that must be non-blank ('ip' or 'ifa')."""
    v = postback.where(F.col("log_type") == "v_complete")
    if end is not None:
        v = v.where(yyyymmdd("year", F.lpad("month", 2, "0"), F.lpad("day", 2, "0")) <= _day_int(end))
    v = v.where(is_present("request_ip" if need == "ip" else "ifa"))
    v = v.select(F.to_timestamp("created_at").alias("post_datetime"), "cmp_no", "ifa",
                 F.col("request_ip").alias("post_ip")).distinct()
    if cmps is not None:
        v = v.join(broadcast_if_bounded(cmps), "cmp_no", "left_semi")
    return v


def campaign_bounds(views: DataFrame, months_back: int = 5) -> DataFrame:
    """The yyyymm range that a campaign's id tables are read for: from
    ``months_back`` months before its first view up to that month."""
    m0 = F.trunc(F.min("post_datetime").cast("date"), "month")
    ym = lambda c: F.date_format(c, "yyyyMM").cast("int")
    return views.groupBy("cmp_no").agg(ym(F.add_months(m0, -months_back)).alias("_from"), ym(m0).alias("_to"))


def _in_any(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows of an id table whose month any campaign reads; a filter on the partition
    columns alone, from two scalar subqueries."""
    lo, hi = bounds.agg(F.min("_from")).scalar(), bounds.agg(F.max("_to")).scalar()
    return df.where((_ym() >= lo) & (_ym() <= hi))


def _bridge(views: DataFrame, skb: DataFrame, bounds: DataFrame, need_ad: bool = False) -> DataFrame:
    """(cmp_no, ad_id, ifa, _from, _to): mobile ids of the devices that saw a campaign.
    The id table meets the devices on the device id and is then held against the
    campaign's months, so no row is spread over campaigns that it has no device of."""
    pairs = views.select("cmp_no", "ifa").distinct().join(broadcast_if_bounded(bounds), "cmp_no")
    ok = is_present("platform_ad_id") & is_present("ad_id") if need_ad else is_present("platform_ad_id")
    s = _in_any(skb, bounds).where(ok).select("ad_id", F.col("platform_ad_id").alias("ifa"), _ym().alias("ym"))
    return s.join(pairs, "ifa").where(F.col("ym").between(F.col("_from"), F.col("_to"))).drop("ym").distinct()


def _ips_of(per_id: DataFrame, tg: DataFrame, bounds: DataFrame) -> DataFrame:
    """``per_id`` (cmp_no, ad_id, ...) spread to each id's ips in its campaign's months."""
    t = (_in_any(tg, bounds).where(is_present("ip"))
         .select(F.col("uuid").alias("ad_id"), "ip", _ym().alias("ym")).distinct())
    return (t.join(per_id.join(broadcast_if_bounded(bounds), "cmp_no"), "ad_id")
            .where(F.col("ym").between(F.col("_from"), F.col("_to"))).drop("ym", "_from", "_to").distinct())


def _ym(year="year", month="month") -> Column:
    return F.concat(F.col(year), F.lpad(F.col(month), 2, "0")).cast("int")


def visit_extremes(visits: DataFrame) -> DataFrame:
    """Mobile visits reduced to the first and last visit per (mobile id, ip, day).

    Exact for "earliest view within N days after some visit" (N >= 1 day): the
    next view after the day's first visit is the answer when it is in range;
    otherwise no view lies within N days of that first visit, every later visit
    of the day sees the same next view, and the last visit has the widest
    window for it.  Pre-aggregating before the campaign fan-out keeps app
    sessions with many hits per day from multiplying the rows."""
    t = F.to_timestamp("created_at")
    agg = (visits.where(is_present("request_ip") & is_present("ifa"))
           .select(F.col("ifa").alias("ad_id"), F.col("request_ip").alias("ip"), t.alias("_t"), "year", "month")
           .groupBy("ad_id", "ip", F.to_date("_t").alias("_day"), "year", "month")
           .agg(F.min("_t").alias("_a"), F.max("_t").alias("_b")))
    return agg.select("ad_id", "ip", _ym().alias("ym"),
                      F.explode(F.array_distinct(F.array("_a", "_b"))).alias("visit_at"))


def _visits_of(visits: DataFrame, bridge: DataFrame) -> DataFrame:
    """Visits of bridged mobile ids in the months of the campaign."""
    return visits.join(bridge, "ad_id").where(F.col("ym").between(F.col("_from"), F.col("_to")))


def touch_direct(views: DataFrame) -> DataFrame:
    """C1 route: earliest view per (campaign, view ip)."""
    return views.groupBy("cmp_no", F.col("post_ip").alias("ip")).agg(F.min("post_datetime").alias("post_datetime"))


def touch_graph(views: DataFrame, tg: DataFrame, skb: DataFrame, months_back: int = 5) -> DataFrame:
    """C3 route: stb -> mobile id (skb) -> ip (tg), both tables limited to the
    campaign's month range; earliest view over all stbs linked to the ip.

    The earliest view is first reduced per (campaign, mobile id) and only then
    spread to that mobile id's ips, so (set-top x ip) pairs are never formed."""
    bounds = campaign_bounds(views, months_back)
    first_view = views.groupBy("cmp_no", "ifa").agg(F.min("post_datetime").alias("post_datetime"))
    per_id = (_bridge(views, skb, bounds).join(first_view, ["cmp_no", "ifa"])
              .groupBy("cmp_no", "ad_id").agg(F.min("post_datetime").alias("post_datetime")))
    return (_ips_of(per_id, tg, bounds)
            .groupBy("cmp_no", "ip").agg(F.min("post_datetime").alias("post_datetime")))


def touch_visit(views: DataFrame, visits: DataFrame, skb: DataFrame, visit_days: int = 180,
                months_back: int = 5) -> DataFrame:
    """C2 route: a view counts for ip X when its device was bridged (skb) to a
    mobile id that visited from X within ``visit_days`` days before the view.

    Per visit the earliest view at or after it is found with an as-of lookup
    (no view x visit pairs); the earliest of those per (campaign, ip) wins.
    """
    bounds = campaign_bounds(views, months_back)
    vis = _visits_of(visit_extremes(_in_any(visits, bounds)), _bridge(views, skb, bounds)).select("cmp_no", "ifa", "visit_at", "ip")
    nxt = next_event_within(vis, views.select("cmp_no", "ifa", "post_datetime"),
                            keys=["cmp_no", "ifa"], probe_ts="visit_at", event_ts="post_datetime",
                            horizon_days=visit_days, out="post_datetime")
    return nxt.where(F.col("post_datetime").isNotNull()).groupBy("cmp_no", "ip") \
        .agg(F.min("post_datetime").alias("post_datetime"))


def first_match(touch: DataFrame, mall: DataFrame, cate: str, per_day: bool = True) -> DataFrame:
    """First (view, event) pair per (campaign, event ip[, event day]) with the
    event strictly after the view.  Because ``touch`` already holds the earliest
    view per key, the first pair is that view and the earliest later event;
    ties on the event time are broken by pid, then ev."""
    keys = ["cmp_no", "mall_ip"] + (["mall_dt"] if per_day else [])
    j = (mall.withColumnRenamed("ip", "mall_ip")
         .join(touch.withColumnRenamed("ip", "mall_ip"), ["cmp_no", "mall_ip"])
         .where(F.col("mall_datetime") > F.col("post_datetime")))
    best = j.groupBy(*keys).agg(F.min(F.struct("mall_datetime", "mall_dt", "pid", "ev", "post_datetime")).alias("_b"))
    return best.select(
        "cmp_no", F.col("_b.pid").alias("pid"), F.col("_b.ev").alias("ev"), F.col("_b.mall_dt").alias("mall_dt"),
        F.date_format("_b.post_datetime", TS_FMT).alias("post_datetime"),
        F.date_format("_b.mall_datetime", TS_FMT).alias("mall_datetime"), "mall_ip",
        F.lit(cate).alias("cate"), F.substring(F.col("_b.mall_dt"), 1, 4).alias("year"),
        F.substring(F.col("_b.mall_dt"), 6, 2).alias("month"), F.substring(F.col("_b.mall_dt"), 9, 2).alias("day"))


def attribute_v1(postback: DataFrame, gtm: DataFrame, info: DataFrame, visits: DataFrame, skb: DataFrame,
                 tg: DataFrame, start: str | None = None, end: str | None = None,
                 routes: tuple[str, ...] = ("direct", "visit", "graph"), imp_date: bool = False,
                 visit_days: int = 180, raw_ev: bool = False) -> DataFrame:
    """C4 (v1 union), C5 (``imp_date``), the initial table's form (C11, ``raw_ev``: event
    names as they were logged) and their range forms (C10): one call
    covers every event day in [start, end]; ``mall_dt`` is part of the dedup
    key, so the range result is the union of the daily results."""
    mall = web_events(gtm, info, start, end, raw_ev=raw_ev)
    cmps = mall.select("cmp_no").distinct()
    parts = []
    if "direct" in routes:
        parts.append(first_match(touch_direct(completed_views(postback, end, None, "ip")), mall, "Addi"))
    if "visit" in routes or "graph" in routes:
        ifa_views = completed_views(postback, end, cmps, "ifa")
        if "visit" in routes:
            parts.append(first_match(touch_visit(ifa_views, visits, skb, visit_days), mall, "Abi"))
        if "graph" in routes:
            parts.append(first_match(touch_graph(ifa_views, tg, skb), mall, "ODM"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if imp_date:
        out = out.select("cmp_no", "pid", "ev", F.to_date(F.substring("post_datetime", 1, 10)).alias("imp_dt"),
                         *[c for c in out.columns if c not in ("cmp_no", "pid", "ev")])
    return out


V3_EVENT_COLS = ["cmp_no", "pid", "eid", "log_time", "ev", "scroll", "click", "conv_type", "conv_value",
                 "conv_meta", "mall_dt"]


def first_view_direct(views: DataFrame) -> DataFrame:
    """v3 direct route: first view per (campaign, view ip); ties by device id."""
    return (views.groupBy("cmp_no", "post_ip").agg(F.min(F.struct("post_datetime", "ifa")).alias("_f"))
            .select("cmp_no", F.col("post_ip").alias("ip"), F.col("_f.post_datetime").alias("post_datetime"),
                    F.col("_f.ifa").alias("stp_id"), F.lit(None).cast("string").alias("m_adid"),
                    F.col("post_ip").alias("raw_ip")))


def first_view_graph(views: DataFrame, tg: DataFrame, skb: DataFrame, months_back: int = 5) -> DataFrame:
    """v2/v3 graph route: per (campaign, graph ip) the first (view time, device,
    mobile id, view ip) over the devices linked to the ip.  Each device
    contributes only its first view, and the best device is picked per
    (campaign, mobile id) before spreading to that id's ips -- the
    lexicographic minimum is unchanged, and no (device x ip) pairs are formed."""
    bounds = campaign_bounds(views, months_back)
    first = views.groupBy("cmp_no", "ifa").agg(F.min(F.struct("post_datetime", "post_ip")).alias("_v"))
    per_id = (_bridge(views, skb, bounds, need_ad=True).join(first, ["cmp_no", "ifa"]).groupBy("cmp_no", "ad_id")
              .agg(F.min(F.struct(F.col("_v.post_datetime").alias("t"), F.col("ifa"),
                                  F.col("_v.post_ip").alias("r"))).alias("_m")))
    best = (_ips_of(per_id, tg, bounds)
            .groupBy("cmp_no", "ip").agg(F.min(F.struct(F.col("_m.t").alias("t"), F.col("_m.ifa").alias("ifa"),
                                                        F.col("ad_id"), F.col("_m.r").alias("r"))).alias("_b")))
    return best.select("cmp_no", "ip", F.col("_b.t").alias("post_datetime"), F.col("_b.ifa").alias("stp_id"),
                       F.col("_b.ad_id").alias("m_adid"), F.col("_b.r").alias("raw_ip"))


def first_view_visit(views: DataFrame, visits: DataFrame, skb: DataFrame, visit_days: int = 180,
                     months_back: int = 5) -> DataFrame:
    """v3 visit route: per (campaign, visit ip) the earliest view that follows a
    bridged visit within ``visit_days``; ties go to the latest such visit, then
    device, mobile id, view ip.  Every visit that maps to the earliest view has
    that view as its own next view, so the as-of lookup per visit suffices."""
    bounds = campaign_bounds(views, months_back)
    v = (_in_any(visits, bounds).where(is_present("request_ip") & is_present("ifa"))
         .select(F.col("ifa").alias("ad_id"), F.to_timestamp("created_at").alias("visit_at"),
                 F.col("request_ip").alias("ip"), _ym().alias("ym")))
    vis = _visits_of(v, _bridge(views, skb, bounds, need_ad=True)).select("cmp_no", "ifa", "ad_id", "visit_at", "ip")
    vt = views.select("cmp_no", "ifa", "post_datetime", "post_ip")
    nxt = next_event_within(vis, vt.select("cmp_no", "ifa", "post_datetime").distinct(), keys=["cmp_no", "ifa"],
                            probe_ts="visit_at", event_ts="post_datetime", horizon_days=visit_days,
                            out="post_datetime").where(F.col("post_datetime").isNotNull())
    raw = vt.groupBy("cmp_no", "ifa", "post_datetime").agg(F.min("post_ip").alias("raw_ip"))
    cand = nxt.join(raw, ["cmp_no", "ifa", "post_datetime"])
    key = F.struct(F.col("post_datetime").alias("t"), (-F.unix_micros("visit_at")).alias("nv"),
                   F.col("ifa"), F.col("ad_id"), F.col("raw_ip"))
    best = cand.groupBy("cmp_no", "ip").agg(F.min(key).alias("_b"))
    return best.select("cmp_no", "ip", F.col("_b.t").alias("post_datetime"), F.col("_b.ifa").alias("stp_id"),
                       F.col("_b.ad_id").alias("m_adid"), F.col("_b.raw_ip").alias("raw_ip"))


def all_after(first: DataFrame, mall: DataFrame, cate: str, keep_m_adid: bool = True) -> DataFrame:
    """v3: every web event on the ip strictly after the first view (1:N).  The events are
    distinct and ``first`` has one row per (campaign, ip), so the rows are distinct as well."""
    j = mall.join(first, ["cmp_no", "ip"]).where(F.col("mall_datetime") > F.col("post_datetime"))
    m = F.col("m_adid") if keep_m_adid else F.lit(None).cast("string")
    return j.select(*V3_EVENT_COLS, F.date_format("post_datetime", TS_FMT).alias("post_datetime"),
                    F.date_format("mall_datetime", TS_FMT).alias("mall_datetime"), F.col("ip").alias("mall_ip"),
                    F.lit(cate).alias("cate"), "stp_id", m.alias("m_adid"), "raw_ip",
                    F.substring("mall_dt", 1, 4).alias("year"), F.substring("mall_dt", 6, 2).alias("month"),
                    F.substring("mall_dt", 9, 2).alias("day"))


def attribute_v3(postback: DataFrame, gtm: DataFrame, info: DataFrame, visits: DataFrame | None = None,
                 skb: DataFrame | None = None, tg: DataFrame | None = None, start: str | None = None,
                 end: str | None = None, routes: tuple[str, ...] = ("direct", "visit", "graph"),
                 visit_days: int = 180) -> DataFrame:
    """First touch picked per (campaign, ip) *before* meeting the events,
    then all later events (1:N).  The earliest view is the same for every event
    day, so the range form equals the union of daily runs."""
    mall = web_events(gtm, info, start, end, blank_aware=True, extra=True)
    cmps = mall.select("cmp_no").distinct()
    parts = []
    if "direct" in routes:
        parts.append(all_after(first_view_direct(completed_views(postback, end, cmps, "ip")), mall, "Addi",
                               keep_m_adid=False))
    if "visit" in routes or "graph" in routes:
        iv = completed_views(postback, end, cmps, "ifa")
        if "visit" in routes:
            parts.append(all_after(first_view_visit(iv, visits, skb, visit_days), mall, "Abi"))
        if "graph" in routes:
            parts.append(all_after(first_view_graph(iv, tg, skb), mall, "ODM"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def first_view_visit_v2(views: DataFrame, visits: DataFrame, skb: DataFrame, visit_days: int = 180,
                        months_back: int = 5) -> DataFrame:
    """v2 visit route: per (campaign, visit ip) the first candidate in (view
    time, device, mobile id, view ip) order; visits are reduced to their daily
    first/last (exact for this order, see ``visit_extremes``)."""
    bounds = campaign_bounds(views, months_back)
    vis = _visits_of(visit_extremes(_in_any(visits, bounds)), _bridge(views, skb, bounds, need_ad=True)).select(
        "cmp_no", "ifa", "ad_id", "visit_at", "ip")
    vt = views.select("cmp_no", "ifa", "post_datetime", "post_ip")
    nxt = next_event_within(vis, vt.select("cmp_no", "ifa", "post_datetime"), keys=["cmp_no", "ifa"],
                            probe_ts="visit_at", event_ts="post_datetime", horizon_days=visit_days,
                            out="post_datetime").where(F.col("post_datetime").isNotNull())
    raw = vt.groupBy("cmp_no", "ifa", "post_datetime").agg(F.min("post_ip").alias("raw_ip"))
    best = (nxt.join(raw, ["cmp_no", "ifa", "post_datetime"]).groupBy("cmp_no", "ip")
            .agg(F.min(F.struct(F.col("post_datetime").alias("t"), "ifa", "ad_id", "raw_ip")).alias("_b")))
    return best.select("cmp_no", "ip", F.col("_b.t").alias("post_datetime"), F.col("_b.ifa").alias("stp_id"),
                       F.col("_b.ad_id").alias("m_adid"), F.col("_b.raw_ip").alias("raw_ip"))


def first_match_v2(touch: DataFrame, mall: DataFrame, cate: str, per_day: bool = True,
                   raw_is_event_ip: bool = False) -> DataFrame:
    """v2 first pair per (campaign, event ip[, day]): the touch's earliest
    candidate and the earliest later event (ties: pid, ev, payload)."""
    keys = ["cmp_no", "ip"] + (["mall_dt"] if per_day else [])
    j = mall.join(touch, ["cmp_no", "ip"]).where(F.col("mall_datetime") > F.col("post_datetime"))
    best = j.groupBy(*keys).agg(
        F.min(F.struct("post_datetime", "stp_id", "m_adid", "raw_ip")).alias("_c"),
        F.min(F.struct("mall_datetime", "pid", "ev", "conv_meta", "conv_value", "mall_dt")).alias("_e"))
    return best.select("cmp_no", F.col("_e.pid").alias("pid"), F.col("_e.ev").alias("ev"),
                       F.col("_e.conv_meta").alias("conv_meta"), F.col("_e.conv_value").alias("conv_value"),
                       F.col("_e.mall_dt").alias("mall_dt"), F.date_format("_c.post_datetime", TS_FMT).alias("post_datetime"),
                       F.date_format("_e.mall_datetime", TS_FMT).alias("mall_datetime"), F.col("ip").alias("mall_ip"),
                       F.lit(cate).alias("cate"), F.col("_c.stp_id").alias("stp_id"),
                       F.col("_c.m_adid").alias("m_adid"),
                       (F.col("ip") if raw_is_event_ip else F.col("_c.raw_ip")).alias("raw_ip"),
                       F.substring(F.col("_e.mall_dt"), 1, 4).alias("year"),
                       F.substring(F.col("_e.mall_dt"), 6, 2).alias("month"),
                       F.substring(F.col("_e.mall_dt"), 9, 2).alias("day"))


def attribute_v2(postback: DataFrame, gtm: DataFrame, info: DataFrame, visits: DataFrame, skb: DataFrame,
                 tg: DataFrame, start: str | None = None, end: str | None = None, direct_lookback_months: int | None = None,
                 visit_days: int = 180) -> DataFrame:
    """C6 (v2): v1 plus device id, mobile id, view ip and the conversion
    payload, ties broken by device then mobile id.  C7 (home) is v2 with the
    direct route's views limited to ``direct_lookback_months`` before ``end``."""
    mall = web_events(gtm, info, start, end, payload=True)
    cmps = mall.select("cmp_no").distinct()
    dv = completed_views(postback, end, None, "ip")
    if direct_lookback_months is not None and end is not None:
        lo = F.date_format(F.add_months(F.to_date(F.lit(end)), -direct_lookback_months), "yyyyMMdd").cast("int")
        dv = dv.where(F.date_format("post_datetime", "yyyyMMdd").cast("int") >= lo)
    direct = (dv.groupBy("cmp_no", "post_ip").agg(F.min(F.struct("post_datetime", "ifa")).alias("_f"))
              .select("cmp_no", F.col("post_ip").alias("ip"), F.col("_f.post_datetime").alias("post_datetime"),
                      F.col("_f.ifa").alias("stp_id"), F.lit(None).cast("string").alias("m_adid"),
                      F.col("post_ip").alias("raw_ip")))
    iv = completed_views(postback, end, cmps, "ifa")
    parts = [first_match_v2(direct, mall, "Addi", raw_is_event_ip=True),
             first_match_v2(first_view_visit_v2(iv, visits, skb, visit_days), mall, "Abi"),
             first_match_v2(first_view_graph(iv, tg, skb), mall, "ODM")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def attribute_via_mapping(postback: DataFrame, gtm: DataFrame, info: DataFrame, weekly: DataFrame,
                          visits: DataFrame, start: str | None = None, end: str | None = None,
                          per_day: bool = False) -> DataFrame:
    """Set-top -> mobile id through the weekly mapping table, then mobile id
    -> ip either from ABI visits (cate 'ABI') or from the mapping's own ips
    (cate 'STB_MOBILE_MAPPING'); ids and ips normalised, no time window.  One
    row per (campaign, event ip) for the whole range (the range form keeps no
    day in the key); ``per_day`` is the daily form, one row per event day.

    Per (campaign, ip) the first candidate in (view, device, mobile id, view
    ip, carrier) order is found from each device's first view; the event is
    the earliest one after that view (ties: pid, ev, payload)."""
    day = yyyymmdd("year", F.lpad("month", 2, "0"), F.lpad("day", 2, "0"))
    mall = web_events(gtm, info, start, end, payload=True, ip=norm_ip(F.col("ip").cast("string")))
    cmps = mall.select("cmp_no").distinct()
    v = postback.where((F.col("log_type") == "v_complete") & is_present(F.col("ifa").cast("string")))
    if end is not None:
        v = v.where(day <= _day_int(end))
    views = (v.join(broadcast_if_bounded(cmps), "cmp_no", "left_semi")
             .select(F.to_timestamp("created_at").alias("post_datetime"), "cmp_no",
                     norm_id(F.col("ifa").cast("string")).alias("stp_id"),
                     norm_ip(F.col("request_ip").cast("string")).alias("raw_ip")).distinct())
    first = views.groupBy("cmp_no", "stp_id").agg(F.min(F.struct("post_datetime", "raw_ip")).alias("_v"))
    wk = weekly.where(is_present(F.col("ad_id").cast("string")))
    stb_mobile = (wk.where(is_present(F.col("plattform_id").cast("string")))
                  .select(norm_id(F.col("plattform_id").cast("string")).alias("stp_id"),
                          norm_id(F.col("ad_id").cast("string")).alias("m_adid"), "carrier")
                  .where(valid_id_attr("m_adid")).distinct())
    vis = visits.where(is_present(F.col("ifa").cast("string")) & is_present(F.col("request_ip").cast("string")))
    if end is not None:
        vis = vis.where(day <= _day_int(end))
    abi_ip = (vis.select(norm_id(F.col("ifa").cast("string")).alias("m_adid"),
                         norm_ip(F.col("request_ip").cast("string")).alias("ip"))
              .where(valid_id_attr("m_adid")))
    map_ip = (wk.where(is_present(F.col("ip").cast("string")))
              .select(norm_id(F.col("ad_id").cast("string")).alias("m_adid"),
                      norm_ip(F.col("ip").cast("string")).alias("ip"))
              .where(valid_id_attr("m_adid")))

    # Best (view, device, view ip, carrier) per (campaign, mobile id) first, then spread to the
    # mobile id's ips, of which only those with events are looked at: same lexicographic
    # minimum, no device x ip pairs.  Both routes go through the same joins.
    per_id = (stb_mobile.join(first, "stp_id").groupBy("cmp_no", "m_adid")
              .agg(F.min(F.struct(F.col("_v.post_datetime").alias("t"), "stp_id",
                                  F.col("_v.raw_ip").alias("r"), "carrier")).alias("_m")))
    ips = (abi_ip.withColumn("cate", F.lit("ABI")).unionByName(map_ip.withColumn("cate", F.lit("STB_MOBILE_MAPPING")))
           .join(mall.select("ip").distinct(), "ip", "left_semi").distinct())
    touch = (ips.join(per_id, "m_adid")
             .groupBy("cmp_no", "ip", "cate").agg(F.min(F.struct(F.col("_m.t").alias("t"), F.col("_m.stp_id").alias("stp_id"),
                                                                 "m_adid", F.col("_m.r").alias("r"),
                                                                 F.col("_m.carrier").alias("carrier"))).alias("_c")))
    j = mall.join(touch, ["cmp_no", "ip"]).where(F.col("mall_datetime") > F.col("_c.t"))
    best = j.groupBy("cmp_no", "ip", "cate", *(["mall_dt"] if per_day else [])).agg(
        F.first("_c").alias("_c"),
        F.min(F.struct("mall_datetime", "pid", "ev", "conv_meta", "conv_value", F.col("mall_dt").alias("mall_dt"))).alias("_e"))
    return best.select("cmp_no", F.col("_e.pid").alias("pid"), F.col("_e.ev").alias("ev"),
                       F.col("_e.conv_meta").alias("conv_meta"), F.col("_e.conv_value").alias("conv_value"),
                       F.col("_e.mall_dt").alias("mall_dt"),
                       F.date_format("_c.t", TS_FMT).alias("post_datetime"),
                       F.date_format("_e.mall_datetime", TS_FMT).alias("mall_datetime"),
                       F.col("ip").alias("mall_ip"), "cate",
                       F.col("_c.stp_id").alias("stp_id"), F.col("_c.m_adid").alias("m_adid"),
                       F.col("_c.r").alias("raw_ip"), F.col("_c.carrier").alias("carrier"),
                       F.substring(F.col("_e.mall_dt"), 1, 4).alias("year"),
                       F.substring(F.col("_e.mall_dt"), 6, 2).alias("month"),
                       F.substring(F.col("_e.mall_dt"), 9, 2).alias("day"))
