"""DuckDB oracles for attribution, from its meaning rather than step by step.

An advert's *touch* is a completed view together with an ip that it reaches: the
viewer's own ip, an ip from which a phone bridged to the viewing box visited within the
180 days before, or an ip that the id graph knows for such a phone.  Of all touches of a
campaign on an ip the least counts (``min`` of a struct), and the answer for a web event
day is the least event after it.  The three ways differ only in their touches."""

from ..sources.fixtures import with_fixtures

FIX = ("fx_postback", "fx_gtm", "fx_info", "fx_visit", "fx_skb", "fx_tg")
HOME_END = "2024-01-30"
RANGE_START, RANGE_END = "2024-01-10", "2024-01-20"
STAMP = "'%Y-%m-%d %H:%M:%S'"


def partition_day(t: str) -> str:
    return f"{t}.year || '-' || lpad({t}.month, 2, '0') || '-' || lpad({t}.day, 2, '0')"


def events(extra: str = "", blank_counts: bool = True, ip: str = "g.ip", within: str = "true", own_name: bool = True) -> str:
    """Web events of tracked pixels; a conversion or click goes by its own name, or all as they were logged."""
    own = "CAST({} AS VARCHAR)" if blank_counts else "nullif(trim(CAST({} AS VARCHAR)), '')"
    return f"""happened AS (SELECT DISTINCT n.cmp_no, g.pid, {ip} AS ip, strptime(g.log_time, '%Y/%m/%d/%H:%M:%S') AS hit,
   {f"ifnull(CASE g.ev WHEN 'conversion' THEN {own.format('g.conv_type')} WHEN 'click' THEN {own.format('g.click')} END, g.ev)" if own_name else "g.ev"} AS ev{extra}
 FROM fx_info n, fx_gtm g WHERE g.pid = n.pixel_id_web AND trim(g.ip) <> '' AND {within})"""


def views(until: str | None = None, log: str = "fx_postback") -> str:
    cut = f" AND {partition_day('p')} <= '{until}'" if until else ""
    return f"""shown AS (SELECT DISTINCT p.cmp_no, p.ifa AS box, p.request_ip AS ip, strptime(p.created_at, '%Y-%m-%dT%H:%M:%SZ') AS t
 FROM {log} p WHERE p.log_type = 'v_complete'{cut})"""


# The months that a campaign's bridges and ips are taken from: that of its first view and five before.
_BRIDGE = """seen AS (SELECT * FROM shown WHERE trim(box) <> '' AND cmp_no IN (SELECT cmp_no FROM happened)),
window_of AS (SELECT cmp_no, unnest([strftime(date_trunc('month', min(t)) - to_months(k), '%Y%m') FOR k IN range(6)]) AS ym
 FROM seen GROUP BY cmp_no),
bridge AS (SELECT DISTINCT w.cmp_no, b.platform_ad_id AS box, b.ad_id AS phone FROM window_of w, fx_skb b
 WHERE w.ym = b.year || lpad(b.month, 2, '0') AND trim(b.platform_ad_id) <> '')"""

# (cmp_no, ip, t, box, phone, raw, back): back is the time since the visit, for ties.
TOUCHES = {
    "Addi": ("", "SELECT cmp_no, ip, t, box, NULL AS phone, ip AS raw, 0 AS back FROM shown WHERE trim(ip) <> '' AND {near}"),
    "Abi": (_BRIDGE, """SELECT b.cmp_no, v.request_ip AS ip, s.t, s.box, b.phone, s.ip AS raw,
   epoch_us(s.t) - epoch_us(strptime(v.created_at, '%Y-%m-%dT%H:%M:%SZ')) AS back
 FROM fx_visit v JOIN bridge b ON b.phone = v.ifa
 SEMI JOIN window_of w ON w.cmp_no = b.cmp_no AND w.ym = v.year || lpad(v.month, 2, '0')
 JOIN seen s ON s.cmp_no = b.cmp_no AND s.box = b.box
 WHERE trim(v.request_ip) <> '' AND trim(v.ifa) <> '' AND back BETWEEN 0 AND 180 * 86400000000"""),
    "ODM": (_BRIDGE, """SELECT b.cmp_no, k.ip, s.t, s.box, b.phone, s.ip AS raw, 0 AS back
 FROM (SELECT DISTINCT w.cmp_no, g.uuid, g.ip FROM window_of w, fx_tg g
       WHERE w.ym = g.year || lpad(g.month, 2, '0') AND trim(g.ip) <> '') k
 JOIN bridge b ON b.cmp_no = k.cmp_no AND b.phone = k.uuid JOIN seen s ON s.cmp_no = b.cmp_no AND s.box = b.box"""),
}


def least_touch(way: str, latest_visit: bool = False, near: str = "true") -> str:
    tie = "back := back, " if latest_visit else ""
    return (f"touch_{way} AS (SELECT cmp_no, ip, min(struct_pack(t := t, {tie}box := box, phone := phone, raw := raw)) AS f "
            f"FROM ({TOUCHES[way][1].format(near=near)}) GROUP BY cmp_no, ip)")


def _with(way_names, event_sql: str, view_sql: str, select, **how) -> str:
    """All ways' rows: ``select(way)`` over happened e and the way's least touch."""
    parts = [event_sql, view_sql]
    if any(TOUCHES[w][0] for w in way_names):
        parts.append(_BRIDGE)
    near, log = how.pop("near", "true"), how.pop("log", "fx_postback")
    parts += [least_touch(w, near=near if w == "Addi" else "true", **how) for w in way_names]
    return with_fixtures("\nUNION ALL\n".join(select(w) for w in way_names), log, *FIX[1:], ctes=parts)


DAY_PARTS = "strftime({0}, '%Y') AS year, strftime({0}, '%m') AS month, strftime({0}, '%d') AS day"


def _first_event(columns: str, payload: str = "", by_day: bool = True):
    """One row for each campaign, ip and event day: the least event after the touch."""
    def select(way: str) -> str:
        return f"""SELECT cmp_no, e.pid, e.ev, {columns.format(way=way)}, {DAY_PARTS.format('e.hit')}
 FROM (SELECT cmp_no, ip, any_value(f) AS f, min(struct_pack(hit := hit, pid := pid, ev := ev{payload})) AS e
       FROM happened JOIN touch_{way} USING (cmp_no, ip) WHERE hit > f.t GROUP BY cmp_no, ip, CAST(hit AS DATE))"""
    return select


_TIMES = (f"strftime(e.hit, '%Y-%m-%d') AS mall_dt, strftime(f.t, {STAMP}) AS post_datetime, "
          f"strftime(e.hit, {STAMP}) AS mall_datetime, ip AS mall_ip, '{{way}}' AS cate")
WAYS = ("Addi", "Abi", "ODM")


def _in_range(start: str | None, end: str | None) -> str:
    return f"{partition_day('g')} BETWEEN '{start}' AND '{end}'" if start else "true"


def v1(ways=WAYS, imp: bool = False, start: str | None = None, end: str | None = None, own_name: bool = True) -> str:
    return _with(ways, events(within=_in_range(start, end), own_name=own_name), views(end),
                 _first_event(("CAST(f.t AS DATE) AS imp_dt, " if imp else "") + _TIMES))


ATTR_DIRECT = v1(("Addi",))
ATTR_VISIT = v1(("Abi",))
ATTR_GRAPH = v1(("ODM",))
ATTR_WEB_V1 = v1()
ATTR_WEB_IMP = v1(imp=True)
ATTR_WEB_INITIAL = v1(own_name=False)
ATTR_RANGE_DIRECT = v1(("Addi",), start=RANGE_START, end=RANGE_END)
ATTR_RANGE_V1 = v1(start=RANGE_START, end=RANGE_END)


def v2(until: str | None = None, months_back: int | None = None, start: str | None = None, log: str = "fx_postback") -> str:
    near = f"CAST(t AS DATE) >= DATE '{until}' - to_months({months_back})" if months_back else "true"
    payload = "conv_meta := conv_meta, conv_value := conv_value"
    return _with(WAYS, events(", g.conv_meta, g.conv_value", within=_in_range(start, until)), views(until, log),
                 _first_event(f"e.conv_meta, e.conv_value, {_TIMES}, f.box AS stp_id, f.phone AS m_adid, f.raw AS raw_ip",
                              f", {payload}"), near=near, log=log)


ATTR_WEB_V2 = v2()
ATTR_WEB_HOME = v2(HOME_END, 6, log="fx_postback_long")


def _every_event(way: str) -> str:
    """All events after the touch, not the first of a day."""
    return f"""SELECT DISTINCT cmp_no, pid, eid, log_time, ev, scroll, click, conv_type, conv_value, conv_meta,
  strftime(hit, '%Y-%m-%d') AS mall_dt, strftime(f.t, {STAMP}) AS post_datetime, strftime(hit, {STAMP}) AS mall_datetime,
  ip AS mall_ip, '{way}' AS cate, f.box AS stp_id, f.phone AS m_adid, f.raw AS raw_ip, {DAY_PARTS.format('hit')}
 FROM happened JOIN touch_{way} USING (cmp_no, ip) WHERE hit > f.t"""


def v3(start: str | None = None, end: str | None = None) -> str:
    columns = (", g.log_time, g.eid, TRY_CAST(trim(CAST(g.scroll AS VARCHAR)) AS BIGINT) AS scroll, g.click, g.conv_type, "
               "g.conv_value, g.conv_meta")
    return _with(WAYS, events(columns, blank_counts=False, within=_in_range(start, end)), views(end), _every_event, latest_visit=True)


ATTR_WEB_V3 = v3()
ATTR_RANGE_IMP = v1(imp=True, start=RANGE_START, end=RANGE_END)
ATTR_RANGE_V2 = v2(RANGE_END, start=RANGE_START)
ATTR_RANGE_V3 = v3(RANGE_START, RANGE_END)

CHECK_RAW_LOADS = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS table_name, mall_dt, count(*) AS row_cnt, count(DISTINCT mall_ip) AS unique_ip_cnt, "
    f"count(DISTINCT cmp_no) AS cmp_no_cnt FROM ({sql}) GROUP BY mall_dt"
    for table, sql in (("raw_conv_web", ATTR_WEB_V1), ("raw_conv_web_home", ATTR_WEB_HOME), ("raw_conv_web_v2", ATTR_WEB_V2),
                       ("raw_conv_web_v3", ATTR_WEB_V3), ("raw_conv_web_imp", ATTR_WEB_IMP)))
