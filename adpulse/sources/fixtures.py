"""Look-alike inputs in the reference's schemas, derived from the driver's tables.

Each ``fx_*`` function returns a Spark DataFrame computed from a base table,
so its size grows with the scale factor.  ``FX_SQL`` holds the same
projection written for DuckDB; the oracle queries splice it in as a CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.rules import DailyRules, ReachRules
from .tables import load

# The look-alike installation: its media, its target and its inventories by ad group, app
# bundles that the carrier rules tell apart, and the ctv_media values of the channel report.
MEDIA_CODES = ["EXCHANGE1", "EXCHANGE2", "EXCHANGE3", "TRYOUT", "M4"]
OWN_MEDIA = "OWNBIDS"
GROUP_INVENTORY = {8: "tv.first", 9: "tv.second", 11: "tv.third"}
APP_BUNDLES = ["com.kt.tv", "skb.kt", "uplus.tv", "lguplus.app", "market", "u+tv"]
CTV_MEDIA = ["KT_olleh", "lguplus", "skb_btv", "other"]
TARGET_ID = "tv-target"
DAILY_RULES = DailyRules(target_id=TARGET_ID, area_media=MEDIA_CODES[0], app_media=tuple(MEDIA_CODES[:3]), test_media=MEDIA_CODES[3])
REACH_RULES = ReachRules(media=(*MEDIA_CODES[:2], MEDIA_CODES[3]), daily_media=MEDIA_CODES[0], app_media=tuple(MEDIA_CODES[:2]),
                         test_media=MEDIA_CODES[3], group_inventory=GROUP_INVENTORY)


def _pick(values: list[str], idx: str, dialect: str) -> str:
    """CASE expression choosing ``values[idx]`` (idx is an integer expression)."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {idx} {whens} END"


def _postback_cols(dialect: str) -> list[str]:
    """Select-list items of the postback projection, in the given SQL dialect."""
    div = "div" if dialect == "spark" else "//"
    s = "string" if dialect == "spark" else "varchar"
    if dialect == "spark":
        fmt = "format_string('%.2f', value)"
        y, m, d, h = ("date_format(ts, 'yyyy')", "date_format(ts, 'MM')",
                      "date_format(ts, 'dd')", "date_format(ts, 'HH')")
        iso = "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), 'Z')"
    else:
        fmt = "printf('%.2f', value)"
        y, m, d, h = ("strftime(ts, '%Y')", "strftime(ts, '%m')",
                      "strftime(ts, '%d')", "strftime(ts, '%H')")
        iso = "strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'"
    return [
        f"concat('r', cast(event_id {div} 4 as {s})) AS req_id",
        "CASE event_type WHEN 'view' THEN 'i' WHEN 'click' THEN 'c' "
        "WHEN 'purchase' THEN 'v_complete' WHEN 'signup' THEN CASE cast(event_id % 3 as int) WHEN 0 THEN 'v_firstQ' "
        "WHEN 1 THEN 'v_mid' ELSE 'v_thirdQ' END "
        "WHEN 'error' THEN 'e_i' END AS log_type",
        "CASE WHEN event_type IN ('purchase', 'view') THEN '1' ELSE '0' END AS is_cpvc",
        f"CASE WHEN event_id % 97 = 0 AND event_type NOT IN ('purchase', 'view') THEN 'n/a' ELSE {fmt} END AS price",
        f"{_pick(MEDIA_CODES, 'cast(user_id % 5 as int)', dialect)} AS media_id",
        "CASE WHEN event_id % 50 = 7 THEN NULL ELSE user_id % 10 END AS cmp_no",
        "user_id % 30 AS ag_no",
        "user_id % 60 AS creative_no",
        f"concat('stb-', cast(user_id as {s})) AS ifa",
        # An ad group has one app, but group 6 has two.
        f"concat('app', cast(CASE WHEN user_id % 30 = 6 THEN user_id % 60 ELSE user_id % 30 END % 7 as {s})) AS app_id",
        f"{_pick(APP_BUNDLES, 'cast(user_id % 6 as int)', dialect)} AS app_bundle",
        "CASE cast(user_id % 6 as int) WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '-99' "
        f"WHEN 3 THEN 'undefined' ELSE cast(user_id % 50 as {s}) END AS area_cd",
        f"concat('RG', cast(user_id % 30 as {s})) AS region",
        f"CASE WHEN user_id % 4 = 0 THEN '{TARGET_ID}' "
        f"ELSE concat('g', cast(user_id % 4 as {s})) END AS g_targetid",
        f"{_pick(CTV_MEDIA, 'cast(user_id % 4 as int)', dialect)} AS ctv_media",
        f"concat('ct', cast(user_id % 9 as {s})) AS content_id",
        f"concat('10.0.', cast(user_id % 40 as {s}), '.', cast(event_id % 5 as {s})) AS request_ip",
        f"{iso} AS created_at",
        f"{y} AS year", f"{m} AS month", f"{d} AS day", f"{h} AS hour",
    ]


def fx_postback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postback log (ABI/APM/NHN shape) projected from ``events``."""
    return load(spark, sf_dir, "events").selectExpr(*_postback_cols("spark"))


# A third of the boxes also logged eight months earlier, when ids were not yet sent.
_EARLIER = "user_id % 3 = 0 AND event_id % 2 = 0"
_LONG_FROM = (f"(SELECT event_id, user_id, event_type, value, CASE WHEN {_EARLIER} THEN ts - INTERVAL 240 DAY ELSE ts END AS ts, "
              f"{_EARLIER} AS earlier FROM {{}})")


def _long_cols(dialect: str) -> list[str]:
    return [c.removesuffix(" AS ifa").join(("CASE WHEN NOT earlier THEN ", " END AS ifa")) if c.endswith(" AS ifa") else c
            for c in _postback_cols(dialect)]


def fx_postback_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postback log with a part that lies before a six-month lookback."""
    spark_from = _LONG_FROM.format("{events}")
    return spark.sql(f"SELECT {', '.join(_long_cols('spark'))} FROM {spark_from}", events=load(spark, sf_dir, "events"))


def fx_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media dimension (mediacd, logparsefg) projected from ``region``; the third code is listed twice."""
    region = load(spark, sf_dir, "region")
    return region.unionByName(region.where("r_regionkey = 2")).selectExpr(
        f"{_pick(MEDIA_CODES, 'r_regionkey', 'spark')} AS mediacd",
        "CASE WHEN r_regionkey = 3 THEN 'N' ELSE 'Y' END AS logparsefg")


def fx_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange rates (regd yyyymmdd, exchangerate) projected from ``nation``."""
    return load(spark, sf_dir, "nation").selectExpr(
        "CAST(CASE WHEN n_nationkey < 12 THEN 20231201 + n_nationkey * 2 "
        "ELSE 20240101 + (n_nationkey - 12) * 2 END AS BIGINT) AS regd",
        "1300.0 + n_nationkey * 1.25 AS exchangerate")


def fx_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area mapping list (areacd, google_ab_region) projected from ``nation``."""
    return load(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey + 100 as string) AS areacd",
        "concat('RG', cast(n_nationkey as string)) AS google_ab_region")



def _dialect(dialect: str):
    if dialect == "spark":
        return dict(s="string", div="div",
                    fmt=lambda c, f: f"date_format({c}, '{f}')",
                    addd=lambda d, n: f"date_add(DATE'{d}', cast({n} as int))",
                    addm=lambda d, n: f"add_months(DATE'{d}', cast({n} as int))")
    jfmt = {"yyyy": "%Y", "MM": "%m", "dd": "%d", "HH": "%H", "mm": "%M", "ss": "%S"}

    def fmt(c, f):
        for k, v in jfmt.items():
            f = f.replace(k, v)
        return f"strftime({c}, '{f.replace(chr(39) + 'T' + chr(39), 'T')}')"
    return dict(s="varchar", div="//", fmt=fmt,
                addd=lambda d, n: f"(DATE '{d}' + CAST({n} AS INTEGER))",
                addm=lambda d, n: f"CAST(DATE '{d}' + to_months(CAST({n} AS INTEGER)) AS DATE)")


def _gtm_cols(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s = x["s"]
    return [
        f"{x['fmt']('ts', 'yyyy/MM/dd/HH:mm:ss')} AS log_time",
        f"concat('e', cast(event_id as {s})) AS eid",
        "CASE WHEN event_type = 'purchase' THEN 'conversion' ELSE event_type END AS ev",
        f"CASE WHEN event_id % 3 = 0 THEN cast(event_id % 100 as {s}) WHEN event_id % 3 = 1 THEN ' ' END AS scroll",
        "CASE WHEN event_type = 'click' AND event_id % 2 = 0 THEN 'cta' END AS click",
        f"CASE WHEN event_type = 'purchase' AND user_id % 3 <> 0 THEN concat('buy', cast(user_id % 3 as {s})) END"
        " AS conv_type",
        f"CASE WHEN event_type = 'purchase' THEN cast(value as {s}) END AS conv_value",
        "CAST(NULL AS " + s + ") AS conv_meta",
        f"concat('px', cast(user_id % 10 as {s})) AS pid",
        f"CASE WHEN event_id % 53 = 0 THEN ' ' ELSE concat('10.0.', cast(user_id % 40 as {s}), '.', "
        f"cast(event_id % 5 as {s})) END AS ip",
        f"CASE WHEN event_id % 3 = 0 THEN concat('https://shop.example.com/p?utm_campaign=', "
        f"cast(1000 + user_id % 12 as {s}), '&src=tv') WHEN event_id % 3 = 1 THEN 'https://shop.example.com/p?utm_campaign=' "
        "ELSE 'https://shop.example.com/p' END AS url",
        f"CASE WHEN event_id % 4 = 0 THEN concat('gc', cast(event_id % 40 as {s})) END AS gclid",
        f"{x['fmt']('ts', 'yyyy')} AS year", f"{x['fmt']('ts', 'MM')} AS month", f"{x['fmt']('ts', 'dd')} AS day",
    ]


def fx_gtm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web (GTM) event log projected from ``events``."""
    return load(spark, sf_dir, "events").selectExpr(*_gtm_cols("spark"))


def _info_cols(dialect: str) -> list[str]:
    s = _dialect(dialect)["s"]
    return ["CAST(n_nationkey AS BIGINT) AS cmp_no", f"concat('px', cast(n_nationkey as {s})) AS pixel_id_web",
            f"concat('app', cast(n_nationkey % 7 as {s})) AS pixel_id",
            f"cast(1000 + n_nationkey as {s}) AS cmp_you_no",
            f"CASE WHEN n_nationkey % 2 = 0 THEN 'singular' ELSE 'appsflyer' END AS app_mmp_cd"]


def fx_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign info (cmp_no, pixel ids, ad-platform campaign id) from ``nation``."""
    return load(spark, sf_dir, "nation").selectExpr(*_info_cols("spark"))


def _visit_cols(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s, at = x["s"], x["addd"]("2023-08-01", "o_orderkey % 160")
    ts = f"({at} + INTERVAL 1 HOUR * CAST(o_orderkey % 24 AS INTEGER))" if dialect != "spark" else \
        f"(cast({at} as timestamp) + make_interval(0, 0, 0, 0, cast(o_orderkey % 24 as int), 0, 0))"
    return [
        f"concat('ad-', cast(o_custkey % 500 as {s})) AS ifa",
        f"concat('10.0.', cast(o_orderkey % 40 as {s}), '.', cast(o_orderkey % 7 as {s})) AS request_ip",
        f"concat({x['fmt'](ts, 'yyyy-MM-dd')}, 'T', {x['fmt'](ts, 'HH:mm:ss')}, 'Z') AS created_at",
        f"{x['fmt'](ts, 'yyyy')} AS year", f"{x['fmt'](ts, 'MM')} AS month", f"{x['fmt'](ts, 'dd')} AS day",
    ]


def fx_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ABI visit log (mobile ifa, ip, time) projected from ``orders``."""
    return load(spark, sf_dir, "orders").selectExpr(*_visit_cols("spark"))


def _skb_cols(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s, m = x["s"], x["addm"]("2023-08-01", "p_partkey % 6")
    return [f"concat('ad-', cast(p_partkey % 500 as {s})) AS ad_id",
            f"concat('stb-', cast(p_partkey % 150 as {s})) AS platform_ad_id",
            f"{x['fmt'](m, 'yyyy')} AS year", f"{x['fmt'](m, 'MM')} AS month"]


def fx_skb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set-top-box to mobile-id bridge (monthly) projected from ``part``."""
    return load(spark, sf_dir, "part").selectExpr(*_skb_cols("spark"))


def _tg_cols(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s, m = x["s"], x["addm"]("2023-08-01", "c_custkey % 6")
    return [f"CASE WHEN c_custkey % 10 = 0 THEN '10.9.9.9' ELSE concat('10.0.', cast(c_custkey % 40 as {s}), '.', "
            f"cast(c_custkey % 7 as {s})) END AS ip",
            f"concat('ad-', cast(c_custkey % 500 as {s})) AS uuid",
            f"{x['fmt'](m, 'yyyy')} AS year", f"{x['fmt'](m, 'MM')} AS month"]


def fx_tg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mobile-id to ip graph (monthly) projected from ``customer``."""
    return load(spark, sf_dir, "customer").selectExpr(*_tg_cols("spark"))


def _app_cols(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s = x["s"]
    num = "format_string('%.2f', value)" if dialect == "spark" else "printf('%.2f', value)"
    return [f"concat({x['fmt']('ts', 'yyyy-MM-dd')}, 'T', {x['fmt']('ts', 'HH:mm:ss')}, 'Z') AS created_at",
            "CASE WHEN user_id % 2 = 0 THEN 'singular' ELSE 'appsflyer' END AS tracker",
            f"CASE WHEN event_id % 29 = 0 THEN ' ' ELSE cast(user_id % 12 as {s}) END AS cmp",
            "event_type AS event",
            f"CASE WHEN event_id % 31 = 0 THEN '' ELSE concat('10.1.', cast(user_id % 40 as {s}), '.', "
            f"cast(event_id % 3 as {s})) END AS ip",
            f"CASE WHEN event_type = 'purchase' THEN {num} WHEN event_type = 'signup' THEN ' ' ELSE 'x' END AS revenue",
            "CASE WHEN event_id % 11 = 0 THEN 'TEST' WHEN event_id % 11 = 1 THEN ' TEST ' END AS click_id"]


def fx_app(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third-party app postback log projected from ``events``."""
    return load(spark, sf_dir, "events").selectExpr(*_app_cols("spark"))


def _gclid_cols(dialect: str) -> list[str]:
    s = _dialect(dialect)["s"]
    return ["CAST(1000 + s_suppkey % 12 AS BIGINT) AS cmp_you_no", f"concat('gc', cast(s_suppkey % 40 as {s})) AS gclid"]


def fx_gclid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-platform click-id list (cmp_you_no, gclid) projected from ``supplier``."""
    return load(spark, sf_dir, "supplier").selectExpr(*_gclid_cols("spark"))


def _metric_cols(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s, d = x["s"], x["addd"]("2024-01-01", "l_orderkey % 30")
    return [f"{x['fmt'](d, 'yyyy-MM-dd')} AS date", "CAST(1000 + l_partkey % 30 AS BIGINT) AS campaign_no",
            f"CASE WHEN l_partkey % 30 = 7 THEN NULL ELSE concat('yt', cast(l_partkey % 30 as {s})) END AS campaign_name",
            "CAST(l_quantity AS BIGINT) AS impressions", "CAST(l_linenumber AS BIGINT) AS clicks",
            "CAST(l_quantity AS BIGINT) % 7 AS trueviews", "round(l_discount * 10, 2) AS conversions"]


def fx_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-platform daily campaign metrics projected from ``lineitem``."""
    return load(spark, sf_dir, "lineitem").selectExpr(*_metric_cols("spark"))


def _ytlist_cols(dialect: str) -> list[str]:
    s = _dialect(dialect)["s"]
    return ["CAST(p_partkey % 25 AS BIGINT) AS campaign_no", f"cast(1000 + p_partkey % 40 as {s}) AS campaign_id"]


def fx_ytlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-platform campaign list (campaign_no, campaign_id) projected from ``part``."""
    return load(spark, sf_dir, "part").selectExpr(*_ytlist_cols("spark"))


def _hour_parts(x, ts: str) -> list[str]:
    return [f"{x['fmt'](ts, 'yyyy')} AS year", f"{x['fmt'](ts, 'MM')} AS month",
            f"{x['fmt'](ts, 'dd')} AS day", f"{x['fmt'](ts, 'HH')} AS hour"]


def _apm_flat_cols(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s = x["s"]
    ip = f"concat('10.0.', cast(user_id % 40 as {s}), '.', cast(event_id % 5 as {s}))"
    return [f"{_pick(APP_BUNDLES, 'cast(user_id % 6 as int)', dialect)} AS app_bundle",
            f"CASE WHEN event_id % 41 = 0 THEN 'undefined' WHEN event_id % 43 = 0 THEN ' ' "
            f"ELSE concat('STB-', cast(user_id as {s})) END AS ifa",
            f"CASE WHEN event_id % 37 = 0 THEN '::1' WHEN event_id % 7 = 0 THEN concat('::ffff:', {ip}) "
            f"ELSE {ip} END AS ip"] + _hour_parts(x, "ts")


def fx_apm_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened APM bid log (set-top id, ip, app bundle) projected from ``events``."""
    return load(spark, sf_dir, "events").selectExpr(*_apm_flat_cols("spark"))


def _addi_bid_cols(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s = x["s"]
    d = x["addd"]("2024-01-01", "o_orderkey % 30")
    ts = (f"(cast({d} as timestamp) + make_interval(0, 0, 0, 0, cast(o_orderkey % 24 as int), 0, 0))"
          if dialect == "spark" else f"({d} + INTERVAL 1 HOUR * CAST(o_orderkey % 24 AS INTEGER))")
    return [f"CASE WHEN o_orderkey % 3 = 0 THEN '{OWN_MEDIA}' ELSE 'M4' END AS media_id",
            f"concat('stb-', cast(o_custkey % 150 as {s})) AS device_ifa",
            f"CASE WHEN o_orderkey % 13 = 0 THEN '10.9.9.9' ELSE concat('10.0.', cast(o_orderkey % 40 as {s}), '.', "
            f"cast(o_orderkey % 5 as {s})) END AS device_ip",
            f"{_pick(APP_BUNDLES, 'cast(o_orderkey % 6 as int)', dialect)} AS app_bundle"] + _hour_parts(x, ts)


def fx_addi_bid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened own-exchange bid log projected from ``orders`` (January 2024)."""
    return load(spark, sf_dir, "orders").selectExpr(*_addi_bid_cols("spark"))


def _nhn_flat_cols(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s = x["s"]
    d = x["addd"]("2024-01-01", "l_orderkey % 30")
    ts = (f"(cast({d} as timestamp) + make_interval(0, 0, 0, 0, cast(l_linenumber as int), 0, 0))"
          if dialect == "spark" else f"({d} + INTERVAL 1 HOUR * CAST(l_linenumber AS INTEGER))")
    return [f"CASE WHEN l_orderkey % 17 = 0 THEN '10.9.9.9' ELSE concat('10.0.', cast(l_partkey % 500 % 40 as {s}), "
            f"'.', cast(l_partkey % 500 % 5 as {s})) END AS device_ip",
            f"concat('AD-', cast(l_partkey % 500 as {s})) AS device_ifa"] + _hour_parts(x, ts)


def fx_nhn_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened NHN bid log (mobile ifa, ip) projected from ``lineitem`` (January 2024)."""
    return load(spark, sf_dir, "lineitem").selectExpr(*_nhn_flat_cols("spark"))


def _bid_log_cols(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s, div = x["s"], x["div"]
    # Of a request's four ids the first won the postbacks; the others were bids without one.
    rid = f"CASE WHEN event_id % 4 = 0 THEN concat('r', cast(event_id {div} 4 as {s})) ELSE concat('lost', cast(event_id as {s})) END"
    fields = [("req_id", rid), ("media_id", _pick(MEDIA_CODES, 'cast(user_id % 5 as int)', dialect)),
              ("app_bundle", _pick(APP_BUNDLES, 'cast(user_id % 6 as int)', dialect)),
              ("content_id", f"concat('ct', cast(user_id % 9 as {s}))")]
    if dialect == "spark":
        req = "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields) + ")"
    else:
        req = "struct_pack(" + ", ".join(f"{n} := {e}" for n, e in fields) + ")"
    return [f"{req} AS req"] + _hour_parts(x, "ts")


def fx_bid_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat bid log with a ``req`` struct, one bid for each row of ``events``; one in four
    is of a request that has postbacks."""
    return load(spark, sf_dir, "events").selectExpr(*_bid_log_cols("spark"))


def _flight_cols(dialect: str, campaign: bool) -> list[str]:
    s = _dialect(dialect)["s"]
    k = "n_nationkey"
    if campaign:
        return [f"CAST({k} AS BIGINT) AS cmpno",
                f"concat('2024-01-', lpad(cast(1 + {k} % 5 as {s}), 2, '0'), ' 00:00:00') AS startdt",
                f"concat('2024-01-', lpad(cast(18 + {k} % 10 as {s}), 2, '0'), ' 23:59:59') AS enddt"]
    return [f"CAST({k} AS BIGINT) AS agno",
            f"concat('2024-01-', lpad(cast(1 + {k} % 10 as {s}), 2, '0'), ' 00:00:00') AS startdt",
            f"concat('2024-01-', lpad(cast(19 + {k} % 11 as {s}), 2, '0'), ' 23:59:59') AS enddt",
            f"CASE WHEN {k} % 7 = 0 THEN 'N' ELSE 'Y' END AS logparsefg"]


def fx_adgroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-group flights (agno, startdt, enddt, logparsefg) projected from ``nation``."""
    return load(spark, sf_dir, "nation").selectExpr(*_flight_cols("spark", False))


def fx_adcampaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign flights (cmpno, startdt, enddt) projected from ``nation``."""
    return load(spark, sf_dir, "nation").selectExpr(*_flight_cols("spark", True))


FX_SQL = {
    "fx_postback": "SELECT " + ",\n  ".join(_postback_cols("duckdb")) + " FROM events",
    "fx_postback_long": "SELECT " + ", ".join(_long_cols("duckdb")) + " FROM " + _LONG_FROM.format("events"),
    "fx_media": f"SELECT {_pick(MEDIA_CODES, 'r_regionkey', 'duckdb')} AS mediacd, "
                "CASE WHEN r_regionkey = 3 THEN 'N' ELSE 'Y' END AS logparsefg "
                "FROM (SELECT * FROM region UNION ALL SELECT * FROM region WHERE r_regionkey = 2)",
    "fx_rate": "SELECT CAST(CASE WHEN n_nationkey < 12 THEN 20231201 + n_nationkey * 2 "
               "ELSE 20240101 + (n_nationkey - 12) * 2 END AS BIGINT) AS regd, "
               "1300.0 + n_nationkey * 1.25 AS exchangerate FROM nation",
    "fx_area": "SELECT cast(n_nationkey + 100 as varchar) AS areacd, "
               "'RG' || cast(n_nationkey as varchar) AS google_ab_region FROM nation",
    "fx_gtm": "SELECT " + ", ".join(_gtm_cols("duckdb")) + " FROM events",
    "fx_info": "SELECT " + ", ".join(_info_cols("duckdb")) + " FROM nation",
    "fx_visit": "SELECT " + ", ".join(_visit_cols("duckdb")) + " FROM orders",
    "fx_skb": "SELECT " + ", ".join(_skb_cols("duckdb")) + " FROM part",
    "fx_tg": "SELECT " + ", ".join(_tg_cols("duckdb")) + " FROM customer",
    "fx_app": "SELECT " + ", ".join(_app_cols("duckdb")) + " FROM events",
    "fx_gclid": "SELECT " + ", ".join(_gclid_cols("duckdb")) + " FROM supplier",
    "fx_metric": "SELECT " + ", ".join(_metric_cols("duckdb")) + " FROM lineitem",
    "fx_ytlist": "SELECT " + ", ".join(_ytlist_cols("duckdb")) + " FROM part",
    "fx_apm_flat": "SELECT " + ", ".join(_apm_flat_cols("duckdb")) + " FROM events",
    "fx_addi_bid": "SELECT " + ", ".join(_addi_bid_cols("duckdb")) + " FROM orders",
    "fx_nhn_flat": "SELECT " + ", ".join(_nhn_flat_cols("duckdb")) + " FROM lineitem",
    "fx_adgroup": "SELECT " + ", ".join(_flight_cols("duckdb", False)) + " FROM nation",
    "fx_adcampaign": "SELECT " + ", ".join(_flight_cols("duckdb", True)) + " FROM nation",
    "fx_bid_log": "SELECT " + ", ".join(_bid_log_cols("duckdb")) + " FROM events",
}


def with_fixtures(sql: str, *names: str, ctes: tuple[str, ...] | list[str] = ()) -> str:
    """Prefix an oracle query with the fixture CTEs it reads, then ``ctes``."""
    parts = [f"{n} AS ({FX_SQL[n]})" for n in names] + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n" + sql
