"""Nested bid-log look-alikes (request with impressions, response with seat
bids) built from ``orders`` left-joined to ``lineitem``: one request per
order, one impression and one seat bid per line (the second line's bidding on another
impression id).  Orders without lines have no
impressions; every 11th order has no response."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import APP_BUNDLES, MEDIA_CODES
from .tables import load


def _pick(values: list[str], c) -> F.Column:
    e = None
    for i, v in enumerate(values):
        e = F.when(c == i, F.lit(v)) if e is None else e.when(c == i, F.lit(v))
    return e


# The record's further fields by path: i a number, b 0 or 1, s a text, a a list of texts.
# Every seventh request has none of a branch's parent records, so that null branches occur.
MORE_IMP = {"video": {"mimes": "a", "linearity": "i", "minduration": "i", "maxduration": "i", "w": "i", "h": "i", "startdelay": "i",
                      "pos": "i", "api": "a", "companionad": "a"},
            "native": "s", "displaymanager": "s", "instl": "b", "exp": "i", "ext": {"billing_id": "a"}}
MORE_REQ = {"site": {"page": "s", "publisher": {"id": "s"}, "mobile": "b",
                     "content": {"genre": "s", "contentrating": "s", "livestream": "b", "producer": "s", "language": "s"}},
            "ext": {"bid_feedback": "s", "google_query_id": "s", "fcap_scope": "i",
                    "privacy_treatments": {"allow_user_data_collection": "b"}}, "bcat": "a"}
MORE_APP = {"ver": "s", "storeurl": "s", "content": {"data": "s", "url": "s", "producer": {"id": "s", "domain": "s"}, "language": "s",
                                                     "livestream": "b", "userrating": "s", "genre": "s"}}
MORE_GEO = {"city": "s", "region": "s", "utcoffset": "i", "accuracy": "i", "zip": "s"}
MORE_DEVICE = {"ua": "s", "carrier": "s", "make": "s", "model": "s", "osv": "s", "devicetype": "i", "connectiontype": "i", "w": "i", "h": "i",
               "pxratio": "i", "lmt": "b",
               "sua": {"browsers": "n", "platform": {"brand": "s", "version": "s"}, "mobile": "b", "bitness": "s", "model": "s", "architecture": "s"}}


# The second nested log and the flat one, in the same notation; m is a list of metrics, d one of deals.
NESTED_IMP = {"tagid": "s", "bidfloor": "i", "bidfloorcur": "s", "secure": "b", "deal_type": "s", "ad_type": "s",
              "banner": {"w": "i", "h": "i", "pos": "i"}, "displaymanager": "s", "instl": "b", "metric": "m",
              "native": {"request": "s", "ver": "s", "api": "a", "battr": "a"}}
NESTED_REQ = {
    "at": "i", "tmax": "i", "cur": "a", "bcat": "a", "badv": "a", "media_id": "s", "user": {"id": "s"},
    "site": {"page": "s", "id": "s", "domain": "s", "name": "s", "cat": "a", "mobile": "b",
             "publisher": {"id": "s", "name": "s", "domain": "s"}},
    "device": {"ua": "s", "ip": "s", "os": "s", "osv": "s", "ifa": "s", "lmt": "b", "carrier": "s", "make": "s", "model": "s",
               "devicetype": "i", "language": "s", "connectiontype": "i", "pxratio": "i", "w": "i", "h": "i",
               "geo": {"country": "s", "lat": "i", "lon": "i", "city": "s", "type": "i", "zip": "s", "region": "s", "utcoffset": "i",
                       "accuracy": "i"},
               "sua": {"browsers": "n", "platform": {"brand": "s", "version": "s"}, "mobile": "b", "source": "i",
                       "architecture": "s", "bitness": "s", "model": "s"}},
    "app": {"name": "s", "ver": "s", "bundle": "s", "storeurl": "s", "id": "s", "cat": "a",
            "publisher": {"id": "s", "name": "s", "domain": "s"},
            "content": {"url": "s", "language": "s", "userrating": "s", "genre": "s", "producer": "s"}}}
NESTED_BID = {"price": "i", "crid": "s", "cmp_no": "i", "ag_no": "i", "crtv_no": "i"}
FLAT_IMP = {"tagid": "s", "bidfloorcur": "s", "bidfloor": "i", "deals": "d", "deal_type": "s", "mimes": "a", "minduration": "i",
            "maxduration": "i", "w": "i", "h": "i", "ad_type": "s"}
FLAT_REQ = {"at": "i", "media_id": "s", "app_id": "s", "app_name": "s", "app_bundle": "s", "app_cate": "a", "site_id": "s",
            "site_name": "s", "site_domain": "s", "site_cate": "a", "publisher_id": "s", "publisher_name": "s",
            "publisher_domain": "s", "publisher_cate": "a", "ifa": "s", "language": "s", "os": "s", "ip": "s", "devicetype": "i",
            "content_id": "s", "content_title": "s", "content_genre": "s", "contentrating": "s", "country": "s", "zipcode": "s"}
FLAT_BID = {"price": "i", "deal_id": "s", "bid_crtv_no": "i", "bid_cmp_no": "i", "bid_ag_no": "i"}


def _salt(path: str) -> int:
    return sum(map(ord, path)) % 11


def _spark_fields(fields: dict, key, path: str = "") -> list:
    """Struct fields of the given shape, whose values follow from the key."""
    out = []
    for name, kind in fields.items():
        at = f"{path}.{name}"
        n = (key + _salt(at)) % 13
        text = F.concat(F.lit(f"{name}-"), _s(n))
        if isinstance(kind, dict):
            v = F.when((key + _salt(at)) % 7 != 0, F.struct(*_spark_fields(kind, key, at)))
        elif kind == "n":
            v = F.when(n > 3, F.array(F.struct(F.concat(F.lit("br"), _s(n)).alias("brand"), _s(n).alias("version"))))
        elif kind == "m":
            one = F.array(F.struct(text.alias("type"), n.cast("int").alias("value"), F.concat(F.lit("v"), _s(n)).alias("vendor")))
            v = F.when(n > 9, F.concat(one, one)).when(n > 3, one).otherwise(F.slice(one, 1, 0))
        elif kind == "d":
            v = F.when(n > 2, F.array(F.struct(text.alias("id"), n.cast("int").alias("at"))))
        else:
            v = {"i": n.cast("int"), "b": (n % 2).cast("int"), "s": F.when(n > 0, text), "a": F.array(text, F.lit("x"))}[kind]
        out.append(v.alias(name))
    return out


def _duck_fields(fields: dict, key: str, path: str = "") -> str:
    out = []
    for name, kind in fields.items():
        at = f"{path}.{name}"
        n = f"(({key} + {_salt(at)}) % 13)"
        if isinstance(kind, dict):
            v = f"CASE WHEN ({key} + {_salt(at)}) % 7 <> 0 THEN struct_pack({_duck_fields(kind, key, at)}) END"
        elif kind == "n":
            v = f"CASE WHEN {n} > 3 THEN [struct_pack(brand := 'br' || {n}, version := CAST({n} AS VARCHAR))] END"
        elif kind == "m":
            one = f"struct_pack(type := CASE WHEN {n} > 0 THEN '{name}-' || {n} END, value := CAST({n} AS INTEGER), vendor := 'v' || {n})"
            v = f"CASE WHEN {n} > 9 THEN [{one}, {one}] WHEN {n} > 3 THEN [{one}] ELSE [] END"
        elif kind == "d":
            v = f"CASE WHEN {n} > 2 THEN [struct_pack(id := '{name}-' || {n}, at := CAST({n} AS INTEGER))] END"
        else:
            v = {"i": f"CAST({n} AS INTEGER)", "b": f"CAST({n} % 2 AS INTEGER)", "s": f"CASE WHEN {n} > 0 THEN '{name}-' || {n} END",
                 "a": f"['{name}-' || {n}, 'x']"}[kind]
        out.append(f'"{name}" := {v}')
    return ", ".join(out)


def _s(c) -> F.Column:
    return c.cast("string")


def _line_lists(o: DataFrame, li: DataFrame) -> DataFrame:
    """The requests with ``_n``, the number of their lines, and ``_lines``, the lines as they
    are in the table, sorted.  Impressions and bids are made from the lines after that, so
    that what is shuffled and gathered stays narrow."""
    fields = [c for c in li.columns if c != "l_orderkey"]
    # collect_list has no order, and line numbers repeat within an order: every field is a sort key.
    return (o.join(li, F.col("l_orderkey") == F.col("o_orderkey"), "left").groupBy(*o.columns)
            .agg(F.count("l_orderkey").alias("_n"), F.sort_array(F.collect_list(F.struct(*fields))).alias("_lines")))


def _nested_imp(z) -> F.Column:
    ln, pk, sk = z["l_linenumber"], z["l_partkey"], z["l_suppkey"]
    m_view = F.struct(F.lit("viewability").alias("type"), F.round(z["l_tax"] * 10, 4).alias("value"),
                      F.lit("ias").alias("vendor"))
    m_ctr = F.struct(F.lit("click_through_rate").alias("type"), z["l_discount"].alias("value"),
                     F.lit("moat").alias("vendor"))
    metric = (F.when(sk % 3 == 0, F.array(m_view, m_ctr)).when(sk % 3 == 1, F.array(m_ctr))
              .otherwise(F.array().cast("array<struct<type:string,value:double,vendor:string>>")))
    deals = F.array(F.struct(F.concat(F.lit("d"), _s(pk % 9)).alias("id"), F.lit("KRW").alias("bidfloorcur"),
                             z["l_tax"].alias("bidfloor"), F.lit(1).alias("at")))
    return F.struct(F.concat(F.lit("imp"), _s(ln)).alias("id"), F.concat(F.lit("t"), _s(pk % 50)).alias("tagid"),
                    z["l_discount"].alias("bidfloor"), F.lit("KRW").alias("bidfloorcur"),
                    F.when(ln % 2 == 0, "pmp").otherwise("open").alias("deal_type"), deals.alias("deals"),
                    F.struct((300 + ln).cast("int").alias("w"), F.lit(250).alias("h"),
                             (ln % 3).cast("int").alias("pos"),
                             F.array(F.concat(F.lit("f"), _s(ln % 4))).alias("format")).alias("banner"),
                    metric.alias("metric"), F.lit("video").alias("ad_type"), F.lit(1).alias("secure"),
                    *_spark_fields(MORE_IMP, pk + ln))


def _nested_bid(z) -> F.Column:
    ln, pk = z["l_linenumber"], z["l_partkey"]
    return F.struct(F.concat(F.lit("imp"), _s(F.when(ln == 2, 9).otherwise(ln))).alias("impid"),
                    F.format_string("%.2f", z["l_extendedprice"]).alias("price"),
                    F.concat(F.lit("cr"), _s(pk % 30)).alias("crid"), (pk % 60).cast("int").alias("crtv_no"),
                    (pk % 10).cast("int").alias("cmp_no"), (pk % 30).cast("int").alias("ag_no"),
                    F.concat(F.lit("d"), _s(pk % 9)).alias("deal_id"))


def fx_bid_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The fields of a line in the order in which they sort.
    g = _line_lists(load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
                    load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                           "l_extendedprice", "l_discount", "l_tax"))
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    ts = (F.date_add(F.lit("2024-01-01").cast("date"), (ok % 30).cast("int")).cast("timestamp")
          + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), (ok % 24).cast("int")))
    req = F.struct(
        F.concat(F.lit("q"), _s(ok)).alias("id"), (1 + ok % 2).cast("int").alias("at"),
        (100 + ok % 5 * 10).cast("int").alias("tmax"),
        F.when(ok % 3 == 0, F.array(F.lit("KRW"), F.lit("USD"))).otherwise(F.array(F.lit("KRW"))).alias("cur"),
        _pick(MEDIA_CODES, ok % 5).alias("media_id"),
        F.struct(F.concat(F.lit("u"), _s(ck)).alias("id")).alias("user"),
        F.when(F.col("_n") > 0, F.transform("_lines", _nested_imp)).alias("imp"),
        F.struct(F.concat(F.lit("10.0."), _s(ok % 40), F.lit("."), _s(ok % 7)).alias("ip"),
                 F.concat(F.lit("ad-"), _s(ck % 500)).alias("ifa"),
                 F.struct((37.5 + (ok % 10) / 100.0).alias("lat"), (127.0 + (ok % 7) / 100.0).alias("lon"),
                          F.lit("KOR").alias("country"), *_spark_fields(MORE_GEO, ok)).alias("geo"),
                 F.when(ok % 2 == 0, "android").otherwise("tizen").alias("os"),
                 *_spark_fields(MORE_DEVICE, ok)).alias("device"),
        F.struct(_pick(APP_BUNDLES, ok % 6).alias("bundle"), F.concat(F.lit("app"), _s(ok % 6)).alias("name"),
                 F.struct(F.concat(F.lit("pub"), _s(ck % 20)).alias("id")).alias("publisher"),
                 *_spark_fields(MORE_APP, ok)).alias("app"), *_spark_fields(MORE_REQ, ok))
    res = F.when(ok % 11 != 0, F.struct(F.concat(F.lit("res"), _s(ok)).alias("id"),
                                        F.when(F.col("_n") > 0, F.transform("_lines", _nested_bid)).alias("seatbid")))
    return g.select(req.alias("req"),
                    F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("T"), F.date_format(ts, "HH:mm:ss"),
                             F.lit("Z")).alias("created_at"),
                    res.alias("res"), (ok % 4).cast("int").alias("fail_code"),
                    F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month"),
                    F.date_format(ts, "dd").alias("day"), F.date_format(ts, "HH").alias("hour"))


def _case(values: list[str], c: str) -> str:
    return "CASE " + c + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


_IMP = ("struct_pack(id := 'imp' || l_linenumber, tagid := 't' || (l_partkey % 50), bidfloor := l_discount, "
        "bidfloorcur := 'KRW', deal_type := CASE WHEN l_linenumber % 2 = 0 THEN 'pmp' ELSE 'open' END, "
        "deals := [struct_pack(id := 'd' || (l_partkey % 9), bidfloorcur := 'KRW', bidfloor := l_tax, "
        "at := CAST(1 AS INTEGER))], "
        "banner := struct_pack(w := CAST(300 + l_linenumber AS INTEGER), h := CAST(250 AS INTEGER), "
        "pos := CAST(l_linenumber % 3 AS INTEGER), format := ['f' || (l_linenumber % 4)]), "
        "metric := CASE WHEN l_suppkey % 3 = 0 THEN [struct_pack(type := 'viewability', value := round(l_tax * 10, 4), "
        "vendor := 'ias'), struct_pack(type := 'click_through_rate', value := l_discount, vendor := 'moat')] "
        "WHEN l_suppkey % 3 = 1 THEN [struct_pack(type := 'click_through_rate', value := l_discount, "
        "vendor := 'moat')] ELSE [] END, ad_type := 'video', secure := CAST(1 AS INTEGER), "
        + _duck_fields(MORE_IMP, "(l_partkey + l_linenumber)") + ")")
_BID = ("struct_pack(impid := 'imp' || CASE WHEN l_linenumber = 2 THEN 9 ELSE l_linenumber END, "
        "price := printf('%.2f', l_extendedprice), crid := 'cr' || (l_partkey % 30), "
        "crtv_no := CAST(l_partkey % 60 AS INTEGER), cmp_no := CAST(l_partkey % 10 AS INTEGER), "
        "ag_no := CAST(l_partkey % 30 AS INTEGER), deal_id := 'd' || (l_partkey % 9))")
_TS = "(DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) + INTERVAL 1 HOUR * CAST(o_orderkey % 24 AS INTEGER))"

BID_NESTED_SQL = f"""SELECT struct_pack(id := 'q' || o_orderkey, at := CAST(1 + o_orderkey % 2 AS INTEGER),
    tmax := CAST(100 + o_orderkey % 5 * 10 AS INTEGER),
    cur := CASE WHEN o_orderkey % 3 = 0 THEN ['KRW', 'USD'] ELSE ['KRW'] END,
    media_id := {_case(MEDIA_CODES, 'CAST(o_orderkey % 5 AS INTEGER)')},
    "user" := struct_pack(id := 'u' || o_custkey),
    imp := list({_IMP} ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax) FILTER (WHERE l_orderkey IS NOT NULL),
    device := struct_pack(ip := '10.0.' || (o_orderkey % 40) || '.' || (o_orderkey % 7),
        ifa := 'ad-' || (o_custkey % 500),
        geo := struct_pack(lat := CAST(37.5 + (o_orderkey % 10) / 100.0 AS DOUBLE), lon := CAST(127.0 + (o_orderkey % 7) / 100.0 AS DOUBLE),
                           country := 'KOR', {_duck_fields(MORE_GEO, 'o_orderkey')}),
        os := CASE WHEN o_orderkey % 2 = 0 THEN 'android' ELSE 'tizen' END, {_duck_fields(MORE_DEVICE, 'o_orderkey')}),
    app := struct_pack(bundle := {_case(APP_BUNDLES, 'CAST(o_orderkey % 6 AS INTEGER)')},
        name := 'app' || (o_orderkey % 6), publisher := struct_pack(id := 'pub' || (o_custkey % 20)), {_duck_fields(MORE_APP, 'o_orderkey')}),
    {_duck_fields(MORE_REQ, 'o_orderkey')}) AS req,
  strftime({_TS}, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE struct_pack(id := 'res' || o_orderkey,
    seatbid := CASE WHEN count(l_orderkey) = 0 THEN NULL
               ELSE COALESCE(list({_BID} ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax) FILTER (WHERE l_orderkey IS NOT NULL), []) END) END AS res,
  CAST(o_orderkey % 4 AS INTEGER) AS fail_code,
  strftime({_TS}, '%Y') AS year, strftime({_TS}, '%m') AS month, strftime({_TS}, '%d') AS day,
  strftime({_TS}, '%H') AS hour
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_orderkey, o_custkey"""


# The logs made from a shape alone: key of the request's id, of a bid's impression, and the shapes.
SHAPES = {"fx_bid_native": ("id", "impid", NESTED_REQ, NESTED_IMP, NESTED_BID),
          "fx_bid_flat": ("req_id", "imp_id", FLAT_REQ, FLAT_IMP, FLAT_BID)}


def _shaped(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    req_id, imp_id, req_shape, imp_shape, bid_shape = SHAPES[name]
    ok = F.col("o_orderkey")
    g = _line_lists(load(spark, sf_dir, "orders").select("o_orderkey"),
                    load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"))

    def imp(z):
        return F.struct(F.concat(F.lit("imp"), _s(z["l_linenumber"])).alias("id"),
                        *_spark_fields(imp_shape, z["l_partkey"] + z["l_linenumber"]))

    def bid(z):
        on = F.when(z["l_linenumber"] % 3 == 2, 1).otherwise(z["l_linenumber"])
        return F.struct(F.concat(F.lit("imp"), _s(on)).alias(imp_id), *_spark_fields(bid_shape, z["l_partkey"] + z["l_linenumber"] + 1))

    ts = (F.date_add(F.lit("2024-01-01").cast("date"), (ok % 30).cast("int")).cast("timestamp")
          + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), (ok % 24).cast("int")))
    return g.select(
        F.struct(F.concat(F.lit("q"), _s(ok)).alias(req_id), F.when(F.col("_n") > 0, F.transform("_lines", imp)).alias("imp"),
                 *_spark_fields(req_shape, ok)).alias("req"),
        F.when(ok % 11 != 0, F.struct(F.concat(F.lit("res"), _s(ok)).alias("id"),
                                      F.when(F.col("_n") > 0, F.transform("_lines", bid)).alias("seatbid"))).alias("res"),
        F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("T"), F.date_format(ts, "HH:mm:ss"), F.lit("Z")).alias("created_at"),
        (ok % 4).cast("int").alias("fail_code"), F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"), F.date_format(ts, "HH").alias("hour"))


def fx_bid_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second nested log: requests with native impressions, sites and users."""
    return _shaped(spark, sf_dir, "fx_bid_native")


def fx_bid_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with a flat request, whose impressions and seat bids are lists."""
    return _shaped(spark, sf_dir, "fx_bid_flat")


def _shaped_sql(name: str) -> str:
    req_id, imp_id, req_shape, imp_shape, bid_shape = SHAPES[name]
    key, lists = "(l_partkey + l_linenumber)", "ORDER BY l_linenumber, l_partkey) FILTER (WHERE l_orderkey IS NOT NULL)"
    return f"""SELECT struct_pack({req_id} := 'q' || o_orderkey,
    imp := list(struct_pack(id := 'imp' || l_linenumber, {_duck_fields(imp_shape, key)}) {lists}, {_duck_fields(req_shape, 'o_orderkey')}) AS req,
  CASE WHEN o_orderkey % 11 <> 0 THEN struct_pack(id := 'res' || o_orderkey,
    seatbid := list(struct_pack({imp_id} := 'imp' || CASE WHEN l_linenumber % 3 = 2 THEN 1 ELSE l_linenumber END,
                                {_duck_fields(bid_shape, '(l_partkey + l_linenumber + 1)')}) {lists}) END AS res,
  strftime({_TS}, '%Y-%m-%dT%H:%M:%SZ') AS created_at, CAST(o_orderkey % 4 AS INTEGER) AS fail_code,
  strftime({_TS}, '%Y') AS year, strftime({_TS}, '%m') AS month, strftime({_TS}, '%d') AS day, strftime({_TS}, '%H') AS hour
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"""


def _register_sql() -> None:
    from .fixtures import FX_SQL
    FX_SQL["fx_bid_nested"] = BID_NESTED_SQL
    FX_SQL.update({name: _shaped_sql(name) for name in SHAPES})


_register_sql()
