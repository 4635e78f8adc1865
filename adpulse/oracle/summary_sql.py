"""DuckDB oracles for the postback summaries.

Lists instead of conditional counts: each group's rows are gathered once, and every
figure is read off that list.  A month's rate is that of the month before."""

from ..sources.fixtures import MEDIA_CODES, TARGET_ID, with_fixtures

FIX = ("fx_postback", "fx_media", "fx_rate")

# yyyymm -> the last rate registered in the month before it.
_RATE = """rate AS (SELECT CAST(strftime(date_trunc('month', d) + to_months(1), '%Y%m') AS INT) AS ym,
   arg_max(CAST(exchangerate AS DOUBLE), (regd, CAST(exchangerate AS DOUBLE))) AS won
 FROM (SELECT *, try_strptime(CAST(regd AS VARCHAR), '%Y%m%d') AS d FROM fx_rate) WHERE d IS NOT NULL GROUP BY 1)"""

_LABEL = {"hour": ("DATETIME", "year || '-' || month || '-' || day || ' ' || hour || ':00:00'", "year, month, day, hour"),
          "day": ("DATE", "year || '-' || month || '-' || day", "year, month, day")}
# A medium that is listed several times as parsed counts its rows as often.
_TIMES = "greatest(1, (SELECT count(*) FROM fx_media m WHERE m.mediacd = media_id AND m.logparsefg = 'Y'))"
_QUARTILES = {"Q1": "v_firstQ", "Q2": "v_mid", "Q3": "v_thirdQ", "Q4": "v_complete"}


def _rows(cond: str) -> str:
    return f"CAST(list_sum([x.w FOR x IN l IF {cond}]) AS BIGINT)"


def _requests(cond: str) -> str:
    return f"len(list_distinct([x.r FOR x IN l IF {cond} AND x.r IS NOT NULL]))"


def _money(cond: str, none: str) -> str:
    return f"round(ifnull(list_sum([x.p * x.w FOR x IN l IF {cond}]), {none}), 4)"


def _lookup(grain: str, dims: dict[str, str], old_rule: bool) -> tuple[str, dict[str, str]]:
    """Feeds whose price is the request's largest text of the hour (day)."""
    keys = _LABEL[grain][2]
    readable = "true" if old_rule else "TRY_CAST(price AS DOUBLE) IS NOT NULL"
    rows = f"""SELECT *, TRY_CAST(max(price) FILTER ({readable}) OVER (PARTITION BY {keys}, ifnull(req_id, '')) AS DOUBLE) AS best
 FROM fx_postback WHERE cmp_no IS NOT NULL AND ag_no IS NOT NULL AND creative_no IS NOT NULL"""
    item = "struct_pack(r := req_id, k := log_type, c := is_cpvc, p := if(req_id IS NULL, NULL, best), w := w)"
    figures = {"IMPS": _requests("x.k = 'i'"), "CLICKS": f"ifnull({_rows('''x.k = 'c' AND x.r IS NOT NULL''')}, 0)",
               "PAYMENT": _money("x.k = 'i'", "NULL" if old_rule else "if(list_bool_or([x.k IS DISTINCT FROM 'i' FOR x IN l]), 0, NULL)"),
               "PAYMENTCNT": f"CAST({_requests('''x.k <> 'e_i' AND x.c = '1' ''')} AS DOUBLE)",
               **{q: _requests(f"x.k = '{t}'") for q, t in _QUARTILES.items()},
               "ERRORIMPS": f"ifnull({_rows('''x.k = 'e_i' AND x.r IS NOT NULL''')}, 0)",
               "ERRORPAYMENT": _money("x.k = 'e_i'", "if(list_bool_or([x.k IS DISTINCT FROM 'e_i' FOR x IN l]), 0, NULL)")}
    return f"SELECT {item} AS x, * FROM (SELECT *, {_TIMES} AS w FROM ({rows}))", figures


def _dedup(grain: str, dims: dict[str, str]) -> tuple[str, dict[str, str]]:
    """The feed that repeats its rows: whole rows count once."""
    cols = "req_id, cmp_no, ag_no, creative_no, media_id, log_type, is_cpvc, price, " + _LABEL[grain][2]
    extra = "".join(f", {e} AS {n}" for n, e in dims.items())
    rows = f"SELECT DISTINCT {cols}{extra} FROM fx_postback WHERE req_id IS NOT NULL AND cmp_no IS NOT NULL AND ag_no IS NOT NULL AND creative_no IS NOT NULL"
    item = "struct_pack(k := log_type, c := is_cpvc, p := TRY_CAST(price AS DOUBLE), w := 1)"

    def total(value: str, cond: str) -> str:   # 0 unless every row counts and none has a value
        return f"round(ifnull(list_sum([{value} FOR x IN l IF {cond}]), if(list_bool_and([ifnull({cond}, false) FOR x IN l]), NULL, 0)), 4)"

    figures = {"IMPS": f"ifnull({_rows('''x.k = 'i' ''')}, 0)", "CLICKS": f"ifnull({_rows('''x.k = 'c' ''')}, 0)",
               "PAYMENT": total("x.p", "x.c = '1'"), "PAYMENTCNT": total("CAST(x.c AS DOUBLE)", "x.k <> 'e_i'"),
               **{q: f"ifnull({_rows(f'''x.k = '{t}' ''')}, 0)" for q, t in _QUARTILES.items()},
               "ERRORIMPS": "0::BIGINT", "ERRORPAYMENT": "0::DOUBLE"}
    return f"SELECT {item} AS x, * FROM ({rows})", figures


def feed(grain: str, dims: dict[str, str] | None = None, dedup: bool = False, old_rule: bool = False) -> str:
    dims = dims or {}
    name, label, keys = _LABEL[grain]
    source, figures = _dedup(grain, dims) if dedup else _lookup(grain, dims, old_rule)
    group = "".join(f"{n}, " for n in dims)
    made = group if dedup else "".join(f"{e} AS {n}, " for n, e in dims.items())
    return f"""SELECT {label} AS {name}, MEDIACD, {group}CMPNO, AGNO, CREATIVENO, round(ifnull(won, 0), 4) AS EXCHANGEWON,
  {', '.join(f'{e} AS {n}' for n, e in figures.items())}, {keys}
FROM (SELECT media_id AS MEDIACD, {made}CAST(cmp_no AS INT) AS CMPNO, CAST(ag_no AS INT) AS AGNO, CAST(creative_no AS INT) AS CREATIVENO,
        {keys}, list(x) AS l FROM ({source}) GROUP BY ALL)
LEFT JOIN rate ON rate.ym = CAST(year || month AS INT)"""


def _union(*feeds: str, fix=FIX) -> str:
    return with_fixtures("\nUNION ALL BY NAME\n".join(feeds), *fix, ctes=[_RATE])


SUMMARY_HOUR_LOOKUP = _union(feed("hour"))
SUMMARY_HOUR_DEDUP = _union(feed("hour", dedup=True))
SUMMARY_HOUR = _union(feed("hour"), feed("hour", dedup=True), feed("hour"))
SUMMARY_HOUR_OLD_RULE = _union(feed("hour", old_rule=True))

# The target's bundle names the inventory; the exchange's media have the app's or none.
_OWN = {"INVENTORYNM": f"if(g_targetid = '{TARGET_ID}', app_bundle, '')",
        "AREACD": "ifnull((SELECT any_value(a.areacd) FROM fx_area a WHERE a.google_ab_region = region), '-1')"}
_EXCHANGE = {"AREACD": f"if(media_id <> '{MEDIA_CODES[0]}', '', if(area_cd = 'undefined', '-1', area_cd))",
             "INVENTORYNM": f"CASE WHEN media_id IN {tuple(MEDIA_CODES[:3])} THEN app_id "
                            f"WHEN media_id = '{MEDIA_CODES[3]}' THEN 'test' ELSE '' END"}
_PARTNER = {"INVENTORYNM": "''", "AREACD": "if(ifnull(area_cd, '') IN ('', '-99'), '-1', area_cd)"}
SUMMARY_DAILY = _union(feed("day", _OWN), feed("day", _EXCHANGE, dedup=True), feed("day", _PARTNER), fix=(*FIX, "fx_area"))
