"""Weather look-alikes: API items per fetch, projected from ``events``;
region dimensions projected from ``nation``.  ``seq`` keeps the API's item
order (the classifiers take "first"/"last" items in that order)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .fixtures import FX_SQL, _dialect
from .tables import load

# Forecast categories used by the classifier.
FCST_CATEGORIES = ["SKY", "PTY", "WSD", "TMP", "REH", "POP", "TMN", "TMX", "PCP", "SNO", "UUU", "VVV", "WAV", "VEC"]


def _fetch(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s = x["s"]
    hr = (f"lpad(cast(cast(date_format(ts, 'HH') as int) div 3 * 3 as {s}), 2, '0')" if dialect == "spark"
          else "lpad(CAST(CAST(strftime(ts, '%H') AS INTEGER) // 3 * 3 AS VARCHAR), 2, '0')")
    return ["CAST(user_id % 25 AS INTEGER) AS region_id", f"{x['fmt']('ts', 'yyyyMMdd')} AS dt", f"{hr} AS hr",
            "event_id AS seq"]


def _iv(expr: str, dialect: str) -> str:
    """Integer text of floor(expr)."""
    s = _dialect(dialect)["s"]
    return f"cast(cast(floor({expr}) as bigint) as {s})"


def _fcst_cols(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s = x["s"]
    cat = "CASE CAST(event_id % 14 AS INTEGER) " + " ".join(
        f"WHEN {i} THEN '{c}'" for i, c in enumerate(FCST_CATEGORIES)) + " END"
    hh = "cast(date_format(ts, 'HH') as int)" if dialect == "spark" else "CAST(strftime(ts, '%H') AS INTEGER)"
    val = (f"CASE CAST(event_id % 14 AS INTEGER) WHEN 0 THEN {_iv('value % 5', dialect)} "
           f"WHEN 1 THEN {_iv('value % 5', dialect)} WHEN 2 THEN {_iv('value % 20', dialect)} "
           f"WHEN 3 THEN CASE WHEN event_id % 17 = 0 THEN '-' ELSE {_iv('value % 40 - 5', dialect)} END "
           f"WHEN 4 THEN {_iv('value % 101', dialect)} WHEN 5 THEN {_iv('value % 100', dialect)} "
           f"WHEN 6 THEN {_iv('value % 15 - 5', dialect)} WHEN 7 THEN {_iv('value % 30', dialect)} WHEN 8 THEN concat({_iv('value % 9', dialect)}, 'mm') "
           f"WHEN 13 THEN {_iv('value % 360', dialect)} ELSE {_iv('value % 12', dialect)} END")
    return _fetch(dialect) + [
        f"{x['fmt']('ts', 'yyyyMMdd')} AS fcstDate",
        f"concat(lpad(cast(({hh} + 1 + CAST(event_id % 3 AS INTEGER)) % 24 as {s}), 2, '0'), '00') AS fcstTime",
        f"{cat} AS category", f"{val} AS fcstValue"]


def _dust_cols(dialect: str) -> list[str]:
    s = _dialect(dialect)["s"]
    return _fetch(dialect) + [
        f"concat('st', cast(event_id % 9 as {s})) AS stationName",
        f"CASE CAST(event_id % 13 AS INTEGER) WHEN 0 THEN '-' WHEN 1 THEN '' WHEN 2 THEN '30.5' "
        f"ELSE {_iv('value % 200', dialect)} END AS pm10Value",
        f"CASE CAST(event_id % 5 AS INTEGER) WHEN 0 THEN '-' WHEN 1 THEN NULL "
        f"ELSE {_iv('value % 4 + 1', dialect)} END AS pm10Grade",
        f"CASE WHEN event_id % 7 = 0 THEN '-' ELSE {_iv('value % 5', dialect)} END AS pm10Grade1h"]


def _uv_cols(dialect: str) -> list[str]:
    return _fetch(dialect) + [f"CASE WHEN event_id % 11 = 0 THEN '' ELSE {_iv('value % 14', dialect)} END AS h0"]


def _alert_cols(dialect: str) -> list[str]:
    x = _dialect(dialect)
    s = x["s"]
    return [f"concat('L', cast(user_id % 40 as {s})) AS areaCode", f"cast(event_id % 14 as {s}) AS warnVar",
            f"cast(event_id % 9 as {s}) AS command",
            "CASE CAST(event_id % 10 AS INTEGER) WHEN 0 THEN '1' WHEN 1 THEN NULL ELSE '0' END AS cancel",
            f"{x['fmt']('ts', 'yyyyMMdd')} AS tmFc", f"cast(user_id % 3 as {s}) AS tmSeq",
            "'108' AS stnId", f"cast(event_id % 2 as {s}) AS warnStress",
            "ts AS fetched_at"]


def _regions_cols(dialect: str) -> list[str]:
    s = _dialect(dialect)["s"]
    return ["CAST(n_nationkey AS INTEGER) AS id", f"cast(1100000000 + n_nationkey * 1000 as {s}) AS adm_code",
            f"concat('st', cast(n_nationkey % 11 as {s})) AS rep_station",
            f"CASE WHEN n_nationkey < 20 THEN concat('RC', cast(n_nationkey as {s})) END AS region_code",
            f"concat('L', cast(n_nationkey as {s})) AS areaCode"]


def _mk(table: str, cols):
    def f(spark: SparkSession, sf_dir: str) -> DataFrame:
        return load(spark, sf_dir, table).selectExpr(*cols("spark"))
    return f


fx_fcst = _mk("events", _fcst_cols)
fx_dust = _mk("events", _dust_cols)
fx_uv = _mk("events", _uv_cols)
fx_alert = _mk("events", _alert_cols)
fx_regions = _mk("nation", _regions_cols)

FX_SQL.update({
    "fx_fcst": "SELECT " + ", ".join(_fcst_cols("duckdb")) + " FROM events",
    "fx_dust": "SELECT " + ", ".join(_dust_cols("duckdb")) + " FROM events",
    "fx_uv": "SELECT " + ", ".join(_uv_cols("duckdb")) + " FROM events",
    "fx_alert": "SELECT " + ", ".join(_alert_cols("duckdb")) + " FROM events",
    "fx_regions": "SELECT " + ", ".join(_regions_cols("duckdb")) + " FROM nation",
})
