"""Weather feature tables (X1-X7): classify raw API items into codes, keep the
latest state per region, resolve region codes, assemble the code table.

Every fetch (region_id, dt, hr) is classified with grouped aggregates
(``min_by``/``max_by`` over the item order ``seq``), so a fetch is never
collected into Python; the code rules are ``when`` chains.

``parity=True`` reproduces the reference's falsy defaults (a true 0 becomes
the default value) and its PM10 interval gaps; ``parity=False`` treats only
missing values as missing and closes the gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_bounded

FETCH = ["region_id", "dt", "hr"]

# Code tables of the weather classifiers.
GENERAL_CODES = {"clear": "B001_001_001", "cloudy": "B001_001_002", "rain": "B001_001_003",
                 "snow": "B001_001_004", "wind": "B001_001_005"}
DISCOMFORT_CODES = ["B001_002_001", "B001_002_002", "B001_002_003", "B001_002_004"]
PM10_THRESHOLDS = [(0, 30, "B001_003_001"), (31, 80, "B001_003_002"), (81, 150, "B001_003_003"),
                   (151, 9999, "B001_003_004")]
GRADE_TO_CODE = {1: "B001_003_001", 2: "B001_003_002", 3: "B001_003_003", 4: "B001_003_004"}
UV_CODES = [(11, "B001_004_005"), (8, "B001_004_004"), (6, "B001_004_003"), (3, "B001_004_002")]
UV_LOW = "B001_004_001"
WARN_VAR_CODES = {"1": "B001_005_001", "2": "B001_005_007", "3": "B001_005_002", "4": "B001_005_008",
                  "5": "B001_005_010", "6": "B001_005_009", "7": "B001_005_005", "8": "B001_005_006",
                  "9": "B001_005_004", "12": "B001_005_003", "13": "B001_005_011"}
LIFT_COMMANDS = ["2", "8"]
# What the API writes for no precipitation and no snow.
NO_RAIN, NO_SNOW = "강수없음", "적설없음"


def _default(raw: Column, value, parity: bool) -> Column:
    """``x or default`` (parity: 0 counts as missing) vs ``coalesce(x, default)``."""
    if parity:
        return F.when(raw.isNull() | (raw == 0), F.lit(value)).otherwise(raw)
    return F.coalesce(raw, F.lit(value))


def classify_forecast(items: DataFrame, parity: bool = True) -> DataFrame:
    """First forecast slot of every fetch pivoted by category (the last item
    of a category wins), TMN/TMX of that day (first item), two codes."""
    slot = F.struct("fcstDate", "fcstTime")
    first = items.groupBy(*FETCH).agg(F.min(slot).alias("_fs"))
    j = items.join(first, FETCH)
    in_slot = (F.col("fcstDate") == F.col("_fs.fcstDate")) & (F.col("fcstTime") == F.col("_fs.fcstTime"))
    same_day = F.col("fcstDate") == F.col("_fs.fcstDate")
    cats = ["SKY", "PTY", "WSD", "TMP", "REH", "POP", "PCP", "SNO", "UUU", "VVV", "WAV", "VEC"]
    aggs = [F.max_by("fcstValue", F.when(in_slot & (F.col("category") == c), F.col("seq"))).alias(c) for c in cats]
    aggs += [F.min_by("fcstValue", F.when(same_day & (F.col("category") == c), F.col("seq"))).alias(c)
             for c in ("TMN", "TMX")]
    aggs += [F.first("_fs").alias("_fs")]
    s = j.groupBy(*FETCH).agg(*aggs)
    sky = _default(F.col("SKY").try_cast("int"), 1, parity)
    pty = _default(F.col("PTY").try_cast("int"), 0, parity)
    wsd = _default(F.col("WSD").try_cast("double"), 0.0, parity)
    tmp = _default(F.col("TMP").try_cast("double"), 20.0, parity)
    reh = _default(F.col("REH").try_cast("double"), 50.0, parity)
    s = s.select(*FETCH, sky.alias("sky"), pty.alias("pty"), wsd.alias("wsd"), tmp.alias("tmp"), reh.alias("reh"),
                 F.col("POP").try_cast("int").alias("pop"), F.col("TMN").try_cast("double").alias("tmn"),
                 F.col("TMX").try_cast("double").alias("tmx"), F.coalesce("PCP", F.lit(NO_RAIN)).alias("pcp"),
                 F.coalesce("SNO", F.lit(NO_SNOW)).alias("sno"), F.col("UUU").try_cast("double").alias("uuu"),
                 F.col("VVV").try_cast("double").alias("vvv"), F.col("WAV").try_cast("double").alias("wav"),
                 F.col("VEC").try_cast("int").alias("vec"), F.col("_fs.fcstDate").alias("fcst_date"),
                 F.col("_fs.fcstTime").alias("fcst_time"))
    g = (F.when(F.col("pty") == 3, GENERAL_CODES["snow"]).when(F.col("pty").isin(1, 2, 4), GENERAL_CODES["rain"])
         .when(F.col("wsd") >= 14, GENERAL_CODES["wind"]).when(F.col("sky").isin(3, 4), GENERAL_CODES["cloudy"])
         .otherwise(GENERAL_CODES["clear"]))
    tf = F.lit(9.0) * F.col("tmp") / 5
    di = tf - F.lit(0.55) * (1 - F.col("reh") / 100) * (tf - 26) + 32
    d = (F.when(F.col("_di") >= 80, DISCOMFORT_CODES[3]).when(F.col("_di") >= 75, DISCOMFORT_CODES[2])
         .when(F.col("_di") >= 70, DISCOMFORT_CODES[1]).otherwise(DISCOMFORT_CODES[0]))
    return (s.withColumn("_di", di).select(*FETCH, g.alias("weather_code"), d.alias("discomfort_code"), "pop", "pty",
                                             "pcp", "reh", "sno", "sky", "tmp", "tmn", "tmx", "uuu", "vvv", "wav", "vec", "wsd",
                                             F.round("_di", 1).alias("di"), "fcst_date", "fcst_time"))


def pm10_code(pm10: Column, parity: bool = True) -> Column:
    """Threshold code; with parity the reference's integer gaps fall to the worst code."""
    e = None
    for lo, hi, code in PM10_THRESHOLDS:
        cond = (pm10 >= lo) & (pm10 <= hi) if parity else (pm10 < hi + 1) if lo == 0 else \
            (pm10 >= lo) & (pm10 < hi + 1)
        e = F.when(cond, code) if e is None else e.when(cond, code)
    return e.otherwise(PM10_THRESHOLDS[-1][2])


def _grade_code(g: Column) -> Column:
    e = None
    for k, v in GRADE_TO_CODE.items():
        e = F.when(g == k, v) if e is None else e.when(g == k, v)
    return e


def classify_dust(items: DataFrame, regions: DataFrame, parity: bool = True) -> DataFrame:
    """Representative station's reading, else the first item with a valid
    PM10; grade -> 1-hour grade -> PM10 thresholds.  Fetches without any usable
    item give no row."""
    rep = broadcast_if_bounded(regions.select(F.col("id").alias("region_id"), "rep_station"))
    x = items.join(rep, "region_id", "left").withColumn("_pm10", F.col("pm10Value").try_cast("double"))
    rec = F.struct(F.col("_pm10").alias("pm10"), F.col("pm10Grade").try_cast("int").alias("g"),
                   F.col("pm10Grade1h").try_cast("int").alias("g1h"), "stationName")
    t = x.groupBy(*FETCH).agg(
        F.min_by(rec, F.when(F.col("stationName") == F.col("rep_station"), F.col("seq"))).alias("_rep"),
        F.min_by(rec, F.when(F.col("_pm10").isNotNull(), F.col("seq"))).alias("_valid"))
    t = t.withColumn("_t", F.coalesce("_rep", "_valid")).where(F.col("_t").isNotNull())
    code = F.coalesce(_grade_code(F.col("_t.g")), _grade_code(F.col("_t.g1h")),
                      F.when(F.col("_t.pm10").isNotNull(), pm10_code(F.col("_t.pm10"), parity)),
                      F.lit(GRADE_TO_CODE[1]))
    return t.select(*FETCH, code.alias("weather_code"), F.col("_t.pm10").alias("pm10Value"),
                    F.col("_t.g").alias("pm10Grade"), F.col("_t.g1h").alias("pm10Grade1h"),
                    F.col("_t.stationName").alias("stationName"))


def classify_uv(items: DataFrame) -> DataFrame:
    """First item's h0 index -> code; fetches without a readable h0 give no row."""
    first = items.groupBy(*FETCH).agg(F.min_by("h0", "seq").alias("h0"))
    h = F.col("h0").try_cast("int")
    e = None
    for lo, code in UV_CODES:
        e = F.when(h >= lo, code) if e is None else e.when(h >= lo, code)
    return first.where(h.isNotNull()).select(*FETCH, e.otherwise(UV_LOW).alias("weather_code"), h.alias("h0"))


def latest_per_region(df: DataFrame, as_of: str, lookback_days: int = 1, cols: tuple[str, ...] = ("weather_code",)):
    """W3 with a lookback: the newest (dt, hr) row per region from ``as_of - lookback`` on."""
    since = F.date_format(F.date_sub(F.to_date(F.lit(as_of)), lookback_days), "yyyyMMdd")
    rec = F.struct(*[F.col(c) for c in cols])
    return (df.where(F.col("dt") >= since).groupBy("region_id")
            .agg(F.max_by(rec, F.struct("dt", "hr")).alias("_r"))
            .select("region_id", *[F.col(f"_r.{c}").alias(c) for c in cols]))


def _resolve(df: DataFrame, regions: DataFrame) -> DataFrame:
    """region_id -> adm_code -> region_code; unresolved regions are dropped."""
    r = broadcast_if_bounded(regions.where(F.col("adm_code").isNotNull() & F.col("region_code").isNotNull())
                             .select(F.col("id").alias("region_id"), "region_code"))
    return df.join(r, "region_id")


def weather_latest(forecast: DataFrame, dust: DataFrame, uv: DataFrame, regions: DataFrame,
                   as_of: str) -> DataFrame:
    """(region_code, weather_code) from the latest forecast (two codes),
    dust and UV rows of each region."""
    f = _resolve(latest_per_region(forecast, as_of, cols=("weather_code", "discomfort_code")), regions)
    fr = f.select("region_code", F.explode(F.array("weather_code", "discomfort_code")).alias("weather_code"))
    parts = [fr, _resolve(latest_per_region(dust, as_of), regions).select("region_code", "weather_code"),
             _resolve(latest_per_region(uv, as_of), regions).select("region_code", "weather_code")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.where(F.col("weather_code").isNotNull() & (F.col("weather_code") != ""))


def active_alerts(alerts: DataFrame, regions: DataFrame) -> DataFrame:
    """Newest version of every announcement (by fetch time), cancelled ones
    dropped (NULL cancel too), newest announcement per (area, type); announced
    (not lifted) types mapped to codes and areas to regions, distinct."""
    version = alerts.groupBy("areaCode", "warnVar", "tmFc", "tmSeq").agg(
        F.max_by(F.struct("command", "cancel"), "fetched_at").alias("_v"))
    valid = version.where(F.col("_v.cancel") != "1")
    latest = valid.groupBy("areaCode", "warnVar").agg(
        F.max_by(F.col("_v.command"), F.struct("tmFc", "tmSeq")).alias("command"))
    codes = None
    for k, v in WARN_VAR_CODES.items():
        codes = F.when(F.col("warnVar") == k, v) if codes is None else codes.when(F.col("warnVar") == k, v)
    area = broadcast_if_bounded(regions.select("areaCode", F.col("id").alias("region_id")))
    act = (latest.withColumn("weather_code", codes).where(F.col("weather_code").isNotNull())
           .where(~F.col("command").cast("string").isin(*LIFT_COMMANDS))
           .join(area, "areaCode"))
    return _resolve(act, regions).select("region_code", "weather_code").distinct()


def weather_codes(forecast: DataFrame, dust: DataFrame, uv: DataFrame, alerts: DataFrame, regions: DataFrame,
                  as_of: str) -> DataFrame:
    """The full current code table (replaced as a whole on write, S17)."""
    return weather_latest(forecast, dust, uv, regions, as_of).unionByName(active_alerts(alerts, regions))


def dedup_alerts(alerts: DataFrame, retention_days: int = 8) -> DataFrame:
    """X6 (batch form of T4): what a chain of fetch runs stores.

    A run skips an item whose hash is among the seen ones, stores it otherwise and
    notes the day; at its end it forgets the hashes noted more than
    ``retention_days`` days before.  So a hash noted on day d is stored again at its
    first fetch after a run later than d + retention, i.e. when the run before
    that fetch was that late.  Runs are the distinct fetch times; each fetch knows the
    day of the run before it, and one fold over a hash's fetches in time order (two
    a day at most) decides, on the JVM."""
    from ..streaming.jobs import alert_hash
    h = alerts.withColumn("item_hash", alert_hash()).withColumn("_day", F.to_date("fetched_at"))
    # Two levels: the run before is of the same day, or, for a day's first run, of the last
    # earlier day with a run.  Only days are brought together, one element a calendar day.
    first = h.groupBy("_day").agg(F.min("fetched_at").alias("_first"))
    days = F.array_sort(F.collect_list("_day"))
    before = (first.agg(days.alias("d")).select(F.posexplode("d").alias("i", "_day"), "d")
              .select("_day", F.when(F.col("i") > 0, F.get("d", F.col("i") - 1)).alias("_earlier")))
    calendar = broadcast_if_bounded(first.join(before, "_day"))
    # Of a hash's fetches in one day only the first can differ from the next but by the day of
    # the run before: the day's first run, and the first of the others.
    later = F.col("fetched_at") > F.col("_first")
    of_day = (h.select("item_hash", "fetched_at", "_day").join(calendar, "_day").groupBy("item_hash", "_day", "_earlier")
              .agg(F.min(F.when(~later, F.col("fetched_at"))).alias("_a"), F.min(F.when(later, F.col("fetched_at"))).alias("_b")))
    steps = F.array_compact(F.array(F.when(F.col("_a").isNotNull(), F.struct(F.col("_a").alias("t"), F.col("_earlier").alias("before"))),
                                    F.when(F.col("_b").isNotNull(), F.struct(F.col("_b").alias("t"), F.col("_day").alias("before")))))
    fetches = of_day.select("item_hash", F.explode(steps).alias("s")).groupBy("item_hash").agg(F.array_sort(F.collect_list("s")).alias("_f"))
    start = F.struct(F.lit(None).cast("date").alias("noted"), F.array().cast("array<timestamp>").alias("kept"))

    def fold(acc: Column, f: Column) -> Column:
        store = acc["noted"].isNull() | (f["before"] > F.date_add(acc["noted"], retention_days))
        return F.when(F.coalesce(store, F.lit(False)),
                      F.struct(F.to_date(f["t"]).alias("noted"), F.concat(acc["kept"], F.array(f["t"])).alias("kept"))).otherwise(acc)

    kept = fetches.select("item_hash", F.explode(F.aggregate("_f", start, fold, lambda acc: acc["kept"])).alias("fetched_at"))
    cols = list(alerts.columns)
    return (h.join(kept, ["item_hash", "fetched_at"])
            .groupBy("item_hash", "fetched_at").agg(F.min(F.struct(*cols)).alias("_r"))
            .select(*[F.col(f"_r.{c}").alias(c) for c in cols], "item_hash"))
