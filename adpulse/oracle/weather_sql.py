"""DuckDB oracles for the weather tables (parity rules, every fetch)."""

from ..sources import weather_fx  # noqa: F401  (registers the weather fixtures)
from ..sources.fixtures import with_fixtures

AS_OF = "2024-01-30"

_F = [
    "f1 AS (SELECT region_id, dt, hr, min(fcstDate) AS fd FROM fx_fcst GROUP BY ALL)",
    """f2 AS (SELECT i.region_id, i.dt, i.hr, f1.fd, min(i.fcstTime) AS ft FROM fx_fcst i
 JOIN f1 ON i.region_id = f1.region_id AND i.dt = f1.dt AND i.hr = f1.hr WHERE i.fcstDate = f1.fd GROUP BY ALL)""",
    "s AS (SELECT i.region_id, i.dt, i.hr, f2.fd, f2.ft, " + ", ".join(
        f"arg_max(i.fcstValue, i.seq) FILTER (WHERE i.fcstDate = f2.fd AND i.fcstTime = f2.ft AND i.category = '{c}')"
        f" AS {c}" for c in ["SKY", "PTY", "WSD", "TMP", "REH", "POP", "PCP", "SNO", "UUU", "VVV", "WAV", "VEC"]) + ", " + ", ".join(
        f"arg_min(i.fcstValue, i.seq) FILTER (WHERE i.fcstDate = f2.fd AND i.category = '{c}') AS {c}"
        for c in ["TMN", "TMX"]) +
    """ FROM fx_fcst i JOIN f2 ON i.region_id = f2.region_id AND i.dt = f2.dt AND i.hr = f2.hr GROUP BY ALL)""",
    """v AS (SELECT region_id, dt, hr, fd, ft,
   CASE WHEN TRY_CAST(SKY AS INTEGER) IS NULL OR TRY_CAST(SKY AS INTEGER) = 0 THEN 1 ELSE TRY_CAST(SKY AS INTEGER) END AS sky,
   CASE WHEN TRY_CAST(PTY AS INTEGER) IS NULL OR TRY_CAST(PTY AS INTEGER) = 0 THEN 0 ELSE TRY_CAST(PTY AS INTEGER) END AS pty,
   CASE WHEN TRY_CAST(WSD AS DOUBLE) IS NULL OR TRY_CAST(WSD AS DOUBLE) = 0 THEN 0.0 ELSE TRY_CAST(WSD AS DOUBLE) END AS wsd,
   CASE WHEN TRY_CAST(TMP AS DOUBLE) IS NULL OR TRY_CAST(TMP AS DOUBLE) = 0 THEN 20.0 ELSE TRY_CAST(TMP AS DOUBLE) END AS tmp,
   CASE WHEN TRY_CAST(REH AS DOUBLE) IS NULL OR TRY_CAST(REH AS DOUBLE) = 0 THEN 50.0 ELSE TRY_CAST(REH AS DOUBLE) END AS reh,
   TRY_CAST(POP AS INTEGER) AS pop, TRY_CAST(TMN AS DOUBLE) AS tmn, TRY_CAST(TMX AS DOUBLE) AS tmx,
   ifnull(PCP, '강수없음') AS pcp, ifnull(SNO, '적설없음') AS sno, TRY_CAST(UUU AS DOUBLE) AS uuu, TRY_CAST(VVV AS DOUBLE) AS vvv,
   TRY_CAST(WAV AS DOUBLE) AS wav, TRY_CAST(VEC AS INTEGER) AS vec FROM s)""",
    """fc AS (SELECT region_id, dt, hr,
   CASE WHEN pty = 3 THEN 'B001_001_004' WHEN pty IN (1, 2, 4) THEN 'B001_001_003' WHEN wsd >= 14 THEN 'B001_001_005'
        WHEN sky IN (3, 4) THEN 'B001_001_002' ELSE 'B001_001_001' END AS weather_code,
   CASE WHEN di >= 80 THEN 'B001_002_004' WHEN di >= 75 THEN 'B001_002_003' WHEN di >= 70 THEN 'B001_002_002'
        ELSE 'B001_002_001' END AS discomfort_code,
   pop, pty, pcp, reh, sno, sky, tmp, tmn, tmx, uuu, vvv, wav, vec, wsd, round(di, 1) AS di, fd AS fcst_date, ft AS fcst_time
 FROM (SELECT *, 9.0 * tmp / 5 - 0.55 * (1 - reh / 100) * (9.0 * tmp / 5 - 26) + 32 AS di FROM v))""",
]

_D = [
    """dx AS (SELECT i.*, r.rep_station, TRY_CAST(i.pm10Value AS DOUBLE) AS pm10 FROM fx_dust i
 LEFT JOIN (SELECT id, rep_station FROM fx_regions) r ON r.id = i.region_id)""",
    """dt_ AS (SELECT region_id, dt, hr,
   arg_min(struct_pack(pm10 := pm10, g := TRY_CAST(pm10Grade AS INTEGER), g1h := TRY_CAST(pm10Grade1h AS INTEGER),
     stationName := stationName), seq) FILTER (WHERE stationName = rep_station) AS rep,
   arg_min(struct_pack(pm10 := pm10, g := TRY_CAST(pm10Grade AS INTEGER), g1h := TRY_CAST(pm10Grade1h AS INTEGER),
     stationName := stationName), seq) FILTER (WHERE pm10 IS NOT NULL) AS valid
 FROM dx GROUP BY region_id, dt, hr)""",
    """du AS (SELECT region_id, dt, hr,
   CASE WHEN t.g BETWEEN 1 AND 4 THEN 'B001_003_00' || t.g WHEN t.g1h BETWEEN 1 AND 4 THEN 'B001_003_00' || t.g1h
        WHEN t.pm10 IS NULL THEN 'B001_003_001'
        WHEN t.pm10 >= 0 AND t.pm10 <= 30 THEN 'B001_003_001' WHEN t.pm10 >= 31 AND t.pm10 <= 80 THEN 'B001_003_002'
        WHEN t.pm10 >= 81 AND t.pm10 <= 150 THEN 'B001_003_003' ELSE 'B001_003_004' END AS weather_code,
   t.pm10 AS pm10Value, t.g AS pm10Grade, t.g1h AS pm10Grade1h, t.stationName AS stationName
 FROM (SELECT region_id, dt, hr, COALESCE(rep, valid) AS t FROM dt_) WHERE t IS NOT NULL)""",
]

_U = ["""uv AS (SELECT region_id, dt, hr,
   CASE WHEN h >= 11 THEN 'B001_004_005' WHEN h >= 8 THEN 'B001_004_004' WHEN h >= 6 THEN 'B001_004_003'
        WHEN h >= 3 THEN 'B001_004_002' ELSE 'B001_004_001' END AS weather_code, h AS h0
 FROM (SELECT region_id, dt, hr, TRY_CAST(arg_min(h0, seq) AS INTEGER) AS h FROM fx_uv GROUP BY ALL) WHERE h IS NOT NULL)"""]

_RC = "rc AS (SELECT id, region_code FROM fx_regions WHERE adm_code IS NOT NULL AND region_code IS NOT NULL)"
_SINCE = f"strftime(DATE '{AS_OF}' - INTERVAL 1 DAY, '%Y%m%d')"
_L = [_RC,
      f"""lf AS (SELECT region_id, arg_max(weather_code, dt || hr) AS wc, arg_max(discomfort_code, dt || hr) AS dc
 FROM fc WHERE dt >= {_SINCE} GROUP BY region_id)""",
      f"ld AS (SELECT region_id, arg_max(weather_code, dt || hr) AS wc FROM du WHERE dt >= {_SINCE} GROUP BY region_id)",
      f"lu AS (SELECT region_id, arg_max(weather_code, dt || hr) AS wc FROM uv WHERE dt >= {_SINCE} GROUP BY region_id)",
      """latest AS (SELECT rc.region_code, x.weather_code FROM (
   SELECT region_id, wc AS weather_code FROM lf UNION ALL SELECT region_id, dc FROM lf
   UNION ALL SELECT region_id, wc FROM ld UNION ALL SELECT region_id, wc FROM lu) x
 JOIN rc ON rc.id = x.region_id WHERE x.weather_code IS NOT NULL AND x.weather_code <> '')"""]

_WARN = {"1": "B001_005_001", "2": "B001_005_007", "3": "B001_005_002", "4": "B001_005_008", "5": "B001_005_010",
         "6": "B001_005_009", "7": "B001_005_005", "8": "B001_005_006", "9": "B001_005_004", "12": "B001_005_003",
         "13": "B001_005_011"}
_A = ["rc2 AS (SELECT id, region_code FROM fx_regions WHERE adm_code IS NOT NULL AND region_code IS NOT NULL)",
      """lv AS (SELECT areaCode, warnVar, command FROM (
   SELECT areaCode, warnVar, command, ROW_NUMBER() OVER (PARTITION BY areaCode, warnVar ORDER BY tmFc DESC, tmSeq DESC) AS event_rn
   FROM (SELECT areaCode, warnVar, command, cancel, tmFc, tmSeq,
           ROW_NUMBER() OVER (PARTITION BY areaCode, warnVar, tmFc, tmSeq ORDER BY fetched_at DESC) AS version_rn
         FROM fx_alert) WHERE version_rn = 1 AND cancel <> '1') WHERE event_rn = 1)""",
      "alerts AS (SELECT DISTINCT rc2.region_code, CASE lv.warnVar " + " ".join(
          f"WHEN '{k}' THEN '{v}'" for k, v in _WARN.items()) + """ END AS weather_code
 FROM lv JOIN fx_regions a ON a.areaCode = lv.areaCode JOIN rc2 ON rc2.id = a.id
 WHERE lv.warnVar IN (""" + ", ".join(f"'{k}'" for k in _WARN) + ") AND lv.command NOT IN ('2', '8'))"]

WEATHER_FORECAST = with_fixtures("SELECT * FROM fc", "fx_fcst", ctes=_F)
WEATHER_DUST = with_fixtures("SELECT * FROM du", "fx_dust", "fx_regions", ctes=_D)
WEATHER_UV = with_fixtures("SELECT * FROM uv", "fx_uv", ctes=_U)
WEATHER_LATEST = with_fixtures("SELECT * FROM latest", "fx_fcst", "fx_dust", "fx_uv", "fx_regions",
                               ctes=_F + _D + _U + _L)
WEATHER_ALERTS = with_fixtures("SELECT * FROM alerts", "fx_alert", "fx_regions", ctes=_A)
WEATHER_CODES = with_fixtures("SELECT * FROM latest UNION ALL SELECT * FROM alerts",
                              "fx_fcst", "fx_dust", "fx_uv", "fx_alert", "fx_regions", ctes=_F + _D + _U + _L + _A)

# From each stored fetch, the next one stored is the first whose preceding run came
# more than eight days after the stored day (only then has the hash been forgotten).
_HASHED = ["areaCode", "cancel", "command", "stnId", "tmFc", "tmSeq", "warnStress", "warnVar"]
_JSON = " || ', ' || ".join(f"""'"{k}": ' || CASE WHEN {k} IS NULL THEN 'null' ELSE '"' || {k} || '"' END""" for k in _HASHED)
ALERT_DEDUP = with_fixtures(
    """SELECT x.* FROM stored JOIN (SELECT DISTINCT * FROM hashed) x ON x.item_hash = stored.h AND x.fetched_at = stored.t""",
    "fx_alert", ctes=[
        f"hashed AS (SELECT *, sha256('{{' || {_JSON} || '}}') AS item_hash FROM fx_alert)",
        "seen_by AS (SELECT t, CAST(max(t) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DATE) AS earlier "
        "FROM (SELECT DISTINCT fetched_at AS t FROM hashed))",
        "tries AS (SELECT DISTINCT h.item_hash AS h, s.t, s.earlier FROM hashed h JOIN seen_by s ON s.t = h.fetched_at)",
        """stored AS (SELECT h, min(t) AS t FROM tries GROUP BY h
 UNION ALL
 SELECT * FROM (SELECT s.h, (SELECT min(n.t) FROM tries n WHERE n.h = s.h AND n.t > s.t
                             AND n.earlier > CAST(s.t AS DATE) + 8) AS t FROM stored s) WHERE t IS NOT NULL)"""])
ALERT_DEDUP = ALERT_DEDUP.replace("WITH ", "WITH RECURSIVE ", 1)
