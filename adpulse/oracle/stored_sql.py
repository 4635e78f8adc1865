"""DuckDB oracles of the jobs over stored tables and streams."""

from ..sinks.publish import Family
from ..sources.fixtures import FX_SQL, with_fixtures
from .summary_sql import SUMMARY_DAILY, SUMMARY_HOUR_LOOKUP

SCOPE = ("2024-01-10", "2024-01-12")
FAMILIES = [Family(("own_report",), "MEDIACD"), Family(("customer_report",), "MEDIACD", among=True)]

# An hour is put out when the watermark, an hour behind the last event, has passed its end.
STREAM_SUMMARY_HOUR = f"""SELECT s.* FROM ({SUMMARY_HOUR_LOOKUP}) s
WHERE strptime(DATETIME, '%Y-%m-%d %H:%M:%S') + INTERVAL 1 HOUR
  <= (SELECT max(strptime(created_at, '%Y-%m-%dT%H:%M:%SZ')) FROM ({FX_SQL['fx_postback']})) - INTERVAL 1 HOUR"""


def _published(deleted: str) -> str:
    """Rows of the older figures that a publish leaves, and the new rows of the scope."""
    scope = f"day BETWEEN '{SCOPE[0]}' AND '{SCOPE[1]}'"
    return f"""WITH report AS (SELECT * EXCLUDE (DATE, year, month, day), DATE AS day FROM ({SUMMARY_DAILY})), media AS ({FX_SQL['fx_media']})
SELECT * REPLACE (0.0::DOUBLE AS EXCHANGEWON) FROM report WHERE NOT ({scope} AND {deleted})
UNION ALL SELECT * FROM report WHERE {scope}"""


PUBLISH_NOT_IN = _published("MEDIACD NOT IN (SELECT mediacd FROM media WHERE logparsefg = 'N')")
PUBLISH_IN = _published("MEDIACD IN (SELECT mediacd FROM media WHERE logparsefg = 'Y')")
PUBLISH_DATE = _published("true")

PARTITIONED_DAYS = with_fixtures("""SELECT year, month, day, count(*) AS n_rows, count(DISTINCT req_id) AS requests FROM fx_postback
WHERE year || '-' || month || '-' || day IN (SELECT left(startdt, 10) FROM fx_adgroup WHERE logparsefg = 'N')
GROUP BY year, month, day""", "fx_postback", "fx_adgroup")

LOG_COMPLETENESS = with_fixtures("""SELECT feed, strftime(t, '%Y') AS year, strftime(t, '%m') AS month, strftime(t, '%d') AS day, strftime(t, '%H') AS hour,
  2::INTEGER AS n_expected, count(DISTINCT producer) AS n_files, count(DISTINCT producer) = 1 AS missing, count(DISTINCT producer) = 0 AS empty
FROM (SELECT unnest(['A', 'B']) AS feed), (SELECT unnest(range(min(d), max(d) + INTERVAL 2 DAY, INTERVAL 1 HOUR)) AS t
      FROM (SELECT CAST(year || '-' || month || '-' || day AS TIMESTAMP) AS d FROM fx_postback))
LEFT JOIN (SELECT if(CAST(hour AS INTEGER) % 2 = 0, 'A', 'B') AS f, strptime(year || month || day || hour, '%Y%m%d%H') AS h,
             if(hour IN ('05', '11', '16', '22'), 0, creative_no % 2) AS producer FROM fx_postback) ON f = feed AND h = t
GROUP BY feed, t""", "fx_postback")
