"""DuckDB oracles for the channel report and the consistency checks (every day)."""

from ..sources.fixtures import TARGET_ID, with_fixtures
from .summary_sql import SUMMARY_DAILY, SUMMARY_HOUR

_DAY = "year || '-' || month || '-' || day"


def _channel(c: str, lg: str) -> str:
    """The carrier named in a text, else the text itself."""
    return f"coalesce(list_filter([{{'p': 'kt', 'n': 'KT'}}, {{'p': '{lg}', 'n': 'LGU'}}, {{'p': 'skb', 'n': 'SKB'}}], lambda k: contains(lower({c}), k.p))[1].n, {c})"


# One row for each distinct postback of a parsed medium; its channel is its own (own feed)
# or that of the bids that its request had on the day or the day before.
CHANNEL_DAILY = with_fixtures(f"""SELECT date, cmpno, agno, carrier, contentid, mediacd, count(DISTINCT req_id) AS reqidcnt,
  count(*) FILTER (log_type = 'i') AS impcnt, count(*) FILTER (log_type = 'v_complete') AS q4cnt, year, month, day
FROM (
  SELECT DISTINCT true AS own, {_DAY} AS date, year, month, day, req_id, cmp_no AS cmpno, ag_no AS agno, media_id AS mediacd, log_type,
    {_channel('ctv_media', 'lguplus')} AS carrier, content_id AS contentid
  FROM fx_postback WHERE g_targetid = '{TARGET_ID}'
  UNION ALL
  SELECT false, p.* FROM (
    SELECT h.* EXCLUDE (bids), unnest(ifnull(bids, [NULL])).carrier AS carrier, unnest(ifnull(bids, [NULL])).contentid AS contentid
    FROM (SELECT h.*, list(b) FILTER (b IS NOT NULL) AS bids
          FROM (SELECT DISTINCT {_DAY} AS date, year, month, day, req_id, cmp_no AS cmpno, ag_no AS agno, media_id AS mediacd, log_type FROM fx_postback) h
          LEFT JOIN (SELECT req.req_id AS id, CAST({_DAY} AS DATE) AS d, struct_pack(carrier := {_channel('req.app_bundle', 'uplus')}, contentid := req.content_id) AS b
                     FROM fx_bid_log WHERE req.media_id IN (SELECT mediacd FROM fx_media WHERE lower(logparsefg) = 'y'))
            ON id = h.req_id AND CAST(h.date AS DATE) - d BETWEEN 0 AND 1
          GROUP BY ALL) h) p)
WHERE cmpno IS NOT NULL AND agno IS NOT NULL AND mediacd IN (SELECT mediacd FROM fx_media WHERE lower(logparsefg) = 'y')
GROUP BY own, date, cmpno, agno, carrier, contentid, mediacd, year, month, day""", "fx_postback", "fx_bid_log", "fx_media")


def _differ(a: str, b: str, figures: dict[str, str]) -> str:
    """Per day, 1 if any figure's sums over the two tables differ (missing: 0)."""
    left = ", ".join(x for x in figures)
    right = ", ".join(f"-{y}" for y in figures.values())
    off = " OR ".join(f"ifnull(sum({x}), 0) <> 0" for x in figures)
    return (f"SELECT year, month, day, CAST({off} AS BIGINT) AS error_cnt FROM (SELECT year, month, day, {left} FROM ({a}) "
            f"UNION ALL SELECT year, month, day, {right} FROM ({b})) GROUP BY year, month, day")


CHECK_HOUR_VS_DAILY = _differ(SUMMARY_HOUR, SUMMARY_DAILY, {c: c for c in ("IMPS", "CLICKS", "Q1", "Q2", "Q3", "Q4")})
CHECK_DAILY_VS_CHANNEL = _differ(f"SELECT * FROM ({SUMMARY_DAILY}) WHERE INVENTORYNM <> ''", CHANNEL_DAILY, {"IMPS": "impcnt", "Q4": "q4cnt"})
