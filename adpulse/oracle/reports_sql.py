"""DuckDB oracles for the daily conversion reports (all dates)."""

from ..sources.fixtures import with_fixtures
from .attribution_sql import ATTR_RANGE_V1, ATTR_WEB_IMP, ATTR_WEB_V1, RANGE_END, RANGE_START


def _cut(c: str) -> str:
    return ", ".join(f"split_part({c}, '-', {i}) AS {n}" for i, n in enumerate(("year", "month", "day"), 1))


def _web(raw: str) -> str:
    return (f"SELECT cmp_no, pid, ev, CAST(mall_dt AS DATE) AS dt, len(list_distinct(list(mall_ip))) AS daily_unique_ip, {_cut('mall_dt')} "
            f"FROM ({raw}) GROUP BY cmp_no, pid, ev, mall_dt")


REPORT_WEB = _web(ATTR_WEB_V1)
REPORT_RANGE_WEB = _web(f"SELECT * FROM ({ATTR_RANGE_V1}) WHERE mall_dt BETWEEN '{RANGE_START}' AND '{RANGE_END}'")

# Conversions at most eight days after the view.
REPORT_WEB_IMP = f"""SELECT imp_dt, CAST(mall_dt AS DATE) AS mall_dt, cmp_no, pid, ev, len(list_distinct(list(mall_ip))) AS daily_unique_ip, {_cut('r.mall_dt')}
FROM ({ATTR_WEB_IMP}) r WHERE epoch(CAST(mall_datetime AS TIMESTAMP)) - epoch(CAST(post_datetime AS TIMESTAMP)) BETWEEN 0 AND 8 * 86400 - 1
GROUP BY imp_dt, r.mall_dt, cmp_no, pid, ev"""

REPORT_APP = with_fixtures(f"""SELECT t.tracker, t.cmp, t.event, left(t.created_at, 10) AS dt, len(list_distinct(list(t.ip))) AS daily_unique_ip,
  round(ifnull(sum(TRY_CAST(trim(t.revenue) AS DOUBLE)), 0), 4) AS revenue, any_value(own.mmp) AS app_mmp_cd, {_cut('left(t.created_at, 10)')}
FROM fx_app t JOIN (SELECT DISTINCT cmp_no, max(app_mmp_cd) OVER (PARTITION BY cmp_no) AS mmp FROM fx_info) own
  ON TRY_CAST(trim(t.cmp) AS BIGINT) = own.cmp_no
WHERE trim(t.ip) <> '' AND ifnull(trim(t.click_id), '') <> 'TEST'
GROUP BY t.tracker, t.cmp, t.event, left(t.created_at, 10)""", "fx_app", "fx_info")

# A hit belongs to the campaigns behind its click id, and to those that its pixel and utm tag name.
REPORT_CLICK_UTM = with_fixtures(f"""SELECT cmp_no, pid, cmp_you_no, ev, CAST(dt AS DATE) AS dt, count(DISTINCT ip) AS daily_unique_ip, {_cut('dt')}
FROM (SELECT replace(left(g.log_time, 10), '/', '-') AS dt, g.pid, g.ip, i.cmp_no, i.cmp_you_no,
        ifnull(CASE g.ev WHEN 'conversion' THEN CAST(g.conv_type AS VARCHAR) WHEN 'click' THEN CAST(g.click AS VARCHAR) END, g.ev) AS ev
      FROM fx_gtm g JOIN fx_info i ON i.cmp_no IS NOT NULL AND (
        i.cmp_you_no IN (SELECT CAST(c.cmp_you_no AS VARCHAR) FROM fx_gclid c WHERE c.gclid = g.gclid)
        OR i.pixel_id = g.pid AND i.cmp_you_no = regexp_extract(g.url, 'utm_campaign=([^&]+)', 1)))
GROUP BY cmp_no, pid, cmp_you_no, ev, dt""", "fx_gtm", "fx_gclid", "fx_info")

REPORT_METRICS = with_fixtures(f"""SELECT ifnull(o.cmp_no, 0) AS cmp_no, m.campaign_no, ifnull(m.campaign_name, '') AS campaign_name, m.date,
  {', '.join(f'CAST(ifnull(sum(m.{c}), 0) AS BIGINT) AS {c}' for c in ('impressions', 'trueviews', 'clicks'))},
  round(ifnull(sum(m.conversions), 0), 4) AS conversions, {_cut('m.date')}
FROM fx_metric m LEFT JOIN (SELECT cmp_no, cmp_you_no AS id FROM fx_info UNION SELECT campaign_no, campaign_id FROM fx_ytlist) o
  ON CAST(m.campaign_no AS VARCHAR) = CAST(CAST(o.id AS BIGINT) AS VARCHAR)
GROUP BY o.cmp_no, m.campaign_no, m.campaign_name, m.date""", "fx_metric", "fx_info", "fx_ytlist")



def _dates(sql: str, c: str = "dt") -> str:
    return f"SELECT * FROM ({sql}) WHERE CAST({c} AS DATE) BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'"


REPORT_RANGE_APP = _dates(REPORT_APP)
REPORT_RANGE_CLICK_UTM = _dates(REPORT_CLICK_UTM)
REPORT_RANGE_METRICS = _dates(REPORT_METRICS, "date")
REPORT_RANGE_WEB_IMP = _dates(REPORT_WEB_IMP, "mall_dt")

# Of each report and day: rows, its own metric's sum and its campaigns.
CHECK_REPORT_LOADS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, CAST({d} AS VARCHAR) AS dt, count(*) AS row_cnt, round(CAST(sum({m}) AS DOUBLE), 4) AS metric_sum, "
    f"count(DISTINCT {c}) AS campaign_cnt FROM ({sql}) GROUP BY {d}"
    for name, sql, d, m, c in (
        ("report_addi_conv_gtm_web", REPORT_WEB, "dt", "daily_unique_ip", "cmp_no"),
        ("report_addi_conv_gtm_web_imp", REPORT_WEB_IMP, "mall_dt", "daily_unique_ip", "cmp_no"),
        ("report_addi_conv_app", REPORT_APP, "dt", "daily_unique_ip", "cmp"),
        ("report_addi_conv_gtm_youtube", REPORT_CLICK_UTM, "dt", "daily_unique_ip", "cmp_no"),
        ("report_addi_conv_metric_youtube", REPORT_METRICS, "date", "conversions", "cmp_no")))
SYNC_WATERMARK = 1015
SYNC_INCREMENTAL = with_fixtures(f"SELECT * FROM fx_metric WHERE campaign_no > {SYNC_WATERMARK}", "fx_metric")
