"""DuckDB oracles for the reach reports.

A device that completed n views since the first running flight began is in reach k for
every k up to n: each campaign's devices are listed with their view counts, and reach k
is how many counts are at least k, less what earlier days of the flight reported."""

from ..sources.fixtures import GROUP_INVENTORY, MEDIA_CODES, with_fixtures

REPORT_DATE = "2024-01-20"

_EXCHANGE = [*MEDIA_CODES[:2], MEDIA_CODES[3]]     # media of the exchange feed


def _inventory() -> str:
    named = "".join(f" WHEN {k} THEN '{v}'" for k, v in GROUP_INVENTORY.items())
    return f"ifnull(CASE ag_no{named} END, CASE WHEN media_id IN {tuple(_EXCHANGE[:2])} THEN app_id WHEN media_id = '{_EXCHANGE[2]}' THEN 'test' END)"


def _day_of(c: str) -> str:
    return f"left(CAST({c} AS VARCHAR), 10)"


def reach_sql(by_group: bool) -> str:
    """Every day of the flights is reported in turn: a day's rows are the groups that played on
    it, each with the reach since the earliest start of the flights then running, less the sum
    of all that the flight's earlier days reported for the key."""
    key, flights, code = ("ag_no", "fx_adgroup", "agno") if by_group else ("cmp_no", "fx_adcampaign", "cmpno")
    keys = "cmp_no, ag_no" if by_group else "cmp_no"
    parsed = " WHERE logparsefg = 'Y'" if by_group else ""
    inv, inv_out = (f", {_inventory()} AS inv", ", '' AS INVENTORYNM") if by_group else ("", "")
    # A row counts once for each feed that carries it.
    tv = "CAST(ifnull(ctv_media, '') <> '' AS INT)"
    counts = f"(CAST(media_id IN {tuple(_EXCHANGE)} AS INT) + {tv})"
    counts_today = f"(CAST(media_id = '{_EXCHANGE[0]}' AS INT) + {tv})"
    y, m, d = REPORT_DATE.split("-")
    total = ", ".join(f"sum(len(list_filter(n, lambda x: x >= {k})))::HUGEINT AS c{k}" for k in (1, 2, 3))
    step = ", ".join(f"s{k} + ifnull(c{k} - shown * s{k}, 0)" for k in (1, 2, 3))
    reach = ", ".join(f"CAST(len(list_filter(n, lambda x: x >= {k})) - ifnull(s{k}, 0) AS BIGINT) AS REACH{k}" for k in (1, 2, 3))
    ctes = [
        f"flight AS (SELECT {code} AS {key}, {_day_of('startdt')} AS since, {_day_of('enddt')} AS until FROM {flights}{parsed})",
        f"day AS (SELECT strftime(unnest(range((SELECT min(since)::DATE FROM flight WHERE '{REPORT_DATE}' BETWEEN since AND until), "
        f"DATE '{REPORT_DATE}' + 1, INTERVAL 1 DAY)), '%Y-%m-%d') AS d)",
        "first AS (SELECT d, min(since) AS since FROM day JOIN flight ON d BETWEEN since AND until GROUP BY d)",
        f"log AS (SELECT *, year || '-' || month || '-' || day AS v, {counts} AS feeds, {counts_today} AS feeds_today{inv} FROM fx_postback)",
        f"reached AS (SELECT d, {keys}, list(views) AS n FROM (SELECT d, {keys}, ifa, sum(feeds) AS views FROM first "
        f"JOIN flight ON d BETWEEN flight.since AND until JOIN log USING ({key}) WHERE log_type = 'v_complete' AND ifa IS NOT NULL "
        f"AND feeds > 0 AND v BETWEEN first.since AND d GROUP BY d, {keys}, ifa) GROUP BY d, {keys})",
        f"shown AS (SELECT v AS d, {keys}, sum(feeds_today) FILTER (log_type = 'v_complete') AS plays, count(DISTINCT ifa) FILTER "
        f"(log_type = 'v_complete') AS devices FROM log WHERE feeds_today > 0 GROUP BY v, {keys}{', inv' if by_group else ''})",
        f"whole AS (SELECT d, {key}, count(*)::HUGEINT AS shown, {total} FROM shown JOIN reached USING (d, {keys}) GROUP BY d, {key})",
        f"before AS (SELECT min(d) AS d, {key}, 0::HUGEINT AS s1, 0::HUGEINT AS s2, 0::HUGEINT AS s3 FROM day, flight "
        f"WHERE '{REPORT_DATE}' BETWEEN since AND until GROUP BY {key} "
        f"UNION ALL SELECT strftime(d::DATE + 1, '%Y-%m-%d'), {key}, {step} FROM before LEFT JOIN whole USING (d, {key}) WHERE d < '{REPORT_DATE}')"]
    sql = f"""SELECT d AS DATE, cmp_no AS CMPNO{', ag_no AS AGNO' if by_group else ''}, devices AS UNIQUEREACH{inv_out},
  if(devices = 0, 0, plays / devices) AS DAILYFREQUENCY, {reach}, '{y}' AS year, '{m}' AS month, '{d}' AS day
FROM shown JOIN reached USING (d, {keys}) LEFT JOIN before USING (d, {key}) WHERE d = '{REPORT_DATE}'"""
    return with_fixtures(sql, "fx_postback", "fx_adgroup" if by_group else "fx_adcampaign", ctes=ctes).replace("WITH ", "WITH RECURSIVE ", 1)


REACH_ADGROUP = reach_sql(True)
REACH_CAMPAIGN = reach_sql(False)
CHECK_REACH_NEGATIVE = f"""SELECT year, month, day, count(*) FILTER (least(UNIQUEREACH, DAILYFREQUENCY, REACH1, REACH2, REACH3) < 0) AS error_cnt
FROM ({REACH_ADGROUP}) GROUP BY year, month, day"""
