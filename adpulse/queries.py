"""Registration of every job against the driver's tables (keys of ``queries()``)."""

from __future__ import annotations

from .oracle import summary_sql as ssql
from .plans import summary
from pyspark.sql import functions as F

from .registry import register
from .sources import fixtures as fx


@register("summary_hour_lookup", ssql.SUMMARY_HOUR_LOOKUP)
def q_summary_hour_lookup(spark, sf):
    """Hourly summary of a price-lookup feed."""
    return summary.summary_lookup(fx.fx_postback(spark, sf), summary.HOUR,
                                  fx.fx_media(spark, sf), fx.fx_rate(spark, sf))


@register("summary_hour_dedup", ssql.SUMMARY_HOUR_DEDUP)
def q_summary_hour_dedup(spark, sf):
    """R2: hourly summary of the deduplicated feed."""
    return summary.summary_dedup(fx.fx_postback(spark, sf), summary.HOUR,
                                 fx.fx_media(spark, sf), fx.fx_rate(spark, sf))


@register("summary_hour", ssql.SUMMARY_HOUR)
def q_summary_hour(spark, sf):
    """Union of the three feeds with the previous month's exchange rate."""
    pb = fx.fx_postback(spark, sf)
    return summary.summary_hour(pb, pb, pb, fx.fx_media(spark, sf), fx.fx_rate(spark, sf))


@register("summary_daily", ssql.SUMMARY_DAILY)
def q_summary_daily(spark, sf):
    """Daily summary with inventory name and area code."""
    pb = fx.fx_postback(spark, sf)
    return summary.summary_daily(pb, pb, pb, fx.DAILY_RULES, fx.fx_media(spark, sf), fx.fx_rate(spark, sf),
                                 fx.fx_area(spark, sf))


# ---------------------------------------------------------------- attribution
from .oracle import attribution_sql as asql  # noqa: E402
from .plans import attribution as attr  # noqa: E402


def _attr_inputs(spark, sf):
    return dict(postback=fx.fx_postback(spark, sf), gtm=fx.fx_gtm(spark, sf), info=fx.fx_info(spark, sf),
                visits=fx.fx_visit(spark, sf), skb=fx.fx_skb(spark, sf), tg=fx.fx_tg(spark, sf))


def _home(spark, sf):
    inputs = _attr_inputs(spark, sf) | dict(postback=fx.fx_postback_long(spark, sf))
    return attr.attribute_v2(**inputs, end=asql.HOME_END, direct_lookback_months=6)


@register("attr_direct_first", asql.ATTR_DIRECT)
def q_attr_direct_first(spark, sf):
    """Direct-ip first touch, every event day."""
    return attr.attribute_v1(**_attr_inputs(spark, sf), routes=("direct",))


@register("attr_visit_first", asql.ATTR_VISIT)
def q_attr_visit_first(spark, sf):
    """Device-visit route, every event day."""
    return attr.attribute_v1(**_attr_inputs(spark, sf), routes=("visit",))


@register("attr_graph_first", asql.ATTR_GRAPH)
def q_attr_graph_first(spark, sf):
    """Id-graph route, every event day."""
    return attr.attribute_v1(**_attr_inputs(spark, sf), routes=("graph",))


@register("attr_web_v1", asql.ATTR_WEB_V1)
def q_attr_web_v1(spark, sf):
    """Union of the three routes over the whole range."""
    return attr.attribute_v1(**_attr_inputs(spark, sf))


@register("attr_web_imp", asql.ATTR_WEB_IMP)
def q_attr_web_imp(spark, sf):
    """C4 plus the impression date."""
    return attr.attribute_v1(**_attr_inputs(spark, sf), imp_date=True)


@register("attr_web_initial", asql.ATTR_WEB_INITIAL)
def q_attr_web_initial(spark, sf):
    """C11: what the initial table is created from, event names as they were logged."""
    return attr.attribute_v1(**_attr_inputs(spark, sf), raw_ev=True)


# ---------------------------------------------------------------- reports
from .oracle import reports_sql as rsql  # noqa: E402
from .plans import reports  # noqa: E402


@register("report_web", rsql.REPORT_WEB)
def q_report_web(spark, sf):
    """Daily unique ips over the v1 attribution output."""
    return reports.report_web(attr.attribute_v1(**_attr_inputs(spark, sf)))


@register("report_web_imp", rsql.REPORT_WEB_IMP)
def q_report_web_imp(spark, sf):
    """Impression-date matrix with the 8-day window."""
    return reports.report_web_imp(attr.attribute_v1(**_attr_inputs(spark, sf), imp_date=True))


@register("report_app", rsql.REPORT_APP)
def q_report_app(spark, sf):
    """D3: app postback report."""
    return reports.report_app(fx.fx_app(spark, sf), fx.fx_info(spark, sf))


@register("report_click_utm", rsql.REPORT_CLICK_UTM)
def q_report_click_utm(spark, sf):
    """Click-id and utm routes."""
    return reports.report_click_utm(fx.fx_gtm(spark, sf), fx.fx_gclid(spark, sf), fx.fx_info(spark, sf))


@register("report_metrics", rsql.REPORT_METRICS)
def q_report_metrics(spark, sf):
    """Ad-platform metrics joined to the campaign map."""
    return reports.report_metrics(fx.fx_metric(spark, sf), fx.fx_info(spark, sf), fx.fx_ytlist(spark, sf))


# ---------------------------------------------------------------- mapping
from .oracle import mapping_sql as msql  # noqa: E402
from .plans import mapping  # noqa: E402
from .sinks.tables import stored  # noqa: E402


def _weekly(spark, sf):
    return mapping.mapping_weekly(fx.fx_apm_flat(spark, sf), fx.fx_addi_bid(spark, sf), fx.fx_postback(spark, sf),
                                  fx.fx_nhn_flat(spark, sf), fx.fx_tg(spark, sf), fx.OWN_MEDIA)


def _current(spark, sf):
    """All weeks merged oldest-first: the fold of every week but the newest, then the newest
    week through the incremental MERGE (U1).  The weekly table is stored once."""
    weekly = stored(_weekly(spark, sf), "weekly")
    newest = F.lit(weekly.agg(F.max("batch_week")).scalar())
    return mapping.merge_week(mapping.merge_fold(weekly.where(F.col("batch_week") < newest)), weekly.where(F.col("batch_week") == newest))


@register("mapping_weekly", msql.MAPPING_WEEKLY)
def q_mapping_weekly(spark, sf):
    """M2: weekly stb/mobile rows for every week."""
    return _weekly(spark, sf)


@register("mapping_merge", msql.MAPPING_MERGE)
def q_mapping_merge(spark, sf):
    """M3: cumulative current table after merging every week oldest-first,
    computed as one aggregation over all weeks."""
    return mapping.merge_fold(_weekly(spark, sf))


@register("mapping_merge_incremental", msql.MAPPING_MERGE)
def q_mapping_merge_incremental(spark, sf):
    """The same state reached through the incremental MERGE of the newest
    week into the state of all earlier weeks."""
    return _current(spark, sf)


def _current_fold(spark, sf):
    """All weeks merged in one aggregation (same state as week-by-week MERGE)."""
    return mapping.merge_fold(_weekly(spark, sf))


@register("mapping_view", msql.MAPPING_VIEW)
def q_mapping_view(spark, sf):
    """M4: relation view as of a fixed date."""
    return mapping.mapping_view(_current_fold(spark, sf), msql.AS_OF)


@register("mapping_active", msql.MAPPING_ACTIVE)
def q_mapping_active(spark, sf):
    """M5: active relations."""
    return mapping.mapping_active(_current_fold(spark, sf), msql.AS_OF)


@register("stb_summary", msql.STB_SUMMARY)
def q_stb_summary(spark, sf):
    """M6: per set-top summary."""
    return mapping.stb_summary(_current_fold(spark, sf), msql.AS_OF)


@register("mapping_once", msql.MAPPING_ONCE)
def q_mapping_once(spark, sf):
    """M1: population-preserving mapping over all months."""
    return mapping.mapping_once(fx.fx_apm_flat(spark, sf), fx.fx_nhn_flat(spark, sf), fx.fx_tg(spark, sf))


@register("mapping_report", msql.MAPPING_REPORT)
def q_mapping_report(spark, sf):
    """M7: per-carrier report of the M1 table, in listed order (O2)."""
    return mapping.by_carrier(mapping.mapping_report(fx.fx_apm_flat(spark, sf), fx.fx_nhn_flat(spark, sf), fx.fx_tg(spark, sf)))


# ---------------------------------------------------------------- channel and checks
from .oracle import channel_sql as csql  # noqa: E402
from .plans import channel, quality  # noqa: E402


def _channel(spark, sf):
    pb = fx.fx_postback(spark, sf)
    return channel.channel_daily(pb, pb, fx.fx_bid_log(spark, sf), fx.fx_media(spark, sf), fx.TARGET_ID)


@register("channel_daily", csql.CHANNEL_DAILY)
def q_channel_daily(spark, sf):
    """Channel report for every day."""
    return _channel(spark, sf)


@register("check_hour_vs_daily", csql.CHECK_HOUR_VS_DAILY)
def q_check_hour_vs_daily(spark, sf):
    """Q1: per-day consistency of hour and day summaries."""
    pb, media, rates = fx.fx_postback(spark, sf), fx.fx_media(spark, sf), fx.fx_rate(spark, sf)
    return quality.check_hour_vs_daily(summary.summary_hour(pb, pb, pb, media, rates),
                                       summary.summary_daily(pb, pb, pb, fx.DAILY_RULES, media, rates, fx.fx_area(spark, sf)))


@register("check_daily_vs_channel", csql.CHECK_DAILY_VS_CHANNEL)
def q_check_daily_vs_channel(spark, sf):
    """Q2: per-day consistency of the daily summary and the channel report."""
    pb, media, rates = fx.fx_postback(spark, sf), fx.fx_media(spark, sf), fx.fx_rate(spark, sf)
    return quality.check_daily_vs_channel(
        summary.summary_daily(pb, pb, pb, fx.DAILY_RULES, media, rates, fx.fx_area(spark, sf)), _channel(spark, sf))


# ---------------------------------------------------------------- flatten
from .oracle import flatten_sql as fsql  # noqa: E402
from .plans import flatten  # noqa: E402
from .sources import bidlog  # noqa: E402


def _deal_ids(df, col="imp_deals_array"):
    """Present the deals of the first impression by id (scalar list, stable to compare)."""
    pos = df.columns.index(col)
    cols = [F.col(c) for c in df.columns]
    cols[pos] = F.transform(col, lambda d: d["id"]).alias("imp_deal_ids")
    if "app_content_producer" in df.columns:   # a struct, shown by its id
        cols[df.columns.index("app_content_producer")] = F.col("app_content_producer.id").alias("app_content_producer")
    return df.select(*cols)


@register("flatten_bids_outer", fsql.FLATTEN_OUTER)
def q_flatten_bids_outer(spark, sf):
    """one row per seat bid, NULL bid row when none."""
    return _deal_ids(flatten.flatten_bids(bidlog.fx_bid_nested(spark, sf)))


@register("flatten_bids_inner", fsql.FLATTEN_INNER)
def q_flatten_bids_inner(spark, sf):
    """requests without seat bids dropped."""
    return _deal_ids(flatten.flatten_bids(bidlog.fx_bid_nested(spark, sf), outer=False))


@register("flatten_bids_nested_first", fsql.FLATTEN_NATIVE)
def q_flatten_bids_nested_first(spark, sf):
    """the log with native impressions and sites; first metric by position, fail code kept."""
    return flatten.flatten_bids_nested(bidlog.fx_bid_native(spark, sf))


@register("flatten_bids_matched", fsql.FLATTEN_FLAT)
def q_flatten_bids_matched(spark, sf):
    """the log with a flat request; only bids on the first impression; ISO creation time."""
    return _deal_ids(flatten.flatten_bids_flat(bidlog.fx_bid_flat(spark, sf)), "imp_deals")


# ---------------------------------------------------------------- weather
from .oracle import weather_sql as wsql  # noqa: E402
from .plans import weather  # noqa: E402
from .sources import weather_fx as wfx  # noqa: E402


def _weather_parts(spark, sf):
    regions = wfx.fx_regions(spark, sf)
    return (weather.classify_forecast(wfx.fx_fcst(spark, sf)), weather.classify_dust(wfx.fx_dust(spark, sf), regions),
            weather.classify_uv(wfx.fx_uv(spark, sf)), regions)


@register("weather_forecast", wsql.WEATHER_FORECAST)
def q_weather_forecast(spark, sf):
    """Forecast classification per fetch."""
    return weather.classify_forecast(wfx.fx_fcst(spark, sf))


@register("weather_dust", wsql.WEATHER_DUST)
def q_weather_dust(spark, sf):
    """Fine-dust classification per fetch."""
    return weather.classify_dust(wfx.fx_dust(spark, sf), wfx.fx_regions(spark, sf))


@register("weather_uv", wsql.WEATHER_UV)
def q_weather_uv(spark, sf):
    """UV classification per fetch."""
    return weather.classify_uv(wfx.fx_uv(spark, sf))


@register("weather_latest", wsql.WEATHER_LATEST)
def q_weather_latest(spark, sf):
    """Latest codes per region (1-day lookback from a fixed date)."""
    f, d, u, regions = _weather_parts(spark, sf)
    return weather.weather_latest(f, d, u, regions, wsql.AS_OF)


@register("weather_alerts", wsql.WEATHER_ALERTS)
def q_weather_alerts(spark, sf):
    """Active alert codes per region."""
    return weather.active_alerts(wfx.fx_alert(spark, sf), wfx.fx_regions(spark, sf))


@register("weather_codes", wsql.WEATHER_CODES)
def q_weather_codes(spark, sf):
    """Full current code table."""
    f, d, u, regions = _weather_parts(spark, sf)
    return weather.weather_codes(f, d, u, wfx.fx_alert(spark, sf), regions, wsql.AS_OF)


@register("alert_dedup", wsql.ALERT_DEDUP)
def q_alert_dedup(spark, sf):
    """What the fetch runs store, given the hashes that they still remember."""
    return weather.dedup_alerts(wfx.fx_alert(spark, sf))


# ---------------------------------------------------------------- sinks (frames that are published)
from .sinks import tables as sinks  # noqa: E402
from .sources.tables import load  # noqa: E402

_SD = ssql.SUMMARY_DAILY


@register("publish_summary_daily", f"""SELECT MEDIACD, INVENTORYNM, AREACD, CMPNO, AGNO, CREATIVENO, EXCHANGEWON,
  IMPS, CLICKS, PAYMENT, PAYMENTCNT, Q1, Q2, Q3, Q4, ERRORIMPS, ERRORPAYMENT, DATE AS day FROM ({_SD}) s""")
def q_publish_summary_daily(spark, sf):
    """The daily summary as published to the serving table (partitions dropped, date -> day)."""
    return sinks.serving_projection(q_summary_daily(spark, sf), "report_summary_daily")


@register("export_pages_tsv", """SELECT
  CASE WHEN t = 'None' THEN '' ELSE t END AS page_id_t, CASE WHEN u = 'None' THEN '' ELSE u END AS url,
  CASE WHEN h = 'None' THEN '' ELSE h END AS html FROM (
  SELECT trim(regexp_replace(replace(regexp_replace(COALESCE(CAST(page_id AS VARCHAR), ''), '[\\n\\r\\t|]', ' ', 'g'), '"', ''''), '\\s+', ' ', 'g')) AS t,
         trim(regexp_replace(replace(regexp_replace(COALESCE(url, ''), '[\\n\\r\\t|]', ' ', 'g'), '"', ''''), '\\s+', ' ', 'g')) AS u,
         trim(regexp_replace(replace(regexp_replace(COALESCE(html, ''), '[\\n\\r\\t|]', ' ', 'g'), '"', ''''), '\\s+', ' ', 'g')) AS h
  FROM pages)""")
def q_export_pages_tsv(spark, sf):
    """Sanitised text frame of a table as written to the TSV export."""
    return sinks.sanitize_for_tsv(load(spark, sf, "pages").withColumnRenamed("page_id", "page_id_t"))


# ---------------------------------------------------------------- reach
from .oracle import reach_sql as rchsql  # noqa: E402
from .plans import reach  # noqa: E402


def _reach(spark, sf, grain):
    pb = fx.fx_postback(spark, sf)
    flights = fx.fx_adgroup(spark, sf) if grain == "ag" else fx.fx_adcampaign(spark, sf)
    prior = reach.reach_reported(pb, pb, flights, rchsql.REPORT_DATE, fx.REACH_RULES, grain)
    return reach.reach_daily(pb, pb, flights, rchsql.REPORT_DATE, fx.REACH_RULES, grain, prior=prior)


@register("reach_adgroup_daily", rchsql.REACH_ADGROUP)
def q_reach_adgroup_daily(spark, sf):
    """Ad-group reach for the report date, less what every earlier day of the flight reported."""
    return _reach(spark, sf, "ag")


@register("reach_campaign_daily", rchsql.REACH_CAMPAIGN)
def q_reach_campaign_daily(spark, sf):
    """Campaign reach for the report date."""
    return _reach(spark, sf, "cmp")


@register("check_reach_negative", rchsql.CHECK_REACH_NEGATIVE)
def q_check_reach_negative(spark, sf):
    """Q3: reach rows with a negative metric."""
    return quality.check_reach_negative(_reach(spark, sf, "ag"))


@register("attr_web_v3", asql.ATTR_WEB_V3)
def q_attr_web_v3(spark, sf):
    """First touch per (campaign, ip), then every later event, three routes."""
    return attr.attribute_v3(**_attr_inputs(spark, sf))


@register("attr_mapping_new", msql.ATTR_MAPPING_NEW)
def q_attr_mapping_new(spark, sf):
    """Attribution through the weekly set-top/mobile mapping, whole range."""
    return _by_mapping(spark, sf)


@register("attr_web_v2", asql.ATTR_WEB_V2)
def q_attr_web_v2(spark, sf):
    """v2 attribution (device, mobile id, view ip, payload), every event day."""
    return attr.attribute_v2(**_attr_inputs(spark, sf))


@register("attr_web_home", asql.ATTR_WEB_HOME)
def q_attr_web_home(spark, sf):
    """v2 with the direct route's views limited to six months before the end date; the
    log reaches further back."""
    return _home(spark, sf)


@register("mapping_analysis", msql.MAPPING_ANALYSIS)
def q_mapping_analysis(spark, sf):
    """M8: per-carrier mapping summary with union rates, all months."""
    return mapping.by_carrier(mapping.mapping_analysis(fx.fx_apm_flat(spark, sf), fx.fx_nhn_flat(spark, sf), fx.fx_tg(spark, sf)))


# ---------------------------------------------------------------- range (backfill) forms and gates
from .sinks import sync  # noqa: E402
from .sinks.tables import scratch  # noqa: E402
from .streaming import jobs as stream_jobs  # noqa: E402


@register("attr_range_v1", asql.ATTR_RANGE_V1)
def q_attr_range_v1(spark, sf):
    """v1 over an event-date range in one job (equals the union of the daily runs)."""
    return attr.attribute_v1(**_attr_inputs(spark, sf), start=asql.RANGE_START, end=asql.RANGE_END)


@register("report_range_web", rsql.REPORT_RANGE_WEB)
def q_report_range_web(spark, sf):
    """The daily unique-ip report over a date range, from the range attribution."""
    raw = attr.attribute_v1(**_attr_inputs(spark, sf), start=asql.RANGE_START, end=asql.RANGE_END)
    return reports.report_web(raw, asql.RANGE_START, asql.RANGE_END)


@register("sync_incremental", rsql.SYNC_INCREMENTAL)
def q_sync_incremental(spark, sf):
    """What a second sync appends, from the mark that the first one stored."""
    source, root = fx.fx_metric(spark, sf), scratch(spark, "sync")
    sync.run(source.where(F.col("campaign_no") <= rsql.SYNC_WATERMARK), root, "campaign_no")
    done = sync.run(source, root, "campaign_no")
    return sync.synced(spark, root, done["batch"])


@register("check_gate", f"SELECT *, error_cnt = 0 AS passed FROM ({csql.CHECK_HOUR_VS_DAILY}) c")
def q_check_gate(spark, sf):
    """Q4: pass/fail of the hour-vs-day check against the expected 0."""
    return quality.expect(q_check_hour_vs_daily(spark, sf), 0)



@register("stream_hourly_requests", fx.with_fixtures(
    """SELECT date_trunc('hour', strptime(created_at, '%Y-%m-%dT%H:%M:%SZ')) AS hour_start, cmp_no, ag_no, creative_no,
  media_id, log_type, COUNT(DISTINCT req_id) AS requests FROM fx_postback
WHERE req_id IS NOT NULL AND cmp_no IS NOT NULL AND ag_no IS NOT NULL AND creative_no IS NOT NULL
GROUP BY ALL""", "fx_postback"))
def q_stream_hourly_requests(spark, sf):
    """The result the streaming hourly distinct-request job converges to
    when nothing arrives after the watermark (its batch form)."""
    return stream_jobs.hourly_request_counts_batch(fx.fx_postback(spark, sf))


@register("summary_hour_old_rule", ssql.SUMMARY_HOUR_OLD_RULE)
def q_summary_hour_old_rule(spark, sf):
    """The older price rule (no castability filter, PAYMENT NULL without impressions)."""
    return summary.summary_lookup(fx.fx_postback(spark, sf), summary.HOUR, fx.fx_media(spark, sf),
                                  fx.fx_rate(spark, sf), older_price_rule=True)


@register("check_raw_loads", asql.CHECK_RAW_LOADS)
def q_check_raw_loads(spark, sf):
    """Q5: rows, distinct ips and campaigns per attribution table and event date."""
    inp = _attr_inputs(spark, sf)
    return quality.load_summary({
        "raw_conv_web": attr.attribute_v1(**inp),
        "raw_conv_web_home": _home(spark, sf),
        "raw_conv_web_v2": attr.attribute_v2(**inp), "raw_conv_web_v3": attr.attribute_v3(**inp),
        "raw_conv_web_imp": attr.attribute_v1(**inp, imp_date=True)})


# ---------------------------------------------------------------- further range and daily forms
_RANGE = dict(start=asql.RANGE_START, end=asql.RANGE_END)


@register("attr_range_imp", asql.ATTR_RANGE_IMP)
def q_attr_range_imp(spark, sf):
    """v1 with the impression date over an event-date range."""
    return attr.attribute_v1(**_attr_inputs(spark, sf), imp_date=True, **_RANGE)


@register("attr_range_v2", asql.ATTR_RANGE_V2)
def q_attr_range_v2(spark, sf):
    """v2 over an event-date range."""
    return attr.attribute_v2(**_attr_inputs(spark, sf), **_RANGE)


@register("attr_range_home", asql.ATTR_RANGE_V2)
def q_attr_range_home(spark, sf):
    """The home range form, which unlike the daily one has no lookback."""
    return attr.attribute_v2(**_attr_inputs(spark, sf), direct_lookback_months=None, **_RANGE)


@register("attr_range_v3", asql.ATTR_RANGE_V3)
def q_attr_range_v3(spark, sf):
    """v3 over an event-date range."""
    return attr.attribute_v3(**_attr_inputs(spark, sf), **_RANGE)


def _by_mapping(spark, sf, **how):
    """The weekly table is a stored one; of it the job reads the ids, their ips and the carrier."""
    weekly = stored(_weekly(spark, sf).where("record_type = 'MAPPING'").select("plattform_id", "ad_id", "ip", "carrier"), "weekly")
    return attr.attribute_via_mapping(fx.fx_postback(spark, sf), fx.fx_gtm(spark, sf), fx.fx_info(spark, sf),
                                      weekly, fx.fx_visit(spark, sf), **how)


@register("attr_mapping_daily", msql.ATTR_MAPPING_DAILY)
def q_attr_mapping_daily(spark, sf):
    """Attribution through the weekly mapping, one row per event day."""
    return _by_mapping(spark, sf, per_day=True)


@register("attr_range_mapping", msql.ATTR_MAPPING_RANGE)
def q_attr_range_mapping(spark, sf):
    """Attribution through the weekly mapping over an event-date range."""
    return _by_mapping(spark, sf, **_RANGE)


@register("report_range_app", rsql.REPORT_RANGE_APP)
def q_report_range_app(spark, sf):
    """App postback report over a date range."""
    return reports.report_app(fx.fx_app(spark, sf), fx.fx_info(spark, sf), **_RANGE)


@register("report_range_click_utm", rsql.REPORT_RANGE_CLICK_UTM)
def q_report_range_click_utm(spark, sf):
    """Click-id and utm report over a date range."""
    return reports.report_click_utm(fx.fx_gtm(spark, sf), fx.fx_gclid(spark, sf), fx.fx_info(spark, sf), **_RANGE)


@register("report_range_metrics", rsql.REPORT_RANGE_METRICS)
def q_report_range_metrics(spark, sf):
    """Ad-platform metrics over a date range."""
    return reports.report_metrics(fx.fx_metric(spark, sf), fx.fx_info(spark, sf), fx.fx_ytlist(spark, sf), **_RANGE)


@register("report_range_web_imp", rsql.REPORT_RANGE_WEB_IMP)
def q_report_range_web_imp(spark, sf):
    """Impression-date matrix over a range of event dates."""
    return reports.report_web_imp(attr.attribute_v1(**_attr_inputs(spark, sf), imp_date=True), **_RANGE)


@register("mapping_crowded_ips", fx.with_fixtures("SELECT DISTINCT batch_week, ip, ip_adid_cardinality FROM weekly WHERE ip_adid_cardinality > 20",
                                                  *msql._IN, ctes=msql._WEEKLY))
def q_mapping_crowded_ips(spark, sf):
    """M2: the ips that its rule leaves out."""
    return mapping.crowded_ips(_weekly(spark, sf))


@register("check_report_loads", rsql.CHECK_REPORT_LOADS)
def q_check_report_loads(spark, sf):
    """Q6: rows, metric sum and campaigns of every report table and day."""
    info, gtm = fx.fx_info(spark, sf), fx.fx_gtm(spark, sf)
    inp = _attr_inputs(spark, sf)
    return quality.report_load_summary({
        "report_addi_conv_gtm_web": (reports.report_web(attr.attribute_v1(**inp)), "dt", "daily_unique_ip", "cmp_no"),
        "report_addi_conv_gtm_web_imp": (reports.report_web_imp(attr.attribute_v1(**inp, imp_date=True)), "mall_dt",
                                         "daily_unique_ip", "cmp_no"),
        "report_addi_conv_app": (reports.report_app(fx.fx_app(spark, sf), info), "dt", "daily_unique_ip", "cmp"),
        "report_addi_conv_gtm_youtube": (reports.report_click_utm(gtm, fx.fx_gclid(spark, sf), info), "dt",
                                         "daily_unique_ip", "cmp_no"),
        "report_addi_conv_metric_youtube": (reports.report_metrics(fx.fx_metric(spark, sf), info, fx.fx_ytlist(spark, sf)),
                                            "date", "conversions", "cmp_no")})
