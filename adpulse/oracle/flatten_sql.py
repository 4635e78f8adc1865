"""DuckDB oracles for flattening the bid logs (all hours).

Every column is read from the record by the path that the published table's layout gives it;
the lists here are written for themselves."""

from ..sources import bidlog  # noqa: F401  (registers the bid logs)
from ..sources.fixtures import with_fixtures

_PARTS = "t.year AS year, t.month AS month, t.day AS day, t.hour AS hour"
_EACH = "LEFT JOIN LATERAL (SELECT unnest(t.res.seatbid) AS seat) s ON TRUE"


def _under(record: str, prefix: str, fields: str) -> str:
    """``fields`` of a record, each named by its path with ``prefix`` before."""
    names = fields.split()
    return ", ".join(f"{record}.{'.'.join(chr(34) + x + chr(34) for x in n.split('.'))} AS {prefix}{n.replace('.', '_')}" for n in names)


def _by_type() -> str:
    hit = "list_filter(t.req.imp[1].metric, lambda m: m.type = '{0}')[1].{1} AS {0}_{1}"
    return ", ".join(hit.format(t, f) for f in ("value", "vendor") for t in ("click_through_rate", "viewability", "session_depth"))


_FIRST = f"""{_under("t.req", "req_", "id at tmax")}, t.req.cur AS currency_list, t.req.media_id AS media_id, t.req."user".id AS req_user_id,
  t.created_at AS created_at,
  {_under("t.req.imp[1]", "imp_", "id banner.w banner.h banner.pos tagid bidfloor bidfloorcur ad_type secure banner.format "
          "video.mimes video.linearity video.minduration video.maxduration video.w video.h video.startdelay video.pos video.api "
          "video.companionad native displaymanager instl")},
  list_transform(CASE WHEN t.req.imp[1].deal_type = 'pmp' THEN t.req.imp[1].deals END, lambda d: d.id) AS imp_deal_ids,
  {_by_type()}, t.req.imp[1].exp AS exp, t.req.imp[1].ext.billing_id AS ext_billing_id,
  {_under("t.req.app", "app_", "bundle name publisher.id ver storeurl content.data content.url content.language content.livestream "
          "content.userrating content.genre")},
  t.req.app.content.producer.id AS app_content_producer, t.req.app.content.producer.domain AS app_content_domain,
  {_under("t.req.site", "site_", "page publisher.id content.genre content.contentrating content.livestream content.producer "
          "content.language mobile")},
  {_under("t.req.device", "device_", "ip ifa geo.lat geo.lon geo.country os ua geo.region geo.accuracy geo.zip carrier make model osv "
          "devicetype connectiontype w h pxratio lmt sua.platform.brand sua.platform.version sua.mobile sua.bitness sua.model "
          "sua.architecture")},
  t.req.device.geo.city AS device_geocity, t.req.device.geo.utcoffset AS device_utcoffset,
  {_under("t.req.device.sua.browsers[1]", "device_sua_browsers_", "brand version")},
  {_under("t.req.ext", "req_ext_", "bid_feedback google_query_id fcap_scope")},
  t.req.ext.privacy_treatments.allow_user_data_collection AS req_ext_allow_user_data_collection, t.req.bcat AS req_bcat,
  t.res.id AS res_id, {_under("s.seat", "", "price crtv_no crid cmp_no ag_no deal_id impid")}, {_PARTS}"""

FLATTEN_OUTER = with_fixtures(f"SELECT {_FIRST} FROM fx_bid_nested t {_EACH}", "fx_bid_nested")
FLATTEN_INNER = with_fixtures(f"SELECT {_FIRST} FROM fx_bid_nested t, LATERAL (SELECT unnest(t.res.seatbid) AS seat) s", "fx_bid_nested")

_NATIVE = f"""{_under("t.req", "req_", "id at tmax bcat badv")}, t.req.cur AS currency_list, t.req.media_id AS media_id, t.created_at AS created_at,
  {_under("t.req.imp[1]", "imp_", "id tagid bidfloor bidfloorcur secure deal_type ad_type banner.w banner.h banner.pos displaymanager instl "
          "native.request native.ver native.api native.battr")}, {_under("t.req.imp[1].metric[1]", "imp_metric_", "type value vendor")},
  {_under("t.req.site", "site_", "page id domain name cat mobile publisher.id publisher.name publisher.domain")},
  {_under("t.req.device", "device_", "ua ip os osv ifa geo.country geo.lat geo.lon geo.city geo.type geo.zip geo.region geo.utcoffset "
          "geo.accuracy lmt carrier make model devicetype language connectiontype pxratio w h sua.platform.brand sua.platform.version "
          "sua.mobile sua.source sua.architecture sua.bitness sua.model")},
  {_under("t.req.device.sua.browsers[1]", "device_sua_browsers_", "brand version")},
  {_under("t.req.app", "app_", "name ver bundle storeurl id cat publisher.id publisher.name publisher.domain content.url "
          "content.language content.userrating content.genre content.producer")},
  t.req."user".id AS user_id, t.res.id AS res_id, t.fail_code AS fail_code,
  {_under("s.seat", "", "impid price crid cmp_no ag_no crtv_no")}, {_PARTS}"""

FLATTEN_NATIVE = with_fixtures(f"SELECT {_NATIVE} FROM fx_bid_native t {_EACH}", "fx_bid_native")

_FLAT = f"""{_under("t.req", "", "req_id media_id app_id app_name app_bundle app_cate site_id site_name site_domain site_cate publisher_id "
                    "publisher_name publisher_domain publisher_cate ifa language os ip devicetype content_id content_title "
                    "content_genre contentrating country zipcode")}, t.req.at AS req_at,
  {_under("t.req.imp[1]", "imp_", "id tagid bidfloorcur bidfloor deal_type mimes minduration maxduration w h ad_type")},
  list_transform(t.req.imp[1].deals, lambda d: d.id) AS imp_deal_ids, t.res.id AS res_id,
  {_under("s.seat", "res_", "price deal_id bid_crtv_no bid_cmp_no bid_ag_no")},
  strptime(t.created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at, {_PARTS}"""

FLATTEN_FLAT = with_fixtures(
    f"SELECT {_FLAT} FROM fx_bid_flat t LEFT JOIN LATERAL (SELECT unnest(list_filter(t.res.seatbid, "
    "lambda sb: sb.imp_id = t.req.imp[1].id)) AS seat) s ON TRUE", "fx_bid_flat")
