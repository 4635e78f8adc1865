"""Column-level building blocks: pure ``Column -> Column`` functions.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Junk identifiers and addresses of the mapping and attribution rules.
MAPPING_JUNK_IDS = ["null", "undefined", "00000000-0000-0000-0000-000000000000"]
ATTR_JUNK_IDS = ["0000000-0000-0000-0000-000000000000",
                 "00000000-0000-0000-0000-000000000000", "adid_none"]
JUNK_IPS = ["null", "undefined", "0.0.0.0", "127.0.0.1", "::", "::1"]
KT_TOKEN_PATTERN = r"(^|[._ -])kt([._ -]|$)"
# Carriers by what their lower-cased names hold, the first that matches; 'uplus' is in 'lguplus' too.
BUNDLE_CARRIERS = {"SKB": "skb", "U+": r"uplus|u\+|lg\+", "KT": KT_TOKEN_PATTERN}
CTV_CARRIERS = BUNDLE_CARRIERS | {"KT": "kt"}
IPV4_MAPPED_PREFIX = r"^::ffff:"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif_blank(c) -> Column:
    """``NULLIF(TRIM(x), '')``."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def is_present(c) -> Column:
    """Blank-as-null guard: ``NULLIF(TRIM(x),'') IS NOT NULL``."""
    return nullif_blank(c).isNotNull()


def norm_id(c) -> Column:
    """``lower(trim(x))``."""
    return F.lower(F.trim(_c(c)))


def norm_ip(c) -> Column:
    """lower/trim and strip an IPv4-mapped IPv6 prefix."""
    return F.regexp_replace(F.lower(F.trim(_c(c))), IPV4_MAPPED_PREFIX, "")


def valid_id(c) -> Column:
    """Non-blank and not a placeholder (mapping rule set)."""
    return F.coalesce(~norm_id(c).isin("", *MAPPING_JUNK_IDS), F.lit(False))


def valid_id_attr(c) -> Column:
    """Not a zero UUID / none marker (attribution rule set); NULL stays NULL."""
    return ~_c(c).isin(*ATTR_JUNK_IDS)


def valid_ip(c) -> Column:
    """Non-blank, not a placeholder or loopback (tested before the prefix strip)."""
    return F.coalesce(~F.lower(F.trim(_c(c))).isin("", *JUNK_IPS), F.lit(False))


def _first_carrier(c, rules: dict[str, str]) -> Column:
    b = F.lower(_c(c))
    return F.coalesce(*[F.when(b.rlike(pattern), name) for name, pattern in rules.items()])


def _any_carrier(c, rules: dict[str, str]) -> Column:
    return F.lower(_c(c)).rlike("|".join(rules.values()))


def carrier_from_bundle(c) -> Column:
    """Carrier from an app bundle; order of the tests matters."""
    return _first_carrier(c, BUNDLE_CARRIERS)


def carrier_in_bundle(c) -> Column:
    """Whether N6 finds a carrier, as one test: a filter on N6 itself repeats the bundle's own
    expression for every pattern, which makes scans too large to be compiled."""
    return _any_carrier(c, BUNDLE_CARRIERS)


def carrier_from_ctv(c) -> Column:
    """As N6 but KT matches anywhere in the text."""
    return _first_carrier(c, CTV_CARRIERS)


def carrier_in_ctv(c) -> Column:
    """Whether N7 finds a carrier."""
    return _any_carrier(c, CTV_CARRIERS)


def carrier_channel(c, lgu_token: str = "uplus") -> Column:
    """KT first, then LGU (``uplus`` or ``lguplus`` token), then SKB, else the value."""
    b = F.lower(_c(c))
    return (F.when(b.contains("kt"), "KT").when(b.contains(lgu_token), "LGU")
            .when(b.contains("skb"), "SKB").otherwise(_c(c)))


def event_name(ev, conv_type, click, blank_aware: bool = False) -> Column:
    """Conversions are named by their type and clicks by their target,
    falling back to the raw event name when that is missing (or blank)."""
    ev, conv_type, click = _c(ev), _c(conv_type), _c(click)
    if blank_aware:
        conv_type, click = nullif_blank(conv_type), nullif_blank(click)
    return (F.when(ev == "conversion", F.coalesce(conv_type, ev))
            .when(ev == "click", F.coalesce(click, ev)).otherwise(ev))


def area_code(c, missing=("", "-99", "undefined")) -> Column:
    """NULL and the listed markers become '-1'."""
    x = _c(c)
    return F.when(x.isNull() | x.isin(*missing), F.lit("-1")).otherwise(x)


def observed_at(year, month, day, hour) -> Column:
    """Timestamp of an hour partition (unpadded parts accepted); built from
    integers rather than by parsing text."""
    i = lambda c: _c(c).cast("int")
    return F.make_timestamp(i(year), i(month), i(day), i(hour), F.lit(0), F.lit(0))


def month_bounds(year: int, month: int) -> tuple[Column, Column]:
    """First second and last second of a calendar month."""
    first = F.make_timestamp(F.lit(year), F.lit(month), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    last = F.to_timestamp(F.concat(F.last_day(first.cast("date")).cast("string"), F.lit(" 23:59:59")))
    return first, last


def strict_least(*cols) -> Column:
    """LEAST with the NULL-if-any-NULL rule (Spark's own skips NULLs)."""
    cs = [_c(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cs])
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def strict_greatest(*cols) -> Column:
    """GREATEST with the NULL-if-any-NULL rule."""
    cs = [_c(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cs])
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def safe_get(arr, idx: int) -> Column:
    """0-based subscript that is NULL out of bounds, for NULL arrays and NULL parents."""
    return F.get(_c(arr), idx)


def regexp_extract_or_null(c, pattern: str, group: int = 1) -> Column:
    """REGEXP_EXTRACT with NULL (not '') on no match."""
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))


def yyyymmdd(year, month, day) -> Column:
    """Integer yyyymmdd from partition strings."""
    return (_c(year).cast("int") * 10000 + _c(month).cast("int") * 100 + _c(day).cast("int"))


def date_of_parts(year, month, day) -> Column:
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), _c(day).cast("int"))


def round_pct(num, den, digits: int = 2) -> Column:
    """``ROUND(100.0 * a / NULLIF(b, 0), 2)`` in double arithmetic."""
    return F.round(F.lit(100.0) * _c(num).cast("double") / F.nullif(_c(den), F.lit(0)), digits)
