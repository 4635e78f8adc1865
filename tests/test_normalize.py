from pyspark.sql import functions as F

from adpulse.functions import normalize as N


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_carrier_from_bundle_order_and_tokens(spark):
    vals = ["com.kt.tv", "kt", "market", "u+tv", "skb.kt", "lguplus.app", "ktx", None]
    got = _one(spark, [(v,) for v in vals], "b string", N.carrier_from_bundle("b"))
    assert got == ["KT", "KT", None, "U+", "SKB", "U+", None, None]


def test_carrier_from_ctv_plain_kt(spark):
    got = _one(spark, [("ktx",), ("skb_kt",), ("olleh",)], "b string", N.carrier_from_ctv("b"))
    assert got == ["KT", "SKB", None]


def test_carrier_channel_modes(spark):
    rows = [("KT_skb",), ("lguplus",), ("uplus",), ("other",)]
    assert _one(spark, rows, "b string", N.carrier_channel("b", "uplus")) == ["KT", "LGU", "LGU", "other"]
    assert _one(spark, rows, "b string", N.carrier_channel("b", "lguplus")) == ["KT", "LGU", "uplus", "other"]


def test_ip_and_id_rules(spark):
    ips = ["::ffff:1.2.3.4", " 10.0.0.1 ", "::1", "", None, "UNDEFINED"]
    assert _one(spark, [(v,) for v in ips], "i string", N.norm_ip("i"))[:2] == ["1.2.3.4", "10.0.0.1"]
    assert _one(spark, [(v,) for v in ips], "i string", N.valid_ip("i")) == [True, True, False, False, False, False]
    ids = ["ABC", "00000000-0000-0000-0000-000000000000", "undefined", " ", None]
    assert _one(spark, [(v,) for v in ids], "i string", N.valid_id("i")) == [True, False, False, False, False]
    attr = ["0000000-0000-0000-0000-000000000000", "adid_none", "x"]
    assert _one(spark, [(v,) for v in attr], "i string", N.valid_id_attr("i")) == [False, False, True]


def test_strict_least_greatest(spark):
    rows = [(1, 2), (None, 2), (3, None)]
    assert _one(spark, rows, "a int, b int", N.strict_least("a", "b")) == [1, None, None]
    assert _one(spark, rows, "a int, b int", N.strict_greatest("a", "b")) == [2, None, None]


def test_event_name_and_regex_null(spark):
    rows = [("conversion", None, None), ("conversion", " ", None), ("click", None, "cta"), ("view", "x", "y")]
    s = "ev string, ct string, cl string"
    assert _one(spark, rows, s, N.event_name("ev", "ct", "cl")) == ["conversion", " ", "cta", "view"]
    assert _one(spark, rows, s, N.event_name("ev", "ct", "cl", blank_aware=True)) == [
        "conversion", "conversion", "cta", "view"]
    urls = [("a?utm_campaign=7&x",), ("a?x=1",)]
    assert _one(spark, urls, "u string", N.regexp_extract_or_null("u", r"utm_campaign=([^&]+)")) == ["7", None]


def test_safe_subscript(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "a array<int>")
    assert [r[0] for r in df.select(N.safe_get("a", 0)).collect()] == [1, None, None]


def test_area_code(spark):
    rows = [(None,), ("",), ("-99",), ("undefined",), ("11",)]
    assert _one(spark, rows, "a string", N.area_code("a")) == ["-1", "-1", "-1", "-1", "11"]
    assert _one(spark, rows, "a string", F.coalesce(N.round_pct(F.lit(1), F.lit(3)), F.lit(0.0))) == [33.33] * 5


def test_carrier_tests_agree_with_the_carriers(spark):
    vals = ["com.kt.tv", "KT", "market", "u+tv", "skb.kt", "LGuplus.app", "lg+", "lguplu", "ktx", "akt", "a-kt b", "u", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "b string")
    for test, carrier in ((N.carrier_in_bundle, N.carrier_from_bundle), (N.carrier_in_ctv, N.carrier_from_ctv)):
        assert [r[0] for r in df.where(test("b")).collect()] == [r[0] for r in df.where(carrier("b").isNotNull()).collect()]
