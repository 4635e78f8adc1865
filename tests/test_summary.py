from adpulse.plans import summary

COLS = ("req_id string, log_type string, is_cpvc string, price string, media_id string, cmp_no bigint, "
        "ag_no bigint, creative_no bigint, year string, month string, day string, hour string")


def _pb(spark, rows):
    full = [r + ("2024", "01", "20", "05") for r in rows]
    return spark.createDataFrame(full, COLS)


def test_text_max_price_and_payment_duplicates(spark):
    rows = [("r1", "i", "1", "9.5", "M", 1, 1, 1), ("r1", "i", "1", "10.2", "M", 1, 1, 1),
            ("r1", "c", "0", "abc", "M", 1, 1, 1), ("r2", "i", "1", None, "M", 1, 1, 1),
            ("r3", "e_i", "0", "1.0", "M", 1, 1, 1)]
    out = summary.summary_lookup(_pb(spark, rows)).collect()[0]
    # text order: '9.5' > '10.2'; the price is added on every 'i' row of the request
    assert out["PAYMENT"] == 19.0
    assert out["IMPS"] == 2 and out["CLICKS"] == 1 and out["ERRORIMPS"] == 1
    assert out["ERRORPAYMENT"] == 1.0 and out["PAYMENTCNT"] == 2
    num = summary.summary_lookup(_pb(spark, rows), numeric_price=True).collect()[0]
    assert num["PAYMENT"] == 20.4


def test_exchange_rate_previous_month(spark):
    rates = spark.createDataFrame([(20231210, 1300.0), (20231228, 1310.0), (20240105, 1400.0)],
                                  "regd bigint, exchangerate double")
    pb = _pb(spark, [("r1", "i", "1", "1", "M", 1, 1, 1)])
    assert summary.summary_lookup(pb, rates=rates).collect()[0]["EXCHANGEWON"] == 1310.0
    none = spark.createDataFrame([(20240105, 1400.0)], "regd bigint, exchangerate double")
    assert summary.summary_lookup(pb, rates=none).collect()[0]["EXCHANGEWON"] == 0.0


def test_media_fanout_weight(spark):
    media = spark.createDataFrame([("M", "Y"), ("M", "Y"), ("N", "Y")], "mediacd string, logparsefg string")
    rows = [("r1", "c", "0", "1", "M", 1, 1, 1), ("r1", "i", "1", "2.0", "M", 1, 1, 1)]
    out = summary.summary_lookup(_pb(spark, rows), media=media).collect()[0]
    assert out["CLICKS"] == 2 and out["PAYMENT"] == 4.0 and out["IMPS"] == 1


def test_dedup_feed_counts_distinct_rows(spark):
    rows = [("r1", "i", "1", "2.0", "M", 1, 1, 1), ("r1", "i", "1", "2.0", "M", 1, 1, 1),
            ("r2", "c", "0", "1.0", "M", 1, 1, 1), (None, "i", "1", "5", "M", 1, 1, 1)]
    out = summary.summary_dedup(_pb(spark, rows)).collect()[0]
    assert out["IMPS"] == 1 and out["CLICKS"] == 1 and out["PAYMENT"] == 2.0 and out["ERRORIMPS"] == 0


def test_listed_twice_medium_counts_twice(spark):
    """The fixture's third medium is listed twice, so its rows weigh 2 where rows are counted."""
    from adpulse.plans import summary
    from adpulse.sources import fixtures as fx
    from tests.conftest import SF_SMALL
    pb, media = fx.fx_postback(spark, SF_SMALL), fx.fx_media(spark, SF_SMALL)
    sums = {m: {r.MEDIACD: r.n for r in summary.summary_lookup(pb, summary.HOUR, t).groupBy("MEDIACD").agg({"CLICKS": "sum"})
                .withColumnRenamed("sum(CLICKS)", "n").collect()} for m, t in (("listed", media), ("once", media.distinct()))}
    for code in fx.MEDIA_CODES:
        assert sums["listed"][code] == (2 if code == fx.MEDIA_CODES[2] else 1) * sums["once"][code] > 0
