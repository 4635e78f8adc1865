"""Reports over logs whose dimensions list the same thing many times."""

from adpulse.plans import reports

GTM = "log_time string, pid string, url string, gclid string, ev string, conv_type string, click string, ip string"


def _click_inputs(spark, copies):
    at, url = "2024/01/0{}/10:00:00", "https://s/p?utm_campaign="
    gtm = spark.createDataFrame([
        (at.format(1), "px1", url + "100&x=1", "g1", "view", None, None, "a"), (at.format(1), "px1", url + "100", None, "view", None, None, "b"),
        (at.format(1), "px1", None, "g1", "view", None, None, "a"), (at.format(1), "px1", None, "g1", "click", None, "cta", None),
        (at.format(2), "px2", url, "g2", "conversion", "buy", None, "c"), (at.format(2), None, None, "none", "view", None, None, "d")], GTM)
    ids = [(100, "g1"), (200, "g1"), (300, "g2"), (None, "g2"), (400, None)]
    infos = [(1, "100", "px1"), (2, "200", "px9"), (None, "300", "px2"), (3, None, "px2"), (4, "100", None)]
    return (gtm, spark.createDataFrame(ids * copies, "cmp_you_no long, gclid string"),
            spark.createDataFrame(infos * copies, "cmp_no long, cmp_you_no string, pixel_id string"))


def test_click_ids_listed_many_times_multiply_no_event(spark):
    rows = lambda n: sorted(map(str, reports.report_click_utm(*_click_inputs(spark, n)).collect()))
    once = reports.report_click_utm(*_click_inputs(spark, 1))
    got = {(r.cmp_no, r.cmp_you_no, r.ev): r.daily_unique_ip for r in once.collect()}
    assert got == {(1, "100", "view"): 2, (4, "100", "view"): 1, (2, "200", "view"): 1, (1, "100", "cta"): 0, (4, "100", "cta"): 0,
                   (2, "200", "cta"): 0}
    assert rows(1) == rows(3)
    # The rows that the joins form, counted on the way, do not grow with the copies.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = reports.report_click_utm(*_click_inputs(spark, 50))
        out.collect()
        todo, joined = [out._jdf.queryExecution().executedPlan()], 0
        while todo:
            node = todo.pop()
            if "Join [gclid#" in node.simpleString(100):
                joined = max(joined, node.metrics().apply("numOutputRows").value())
            todo += [node.children().apply(k) for k in range(node.children().size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 0 < joined <= 100, joined
