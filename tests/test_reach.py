"""The prior of the reach reports: every earlier day, against the daily runs one after another."""

from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest

from adpulse.plans import reach
from adpulse.plans.rules import ReachRules

DATE = "2024-01-06"
RULES = ReachRules(media=("X1", "X2", "X3"), daily_media="X1", app_media=("X1", "X2"), test_media="X3")
FLIGHTS = [(1, "2024-01-01", "2024-01-03"), (2, "2024-01-02", "2024-01-09"), (3, "2024-01-03", "2024-01-09"), (4, "2024-01-06", "2024-01-09")]


def events():
    out = []
    for i in range(600):
        day = 1 + i * 7 % 6
        group = 1 + i * 5 % 4
        if group == 3 and day == 5:
            continue                    # idle on the day before the report
        out.append((f"{day:02d}", 10 + i % 2, group, ("v_complete", "v_complete", "i")[i % 3], None if i % 17 == 0 else f"d{i * i % 23}",
                    "X1" if i % 4 else "X2", f"app{i % 3}", "tv" if i % 5 == 0 else None))
    return out


def brute(key):
    """Reports of every day, one after the other, each less all rows of its key before it."""
    at = {"ag": 2, "cmp": 1}[key]
    flights = FLIGHTS if key == "ag" else [(10, "2024-01-01", "2024-01-09"), (11, "2024-01-02", "2024-01-09")]
    whole = lambda e: (e[1], e[2]) if key == "ag" else (e[1],)
    made, d = [], date(2024, 1, 1)
    while str(d) <= DATE:
        running = {f: s for f, s, e in flights if s <= str(d) <= e}
        n, rows = Counter(), defaultdict(set)
        for e in events():
            day = f"2024-01-{e[0]}"
            tv = bool(e[7])
            if e[at] in running and e[3] == "v_complete" and e[4] and min(running.values()) <= day <= str(d):
                n[whole(e), e[4]] += 1 + tv
            if day == str(d) and (e[5] == "X1" or tv):
                rows[whole(e)].add(e[6] if key == "ag" else None)
        new = []
        for k, inventories in rows.items():
            f = k[at - 1]
            if any(w == k for w, _ in n):
                past = [r for r in made if r[1][at - 1] == f and running[f] <= r[0] < str(d)]
                reached = tuple(sum(c >= j for (w, _), c in n.items() if w == k) - sum(r[2][j - 1] for r in past) for j in (1, 2, 3))
                new += [(str(d), k, reached)] * len(inventories)
        made += new
        d += timedelta(1)
    return sorted((r[1], r[2]) for r in made if r[0] == DATE), flights


@pytest.mark.parametrize("key", ["ag", "cmp"])
def test_reach_subtracts_every_earlier_day(spark, key):
    want, flights = brute(key)
    logs = spark.createDataFrame([("2024", "01", *e) for e in events()],
                                 "year string, month string, day string, cmp_no long, ag_no long, log_type string, ifa string, media_id string, app_id string, ctv_media string")
    name = "agno" if key == "ag" else "cmpno"
    fl = spark.createDataFrame([(f, s + " 00:00:00", e + " 23:59:59", "Y") for f, s, e in flights], f"{name} long, startdt string, enddt string, logparsefg string")
    got = reach.reach_daily(logs, logs, fl, DATE, RULES, key, prior=reach.reach_reported(logs, logs, fl, DATE, RULES, key))
    cols = ["CMPNO", "AGNO"] if key == "ag" else ["CMPNO"]
    assert sorted((tuple(r[c] for c in cols), (r.REACH1, r.REACH2, r.REACH3)) for r in got.collect()) == want
    # The daily runs themselves, each with the rows of those before it, give the same.
    rows, schema = [], None
    for day in range(1, 7):
        prior = spark.createDataFrame(rows, schema) if rows else None
        one = reach.reach_daily(logs, logs, fl, f"2024-01-{day:02d}", RULES, key, prior=prior)
        last = one.collect()
        rows, schema = rows + last, one.schema
    assert sorted((tuple(r[c] for c in cols), (r.REACH1, r.REACH2, r.REACH3)) for r in last) == want
