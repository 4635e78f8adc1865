"""Time-ordered lookups without pair explosion (as-of style joins)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def next_event_within(probes: DataFrame, events: DataFrame, keys: list[str], probe_ts: str,
                      event_ts: str, horizon_days: int, out: str) -> DataFrame:
    """For every probe row, the earliest event time ``t`` of the same keys with
    ``probe_ts <= t <= probe_ts + horizon_days`` (NULL if none).

    Two windows, both linear-time running frames:
      * within (keys, day): a reverse running MIN over probes and events
        sorted together finds the next event on the probe's own day;
      * across days: one row per (keys, day) with that day's first event, and a
        reverse running MIN over the following days.
    A hot key therefore sorts its rows per day, and its cross-day pass only has
    one row per day -- no probe x event pairs are ever formed.
    """
    pcols = probes.columns
    p = probes.select(*pcols, F.col(probe_ts).alias("_t"), F.lit(0).alias("_k"),
                      F.lit(None).cast("timestamp").alias("_e"))
    e = events.select(*keys, *[F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in pcols if c not in keys],
                      F.col(event_ts).alias("_t"), F.lit(1).alias("_k"), F.col(event_ts).alias("_e"))
    u = p.unionByName(e).withColumn("_d", F.to_date("_t"))
    same_day = Window.partitionBy(*keys, "_d").orderBy(F.desc("_t"), F.desc("_k")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    probed = u.withColumn("_same", F.min("_e").over(same_day)).where(F.col("_k") == 0)
    days = u.groupBy(*keys, "_d").agg(F.min("_e").alias("_dmin"))
    later_days = Window.partitionBy(*keys).orderBy(F.desc("_d")).rowsBetween(Window.unboundedPreceding, -1)
    later = days.select(*keys, "_d", F.min("_dmin").over(later_days).alias("_later"))
    res = probed.join(later, [*keys, "_d"], "left")
    nxt = F.coalesce("_same", "_later")
    limit = F.col("_t") + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(horizon_days))
    return res.select(*pcols, F.when(nxt <= limit, nxt).alias(out))
