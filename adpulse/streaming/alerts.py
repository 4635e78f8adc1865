"""Alert dedup as a stream, with the rule of the fetch runs (T4).

Each run's alerts land as one file, and a micro-batch is one run (``max_files_per_trigger=1``).
The watermark without delay is then the time of the run before.  A hash's state is the day on
which it was noted; it is forgotten at the end of the first run whose day is later than that
day plus the retention.  So an alert is stored if its hash is unknown, or if the run before
came after the last day on which the hash is kept.  An event-time timeout drops the state of
hashes that are not fetched again.  Day, mark and state survive a restart in the checkpoint."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .jobs import alert_hash

_EPOCH = dt.date(1970, 1, 1)
_DAY_MS = 86_400_000


def dedup_alert_runs(alerts: DataFrame, retention_days: int = 8) -> DataFrame:
    """The alerts that the runs store, with their ``item_hash``; days are those of UTC."""
    rows = alerts.withColumn("item_hash", alert_hash())
    schema = rows.schema
    order = rows.columns

    def keep(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        found = pd.concat(list(parts), ignore_index=True)
        before = state.getCurrentWatermarkMs() // _DAY_MS          # day of the run before
        noted = state.get[0] if state.exists else None
        out = []
        for at, same in sorted(found.groupby("fetched_at"), key=lambda g: g[0]):       # one run, as the files land
            if noted is None or before > noted + retention_days:
                out.append(min((tuple(r) for r in same[order].itertuples(index=False, name=None)), key=_sortable))
                noted = (at.date() - _EPOCH).days
            before = max(before, (at.date() - _EPOCH).days)
        state.update((noted,))
        # The timer must lie ahead of the watermark; until it fires, the comparison above decides.
        state.setTimeoutTimestamp(max((noted + retention_days + 1) * _DAY_MS, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=order)

    return (rows.withWatermark("fetched_at", "0 seconds").groupBy("item_hash")
            .applyInPandasWithState(keep, schema, T.StructType([T.StructField("noted", T.LongType())]), "append", GroupStateTimeout.EventTimeTimeout))


def _sortable(row: tuple) -> tuple:
    """NULLs first, as Spark orders a struct."""
    return tuple((v is not None and v == v, v if v is not None and v == v else 0) for v in row)
