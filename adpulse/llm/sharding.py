"""Sharding by minimax contiguous partition.

Equal texts form a group that stays together; groups are ordered by a hash of their
text.  The smallest capacity for which contiguous runs of groups fit into the shards
is found by binary search, each probe checked greedily.  The groups stay on the
executors: the search works on a histogram over ranges of the key.  Ranges that a cut
could fall into are split further, in as many rounds as it takes until the bounds
from uncut and from freely cut ranges agree; then the capacity is exact.  Each
round's histogram is bounded by the number of shards, not by the rows.

The cuts: as near to an equal split as that capacity allows, so that one large group
does not leave other shards empty.

Slots number each shard's rows without gaps, by a salted rank: a group may hold a
third of all rows.

Edge cases: a null text has size 1 and goes with the empty ones; repeated rows get
slots of their own; an empty table gives no rows."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SHARDS = 16
FIRST_BITS = 12          # of the key, in the first histogram
MORE_BITS = 6            # that each further round splits a range by
SALTS = 1024


class _Ranges:
    """Ordered ranges of groups as (first key, shift, size, groups)."""

    def __init__(self, cells: list[tuple[int, int, int, int]]):
        self.cells = sorted(cells)
        self.ends = [0]
        for c in self.cells:
            self.ends.append(self.ends[-1] + c[2])
        self.total = self.ends[-1]

    def strict(self, at: int) -> int:
        """The last border at or before a position."""
        return self.ends[bisect_right(self.ends, at) - 1]

    def free(self, at: int) -> int:
        """The same if ranges of several groups could be cut anywhere."""
        k = bisect_right(self.ends, at) - 1
        return at if k < len(self.cells) and self.cells[k][3] > 1 else self.ends[k]

    def cuts(self, capacity: int, shards: int, step) -> list[int]:
        out, at = [], 0
        for _ in range(shards):
            at = min(step(at + capacity), self.total)
            out.append(at)
        return out

    def least(self, low: int, shards: int, step) -> int:
        """The smallest capacity from ``low`` on for which the greedy cuts reach the end."""
        high = max(low, self.total)
        while low < high:
            mid = (low + high) // 2
            if self.cuts(mid, shards, step)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return low

    def even(self, capacity: int, shards: int) -> list[int]:
        """Borders of shards of at most ``capacity``, each as near to an equal part of
        the rest as the others' room allows."""
        latest = [self.total]
        for _ in range(shards - 1):
            latest.append(self.ends[bisect_left(self.ends, max(0, latest[-1] - capacity))])
        latest.reverse()
        out, at = [], 0
        for k in range(shards - 1):
            wish = at + (self.total - at) / (shards - k)
            i = bisect_left(self.ends, wish)
            near = min(self.ends[max(0, i - 1):i + 1] or [self.total], key=lambda e: abs(e - wish))
            at = max(at, latest[k], min(near, self.strict(at + capacity)))
            out.append(at)
        return out


def _histogram(groups: DataFrame, shift: int) -> list[tuple[int, int, int, int]]:
    rows = (groups.groupBy(F.shiftright("_key", shift).alias("_cell"))
            .agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("n")).collect())
    return [(r["_cell"] << shift, shift, r["size"], r["n"]) for r in rows]


def cut_keys(groups: DataFrame, shards: int = SHARDS) -> tuple[int, list[int]]:
    """The smallest capacity, and the first key of each shard but the first, from a
    table of groups (_key, _size)."""
    largest = groups.agg(F.max("_size")).first()[0]
    if largest is None:
        return 0, []
    shift = 64 - FIRST_BITS
    ranges = _Ranges(_histogram(groups, shift))              # at most 2**FIRST_BITS ranges
    while True:
        low = ranges.least(max(largest, -(-ranges.total // shards)), shards, ranges.free)
        high = ranges.least(max(largest, -(-ranges.total // shards)), shards, ranges.strict)
        if low == high or shift == 0:
            break
        # The k-th cut lies between where the two kinds of greedy cuts put it.
        spans = list(zip(ranges.cuts(low, shards, ranges.strict), ranges.cuts(high, shards, ranges.free)))
        open_ = [c for c, a, b in zip(ranges.cells, ranges.ends, ranges.ends[1:])
                 if c[3] > 1 and any(a <= hi and lo <= b for lo, hi in spans)]
        new = max(0, shift - MORE_BITS)
        at_once = [c for c in open_ if c[1] == shift]
        if not at_once:                                      # older, wider ranges first
            at_once, new = open_, max(0, max(c[1] for c in open_) - MORE_BITS)
        inside = F.lit(False)
        for wide in sorted({c[1] for c in at_once}):
            inside = inside | F.shiftright("_key", wide).isin([c[0] >> wide for c in at_once if c[1] == wide])
        gone = set(at_once)
        ranges = _Ranges([c for c in ranges.cells if c not in gone] + _histogram(groups.where(inside), new))
        shift = min(shift, new)
    at = {e: c[0] for e, c in zip(ranges.ends, ranges.cells)}
    last = (1 << 63) - 1
    return high, [at.get(e, last) for e in ranges.even(high, shards)]


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_key")), "sized")
    groups = stored(rows.groupBy("_key").agg(F.sum("size").alias("_size")), "groups")
    _, keys = cut_keys(groups, shards)
    place = sum((F.when(F.col("_key") >= k, 1).otherwise(0) for k in keys), F.lit(0)).cast("int")
    rows = rows.withColumn("shard", place).withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    parts = rows.groupBy("shard", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("shard", "_salt").orderBy("doc_id", "_key", "size")
    return (rows.join(F.broadcast(offsets), ["shard", "_salt"])          # at most shards * SALTS rows
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("_before") + F.row_number().over(inside) - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
