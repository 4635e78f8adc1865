"""Removal of repeated byte strings of ``LENGTH`` bytes or more.

A suffix array of the whole corpus would not fit any machine, so windows of LENGTH
bytes that can be equal are first brought together:

1. One pass takes, for every window, the least hash of its GRAM-byte strings.  A run
   of windows with the same least hash is a *context*; equal windows have equal least
   hashes, so contexts with different ones need not meet.  Contexts are noted by the
   hashes of their anchor and of their bytes, packed, and dealt out by anchor.  A
   context with the same bytes as an earlier one is covered throughout; that settles
   all but the edges of repeats.
2. Contexts whose anchor stands in several different contexts (or twice in one) are cut
   from their documents and dealt out by anchor.
3. Over each batch of them a Burrows-Wheeler transform is built.  Common prefixes are
   derived by increasing value, breadth first: the interval of a string is extended
   backward by every character, and the right border of each new interval that has none
   yet gets the present value.  At LENGTH the expansion stops; suffixes without a border
   between them share LENGTH bytes, and all but the first of them are covered.

Copies and passages that a third of all documents share reach the later steps once for
each packed part of a task.  An anchor with very many different contexts is dealt out by
the single windows instead, as hashes: a task settles all but the first place of each
window in a pack itself, so that no group grows with the copies.

Documents are ordered by doc_id, null last, and rows of one id by a hash of their text;
rows equal in doc_id and text are one document and treated alike.  A null or empty text
has no bytes.  Equality of contexts is that of 64-bit hashes; of windows of a split anchor,
that of their own and 32 bits of the anchor's."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, stored, with_row_key
from .hashing import mix, prefix_sums, range_hashes

LENGTH = 100
GRAM = 24
SEGMENT = 1 << 20        # windows of a long text that are hashed together
LONGEST_RUN = 4096       # windows to a context; longer runs are cut
PACK = 1 << 20           # contexts that a task packs before it deals them out
MANY = 1024              # different contexts of an anchor in a pack, from which it is split
SPLIT = 2048             # the same over all packs
BATCH = 1 << 21          # bytes that are sorted together
LAST_ID = (1 << 63) - 1

NOTE = np.dtype([("h", "<u4"), ("c", "<u8"), ("doc", "<i8"), ("t", "<i8"), ("a", "<u4"), ("n", "<u2"), ("twice", "u1"), ("only", "u1")])
COVER = np.dtype([("doc", "<i8"), ("t", "<i8"), ("a", "<u4"), ("n", "<u2")])
WINDOW = np.dtype([("h", "<u4"), ("w", "<u8"), ("doc", "<i8"), ("t", "<i8"), ("a", "<u4")])


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of every ``width`` consecutive values."""
    have = 1
    while 2 * have <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


def contexts(raw: bytes) -> tuple[np.ndarray, ...]:
    """(anchor, hash, first window, windows, whether the anchor stands twice) of a text's
    contexts, which hold each of its windows once."""
    parts = []
    grams = LENGTH - GRAM + 1
    for at in range(0, len(raw) - LENGTH + 1, SEGMENT):
        buf = np.frombuffer(raw, np.uint8)[at:at + SEGMENT + LENGTH - 1]
        sums = prefix_sums(buf)
        start = np.arange(len(buf) - GRAM + 1)
        g = range_hashes(sums, start, start + GRAM)
        low = _slide(g, grams, np.minimum)
        a = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
        value = low[a]
        edge = np.zeros(grams - 1, np.uint64)
        held = np.flatnonzero(g == _slide(np.concatenate((edge, low, edge)), grams, np.maximum))
        first = np.concatenate(([0], np.flatnonzero(np.diff(g[held])) + 1))
        twice = np.diff(first, append=len(held)) > 1 if len(first) == len(a) else np.ones(len(a), bool)
        n = np.diff(a, append=len(low))
        if n.max() > LONGEST_RUN:
            pieces = -(-n // LONGEST_RUN)
            k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            value, twice, whole, a = (np.repeat(x, pieces) for x in (value, twice, n, a))
            a = a + k * LONGEST_RUN
            n = np.minimum(LONGEST_RUN, whole - k * LONGEST_RUN)
        parts.append((mix(value), range_hashes(sums, a, a + n + LENGTH - 1), a + at, n, twice | (n > grams)))
    return tuple(map(np.concatenate, zip(*parts))) if parts else (np.zeros(0, np.uint64),) * 5


def _batch(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                                      names=["bucket", "packed"])


def _later(notes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first note of each context, and the others; notes of one place count once."""
    notes = notes[np.lexsort((notes["a"], notes["t"], notes["doc"], notes["c"]))]
    if len(notes):
        notes = notes[np.append(True, np.any([notes[k][1:] != notes[k][:-1] for k in ("c", "doc", "t", "a")], axis=0))]
    again = np.append(False, notes["c"][1:] == notes["c"][:-1]) if len(notes) else np.zeros(0, bool)
    return notes[~again], notes[again]


def _cover(notes: np.ndarray) -> bytes:
    out = np.empty(len(notes), COVER)
    for name in COVER.names:
        out[name] = notes[name]
    return out.tobytes()


def _noting(buckets: int):
    """Packed notes of all contexts by bucket; buckets below 0: what is covered already."""
    def deal(notes: np.ndarray, anchors: np.ndarray) -> pa.RecordBatch:
        notes["h"] = (anchors >> np.uint64(32)).astype(np.uint32)
        to = (anchors % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((notes["a"], notes["t"], notes["doc"], notes["c"]))
        notes, anchors, to = notes[order], anchors[order], to[order]
        once = np.append(True, np.any([notes[k][1:] != notes[k][:-1] for k in ("c", "doc", "t", "a")], axis=0))
        notes, anchors, to = notes[once], anchors[once], to[once]      # rows of one document count once
        again = np.append(False, notes["c"][1:] == notes["c"][:-1])
        rows = [(-1 - int(notes["c"][0] % np.uint64(buckets)), _cover(notes[again]))] if again.any() else []
        notes, anchors, to = notes[~again], anchors[~again], to[~again]
        _, at, back, many = np.unique(anchors, return_index=True, return_inverse=True, return_counts=True)
        split = many[back] >= MANY
        if split.any():     # the anchor's own bucket gets one mark, the contexts are dealt by their hashes
            mark = notes[at[many >= MANY]].copy()
            mark["c"], mark["n"] = 0, 0
            mark_to = to[at[many >= MANY]]
            notes["only"][split] = 1
            to[split] = buckets + (notes["c"][split] % np.uint64(buckets)).astype(np.int64)
            notes, to = np.concatenate([notes, mark]), np.concatenate([to, mark_to])
        order = np.argsort(to, kind="stable")
        notes, to = notes[order], to[order]
        cut = np.flatnonzero(np.diff(to, prepend=-1))
        rows += [(int(to[a]), notes[a:b].tobytes()) for a, b in zip(cut, [*cut[1:], len(to)])]
        return _batch(rows)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, anchors, size = [], [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                part = whole.slice(at, SLICE_ROWS)
                for doc, t, raw in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    if raw is None or len(raw) < LENGTH:
                        continue
                    h, c, a, n, twice = contexts(raw)
                    note = np.zeros(len(h), NOTE)
                    note["c"], note["doc"], note["t"], note["a"], note["n"], note["twice"] = c, doc, t, a, n, twice
                    kept.append(note)
                    anchors.append(h)
                    size += len(h)
                if size > PACK:
                    yield deal(np.concatenate(kept), np.concatenate(anchors))
                    kept, anchors, size = [], [], 0
        if size:
            yield deal(np.concatenate(kept), np.concatenate(anchors))
    return step


def _sort_out(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: what is covered (edge 0), and the first of each context that must be
    looked into (1; 2 where its anchor is split)."""
    if rows["bucket"].iloc[0] < 0:
        notes = np.frombuffer(b"".join(rows["packed"]), COVER)
        return pd.DataFrame({**{k: notes[k].astype(np.int64) for k in COVER.names}, "h": 0, "edge": 0})
    notes = np.frombuffer(b"".join(rows["packed"]), NOTE)
    marked = np.unique(notes["h"][notes["n"] == 0])
    first, again = _later(notes[notes["n"] > 0])
    _, back, many = np.unique(first["h"], return_inverse=True, return_counts=True)
    split = (first["only"] > 0) | np.isin(first["h"], marked) | (many[back] > SPLIT)
    edge = (many[back] > 1) | (first["twice"] > 0) | split
    out = []
    for part, kind in ((again, np.zeros(len(again), np.int32)), (first[edge], 1 + split[edge].astype(np.int32))):
        out.append(pd.DataFrame({"doc": part["doc"].astype(np.int64), "t": part["t"].astype(np.int64), "a": part["a"].astype(np.int64),
                                 "n": part["n"].astype(np.int64), "h": part["h"].astype(np.int64), "edge": kind}))
    return pd.concat(out)


def _later_windows(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each window, and the others in the order of their places."""
    windows = windows[np.lexsort((windows["a"], windows["t"], windows["doc"], windows["w"], windows["h"]))]
    if len(windows):
        windows = windows[np.append(True, windows[1:] != windows[:-1])]     # one place counts once
    again = np.append(False, np.all([windows[k][1:] == windows[k][:-1] for k in ("h", "w")], axis=0)) if len(windows) else np.zeros(0, bool)
    later = windows[again]
    return windows[~again], later[np.lexsort((later["a"], later["t"], later["doc"]))]


def _window_runs(later: np.ndarray) -> np.ndarray:
    """Ordered windows as runs of consecutive ones, no longer than a cover can hold."""
    follows = np.append(False, (later["doc"][1:] == later["doc"][:-1]) & (later["t"][1:] == later["t"][:-1])
                        & (later["a"][1:].astype(np.int64) - later["a"][:-1] == 1))
    opens = np.flatnonzero(~follows)
    at = np.arange(len(later)) - np.repeat(opens, np.diff(opens, append=len(later)))
    opens = np.flatnonzero(at % LONGEST_RUN == 0)
    out = np.zeros(len(opens), COVER)
    for name in ("doc", "t", "a"):
        out[name] = later[name][opens]
    out["n"] = np.diff(opens, append=len(later))
    return out


def _deal_windows(windows: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The first place of each window by the bucket of its hash, packed; buckets below 0:
    what is covered already."""
    first, later = _later_windows(windows)
    rows = [(-1 - int(later["w"][0] % np.uint64(buckets)), _window_runs(later).tobytes())] if len(later) else []
    to = buckets + (first["w"] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    first, to = first[order], to[order]
    cut = np.flatnonzero(np.diff(to, prepend=-1))
    rows += [(int(to[a]), first[a:b].tobytes()) for a, b in zip(cut, [*cut[1:], len(to)])]
    none = pa.array([0] * len(rows), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), none, none, none, none,
                                       pa.array([r[1] for r in rows], pa.binary())], names=CUT)


CUT = ["bucket", "h", "doc", "t", "a", "raw"]


def _cutting(buckets: int):
    """The bytes of the contexts that must be looked into; of those of a split anchor the
    hashes of their windows, packed."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                out = []
                part = whole.slice(at, SLICE_ROWS)
                for doc, t, raw, edges in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                    sums = prefix_sums(np.frombuffer(raw, np.uint8)) if any(e["edge"] == 2 for e in edges) else None
                    for e in edges:
                        a, n = e["a"], e["n"]
                        if e["edge"] == 1:
                            out.append((e["h"] % buckets, e["h"], doc, t, a, raw[a:a + n + LENGTH - 1]))
                        else:
                            s = np.arange(a, a + n)
                            windows = np.zeros(n, WINDOW)
                            windows["h"], windows["w"], windows["doc"], windows["t"], windows["a"] = e["h"], range_hashes(sums, s, s + LENGTH), doc, t, s
                            kept.append(windows)
                            size += n
                    if size > PACK:
                        yield _deal_windows(np.concatenate(kept), buckets)
                        kept, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*out))[:5]]
                                                     + [pa.array([r[5] for r in out], pa.binary())], names=CUT)
        if size:
            yield _deal_windows(np.concatenate(kept), buckets)
    return step


def suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` symbols at least."""
    n = len(text)
    key = np.zeros(n, np.uint64)
    for k in range(7):                        # seven symbols of nine bits
        key = key << np.uint64(9)
        key[:n - k] |= text[k:].astype(np.uint64)
    have = 7
    while True:
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(1, np.diff(key[order]) != 0))
        if have >= depth or rank[order[-1]] == n:
            return order
        key = (rank * (n + 1)).astype(np.uint64)
        key[:max(0, n - have)] += rank[have:].astype(np.uint64)
        have *= 2


def shared_prefixes(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix in ``order`` begins a group of suffixes that share ``length``
    symbols (symbol 0 stands between texts and is never part of a string)."""
    n = len(text)
    before = text[order - 1]                  # the Burrows-Wheeler transform
    back = np.empty(n, np.int64)              # where the suffix that starts one earlier stands
    back[np.argsort(before, kind="stable")] = np.arange(n)
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for value in range(1, length + 1):
        size = high - low
        which = np.repeat(np.arange(len(low)), size)
        at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]
        use = before[at] != 0
        at, which = at[use], which[use]
        if not len(at):
            break
        to = np.argsort(back[at], kind="stable")
        spot, which, symbol = back[at][to], which[to], before[at][to]
        opens = np.append(True, (which[1:] != which[:-1]) | (symbol[1:] != symbol[:-1]))
        low = spot[opens]
        high = spot[np.append(np.flatnonzero(opens)[1:] - 1, len(spot) - 1)] + 1
        new = ~border[high]
        if value == 1:
            new[:] = True                     # the last symbol's interval ends where all do
        border[high] = True
        low, high = low[new], high[new]
    return border[:n]


def _covered_windows(parts: list[bytes]) -> np.ndarray:
    """Positions, in the concatenation of the parts with a symbol 0 after each, of the
    windows that also start earlier."""
    size = np.array([len(p) for p in parts])
    text = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.uint16) + 1
    end = np.cumsum(size + 1) - 1
    text[end] = 0
    order = suffixes(text, LENGTH + 1)
    group = np.flatnonzero(shared_prefixes(text, order, LENGTH))
    left = np.repeat(end, size + 1) - np.arange(len(text))
    whole = left[order] >= LENGTH
    first = np.minimum.reduceat(np.where(whole, order, len(text)), group)
    member = np.zeros(len(text), np.int64)
    member[group[1:]] = 1
    return np.sort(order[whole & (order != first[np.cumsum(member)])])


def _expand(rows: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """The covered windows of one bucket's contexts or packed windows, as runs."""
    bucket = rows["bucket"].iloc[0]
    if bucket < 0 or bucket >= buckets:
        packed = b"".join(rows["raw"])
        runs = np.frombuffer(packed, COVER) if bucket < 0 else _window_runs(_later_windows(np.frombuffer(packed, WINDOW))[1])
        return pd.DataFrame({k: runs[k].astype(np.int64) for k in COVER.names})
    rows = rows.sort_values("h", kind="stable")
    size = rows["raw"].str.len().to_numpy()
    h = rows["h"].to_numpy()
    batch = np.maximum.accumulate(np.where(np.append(True, h[1:] != h[:-1]), np.cumsum(size) // BATCH, 0))
    out = []
    for _, part in rows.groupby(batch):
        part = part.sort_values(["doc", "t", "a"])          # so that earlier means a smaller position
        size = part["raw"].str.len().to_numpy()
        start = np.cumsum(size + 1) - size - 1
        at = _covered_windows(part["raw"].tolist())
        if not len(at):
            continue
        own = np.searchsorted(start, at, "right") - 1
        a = at - start[own] + part["a"].to_numpy()[own]
        opens = np.flatnonzero(np.append(True, (np.diff(a) != 1) | (np.diff(own) != 0)))
        out.append(pd.DataFrame({"doc": part["doc"].to_numpy()[own[opens]], "t": part["t"].to_numpy()[own[opens]],
                                 "a": a[opens], "n": np.diff(opens, append=len(a))}))
    return pd.concat(out) if out else pd.DataFrame({"doc": [], "t": [], "a": [], "n": []}, dtype="int64")


def _runs(a: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the bytes that windows starting at a..a+n-1 cover."""
    order = np.argsort(a, kind="stable")
    start, end = a[order], np.maximum.accumulate((a + n + LENGTH - 1)[order])
    opens = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    return start[opens], end[np.append(opens[1:] - 1, len(end) - 1)]


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            part = whole.slice(at, SLICE_ROWS)
            out = []
            for raw, a, n in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                raw = raw or b""
                if not a:
                    out.append((raw, len(raw), 0, 0))
                    continue
                start, end = _runs(np.array(a, np.int64), np.array(n, np.int64))
                edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(raw)]
                out.append((b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])), len(raw), int((end - start).sum()), len(start)))
            kept, n_bytes, removed, spans = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (n_bytes, removed, spans))], names=names)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, kept (the remaining bytes), n_bytes, n_removed and n_spans of every row."""
    spark = docs.sparkSession
    buckets = max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = with_row_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), F.col("_k2").alias("t"),
        F.col("text").cast("binary").alias("raw"))
    noted = keyed.select("doc", "t", "raw").mapInArrow(_noting(buckets), "bucket bigint, packed binary")
    sorted_ = stored(noted.groupBy("bucket").applyInPandas(
        _sort_out, "doc bigint, t bigint, a bigint, n bigint, h bigint, edge int"), "contexts")
    edges = (sorted_.where("edge > 0").distinct().groupBy("doc", "t")
             .agg(F.collect_list(F.struct("h", "a", "n", "edge")).alias("edges")))
    cut = (keyed.select("doc", "t", "raw").join(edges, ["doc", "t"]).dropDuplicates(["doc", "t"])
           .select("doc", "t", "raw", "edges")
           .mapInArrow(_cutting(buckets), "bucket bigint, h bigint, doc bigint, t bigint, a bigint, raw binary"))
    found = stored(cut.groupBy("bucket").applyInPandas(lambda rows: _expand(rows, buckets), "doc bigint, t bigint, a bigint, n bigint"), "windows")
    spans = (sorted_.where("edge = 0").select("doc", "t", "a", "n").unionAll(found)
             .groupBy("doc", "t").agg(F.collect_list("a").alias("a"), F.collect_list("n").alias("n")))
    return (keyed.join(spans, ["doc", "t"], "left").select("doc_id", "raw", "a", "n")
            .mapInArrow(_cut_out, "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"))


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
