"""Join of documents whose sets of word 5-grams have a Jaccard similarity of 0.75 or
more, by signature trees, and the groups that the links form.

1. One pass hashes every document's set; equal sets share an id, so copies cost
   nothing further.  The same pass notes shingles that are frequent within a task.
2. A set that links with another shares three quarters of its shingles or more.  So of
   any n - ceil(0.75 n) + l of them at least l stand in some other set; a second pass
   deals those shingles out, packed, with l = 1 + n / 20, and sets below that are done.
   This drops nearly all that only have a passage in common, and no set with a link.
3. The sets that remain are fetched once.  Two that link share one of the first
   n - ceil(0.75 n) + 1 shingles of either, in any fixed order; frequent shingles come
   last, so that common passages seldom bring sets together.  Sets that meet form
   candidate clusters, unless sketches of 64 minima agree in fewer than ``AGREE``
   places, which a pair at the threshold does with a probability below 1e-17.
4. Within a cluster a signature tree is built: nodes hold OR-combined bitmaps of the
   shingles, the range of set sizes and the most bits lost to collisions.  Two nodes
   are taken further only if the overlap that their bitmaps allow reaches what their
   sizes need, and if they are not one group already; single pairs are checked on
   the shingles themselves.  A cluster of more than ``CLUSTER_SETS`` sets is cut into
   parts and each pair of parts is a group of its own, so no link is lost.
5. Links, and what they connect, by large and small stars.

Which shingles count as frequent changes the work only, never the links.  Equality of
sets and shingles is that of 64-bit hashes.

Edge cases: a null, empty or wordless text has no shingle and is linked with nothing;
one to four words are one shingle; rows equal in doc_id and text are alike; a group
whose ids are all null has a null component_id."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, field, stored, with_row_key
from .graph import components
from .hashing import join_texts, mix, prefix_sums, range_hashes, window_hashes, word_bounds

WORDS = 5
NUM, DEN = 3, 4           # the least similarity, 3/4
NOTE_AFTER = 1 << 21      # shingles between two notes of frequent ones
NOTE_FROM = 4             # sets among those that hold a frequent shingle
FREQUENT = 100_000        # shingles in the list of frequent ones, at most
VERY_FREQUENT = 4096      # sets from which a shingle's sets are not gathered in one place
PACK = 1 << 19            # shingles that a task packs before it deals them out
MORE = 20                 # 1 / MORE of a set's shingles are dealt beyond the least number
BINS = 64                 # minima in a sketch, four bits of each
AGREE = 18                # places that sketches of linked sets agree in
TOGETHER = 1024           # sets with a shingle in common that are held against each other
CLUSTER_SETS = 2048
CLUSTER_SHINGLES = 1 << 22
FEW = 1 << 18             # rows that are broadcast, at most; the driver takes some 200 bytes for each
BITS = 4096
LEAF = 16


def shingle_sets(texts: list) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass").lower() for t in texts]
    buf, start, end = join_texts(raw)
    ws, we = word_bounds(buf)
    words = range_hashes(prefix_sums(buf), ws, we)
    first, last = np.searchsorted(ws, start), np.searchsorted(ws, end)
    windows = window_hashes(words, WORDS)
    out = []
    for a, b in zip(first, last, strict=True):
        if b - a >= WORDS:
            out.append(np.unique(windows[a:b - WORDS + 1]))
        elif b > a:
            out.append(mix(window_hashes(words[a:b], int(b - a)) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _set_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches with the sets of their last column."""
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            part = whole.slice(at, SLICE_ROWS)
            yield part, shingle_sets(part.column(part.num_columns - 1).to_pylist())


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: a document with its set; kind 1: a frequent shingle and its count."""
    names, seen, kept, size = ["kind", "_k1", "_k2", "doc_id", "n", "id"], set(), [], 0

    def notes() -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(kept), return_counts=True)
        found, n = found[n >= NOTE_FROM].view(np.int64), n[n >= NOTE_FROM]
        none = pa.nulls(len(found), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(np.ones(len(found), np.int32)), none, none, none, pa.array(n.astype(np.int64)), pa.array(found)], names=names)

    for part, sets in _texts(batches):
        ids = [_set_id(s) for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(ids), np.int32)), part.column(0), part.column(1), part.column(2),
                                          pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.int64())], names=names)
        for i, s in zip(ids, sets, strict=True):
            if i not in seen:
                seen.add(i)
                kept.append(s)
                size += len(s)
        if size > NOTE_AFTER:
            yield notes()
            seen, kept, size = set(), [], 0
    if kept:
        yield notes()


PACKED = "bucket bigint, shingles binary, ids binary, sketches binary, very boolean"
NAMES = ["bucket", "shingles", "ids", "sketches", "very"]


def _level_of(s: np.ndarray, frequent: np.ndarray, level: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(s), np.int64)
    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
    return np.where(frequent[at] == s, level[at], 0)


def _first(s: np.ndarray, n: int, rank: np.ndarray) -> np.ndarray:
    """Places of the first n shingles: infrequent ones first, then by hash."""
    return np.lexsort((s, rank))[:n] if rank.any() else np.arange(n)


def _pack(to: np.ndarray, shingles: np.ndarray, ids: np.ndarray, sketches: np.ndarray | None, very: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(to, kind="stable")
    to, shingles, ids = to[order], shingles[order], ids[order]
    cut = np.flatnonzero(np.diff(to, prepend=to[0] - 1)) if len(to) else np.zeros(0, np.int64)
    spans = list(zip(cut.tolist(), [*cut[1:].tolist(), len(to)]))
    sk = None if sketches is None else sketches[order]
    return pa.RecordBatch.from_arrays(
        [pa.array([int(to[a]) for a, _ in spans], pa.int64()), pa.array([shingles[a:b].tobytes() for a, b in spans], pa.binary()),
         pa.array([ids[a:b].tobytes() for a, b in spans], pa.binary()),
         pa.array([None if sk is None else sk[a:b].tobytes() for a, b in spans], pa.binary()),
         pa.array([bool(very[order[a]]) for a, _ in spans], pa.bool_())], names=NAMES)


def _sharing(frequent: np.ndarray, level: np.ndarray, buckets: int):
    """Deals out enough shingles of each set to tell how many others hold.  Frequent ones
    are known to be shared: buckets below 0 have their sets, once for each."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            t, i = np.concatenate(shingles), np.concatenate(ids)
            known = _level_of(t, frequent, level) > 0
            h = mix(t)
            to = (h % np.uint64(buckets)).astype(np.int64)
            to = np.where(known, -1 - to, to)
            # Half of the hash will do here: taking two shingles for one only keeps more sets.
            return _pack(to, (h >> np.uint64(32)).astype(np.uint32), i, None, np.zeros(len(t), bool))

        seen, shingles, ids, size = set(), [], [], 0
        for _, sets in _texts(batches):
            for s in sets:
                if not len(s) or (i := _set_id(s)) in seen:
                    continue
                seen.add(i)
                n = min(len(s), len(s) - -(-NUM * len(s) // DEN) + 1 + len(s) // MORE)
                shingles.append(s[:n])
                ids.append(np.full(n, i, np.int64))
                size += n
            if size > PACK:
                yield packed()
                shingles, ids, size = [], [], 0
                if len(seen) > 1_000_000:
                    seen = set()
        if size:
            yield packed()
    return step


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: how many of each set's shingles stand in another set too."""
    if rows["bucket"].iloc[0] < 0:
        u, n = np.unique(np.frombuffer(b"".join(rows["ids"]), np.int64), return_counts=True)
        return pd.DataFrame({"u": u, "n": n})
    shingles = np.frombuffer(b"".join(rows["shingles"]), np.uint32)
    ids = np.frombuffer(b"".join(rows["ids"]), np.int64)
    order = np.lexsort((ids, shingles))
    shingles, ids = shingles[order], ids[order]
    once = np.append(True, (shingles[1:] != shingles[:-1]) | (ids[1:] != ids[:-1]))
    shingles, ids = shingles[once], ids[once]
    same = shingles[1:] == shingles[:-1]
    u, n = np.unique(ids[np.append(same, False) | np.append(False, same)], return_counts=True)
    return pd.DataFrame({"u": u, "n": n})


def _minima(s: np.ndarray) -> np.ndarray:
    """Four bits of the least hash in each of BINS parts of the hash range, packed."""
    h = mix(s ^ np.uint64(0x5851F42D4C957F2D))
    low = np.zeros(BINS, np.uint64)
    order = np.argsort(h)[::-1]
    low[(h[order] >> np.uint64(58)).astype(np.int64)] = h[order]       # the least is written last
    bits = (low & np.uint64(15)).astype(np.uint8)
    return bits[::2] | bits[1::2] << 4


def _dealing(frequent: np.ndarray, level: np.ndarray, buckets: int):
    """Deals out the shingles that linked sets must share, with the sets' sketches."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, SLICE_ROWS):
                part = b.slice(at, SLICE_ROWS)
                shingles, ids, sketches, very = [], [], [], []
                for i, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    s = np.frombuffer(raw, np.uint64)
                    rank = _level_of(s, frequent, level)
                    at_ = _first(s, len(s) - -(-NUM * len(s) // DEN) + 1, rank)
                    shingles.append(s[at_])
                    very.append(rank[at_] >= VERY_FREQUENT)
                    ids.append(np.full(len(at_), i, np.int64))
                    sketches.append(np.tile(_minima(s), (len(at_), 1)))
                if ids:
                    t, i, hot = np.concatenate(shingles), np.concatenate(ids), np.concatenate(very)
                    to = np.where(hot, buckets + i % buckets, (mix(t) % np.uint64(buckets)).astype(np.int64))
                    yield _pack(to, t, i, np.concatenate(sketches), hot)
    return step


def _roots(n: int, links: list[tuple[int, int]]) -> np.ndarray:
    """Union by least number: each one's root."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return np.array([find(x) for x in range(n)], np.int64)


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """Which sets of a bucket hold a shingle in common and have sketches that allow a
    link: each but the first of what comes together, with that first one.  Of a part of a
    very frequent shingle's sets only the pairs of shingle and set."""
    if rows["very"].iloc[0]:
        return _first_of(rows)
    shingles = np.frombuffer(b"".join(rows["shingles"]), np.uint64)
    ids = np.frombuffer(b"".join(rows["ids"]), np.int64)
    sketches = np.frombuffer(b"".join(rows["sketches"]), np.uint8).reshape(-1, BINS // 2)
    order = np.lexsort((ids, shingles))
    shingles, ids, sketches = shingles[order], ids[order], sketches[order]
    opens = np.flatnonzero(np.append(True, shingles[1:] != shingles[:-1]))
    size = np.diff(opens, append=len(ids))
    nodes, back = np.unique(ids, return_inverse=True)

    def agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = sketches[a] ^ sketches[b]
        return ((x & 15) == 0).sum(axis=-1) + ((x >> 4) == 0).sum(axis=-1) >= AGREE

    pairs = opens[size == 2]
    pairs = pairs[agree(pairs, pairs + 1)]
    links, done = list(zip(back[pairs].tolist(), back[pairs + 1].tolist())), set()
    for a, n in zip(opens[size > 2].tolist(), size[size > 2].tolist()):
        members = back[a:a + n]
        if (key := members.tobytes()) in done:
            continue
        done.add(key)
        if n > TOGETHER:
            links += [(int(m), int(members[0])) for m in members[1:]]
            continue
        for k in range(n - 1):
            ok = agree(np.array([a + k]), np.arange(a + k + 1, a + n))
            links += [(int(members[k]), int(m)) for m in members[k + 1:][ok]]
    root = _roots(len(nodes), links)
    other = root != np.arange(len(nodes))
    return pd.DataFrame({"u": nodes[other], "v": nodes[root[other]], "shingle": pd.array([None] * int(other.sum()), "Int64")})


def _first_of(rows: pd.DataFrame) -> pd.DataFrame:
    """Of very frequent shingles: the distinct pairs of shingle and set in a part of the sets."""
    pair = np.unique(np.stack([np.frombuffer(b"".join(rows["shingles"]), np.int64),
                               np.frombuffer(b"".join(rows["ids"]), np.int64)]), axis=1)
    return pd.DataFrame({"u": pair[1], "v": pd.array([None] * len(pair[1]), "Int64"), "shingle": pair[0]})


def _sketch(shingles: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, np.uint8)
    bits[(shingles >> np.uint64(20)).astype(np.int64) % BITS] = 1
    return np.packbits(bits).view(np.uint64)


class _Tree:
    """A signature tree over sets that were sorted by size: leaves of LEAF sets, two
    nodes to a node above."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.size = np.array([len(s) for s in sets], np.int64)
        self.bits = np.stack([_sketch(s) for s in sets])
        self.lost = self.size - np.bitwise_count(self.bits).sum(axis=1).astype(np.int64)
        self.spans: list[tuple[int, int]] = []
        self.kids: list[tuple[int, ...]] = []
        level = []
        for a in range(0, len(sets), LEAF):
            level.append(self._add((a, min(a + LEAF, len(sets))), ()))
        while len(level) > 1:
            level = [self._add((self.spans[p[0]][0], self.spans[p[-1]][1]), tuple(p)) for p in
                     (level[i:i + 2] for i in range(0, len(level), 2))]
        self.top = level[0]
        span = np.array(self.spans)
        self.node_bits = np.stack([np.bitwise_or.reduce(self.bits[a:b]) for a, b in span])
        self.low = np.array([self.size[a:b].min() for a, b in span])
        self.high = np.array([self.size[a:b].max() for a, b in span])
        self.node_lost = np.array([self.lost[a:b].max() for a, b in span])

    def _add(self, span: tuple[int, int], kids: tuple[int, ...]) -> int:
        self.spans.append(span)
        self.kids.append(kids)
        return len(self.spans) - 1


def _links(sets: list[np.ndarray], parts: np.ndarray | None) -> Iterator[tuple[int, int]]:
    """Links that connect all groups of the sets.  ``parts`` (0 or 1 for each set) asks
    for links between the two parts only."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    if parts is None:
        sides = [order, order]
    else:
        sides = [order[parts[order] == 0], order[parts[order] == 1]]
        if not len(sides[0]) or not len(sides[1]):
            return
    x = _Tree([sets[i] for i in sides[0]])
    y = x if parts is None else _Tree([sets[i] for i in sides[1]])
    parent = list(range(len(sets)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    todo = [(x.top, y.top)]
    while todo:
        a, b = todo.pop()
        if NUM * x.low[a] > DEN * y.high[b] or NUM * y.low[b] > DEN * x.high[a]:
            continue
        most = int(np.bitwise_count(x.node_bits[a] & y.node_bits[b]).sum()) + min(x.node_lost[a], y.node_lost[b])
        if (NUM + DEN) * min(most, x.high[a], y.high[b]) < NUM * (x.low[a] + y.low[b]):
            continue
        (a0, a1), (b0, b1) = x.spans[a], y.spans[b]
        kids = x.kids[a] or y.kids[b]
        if not kids or (a1 - a0) * (b1 - b0) <= LEAF * LEAF:
            for i in range(a0, a1):
                js = np.arange(max(b0, i + 1) if x is y else b0, b1)
                if not len(js):
                    continue
                most = np.minimum(np.bitwise_count(y.bits[js] & x.bits[i]).sum(axis=1).astype(np.int64)
                                  + np.minimum(y.lost[js], x.lost[i]), np.minimum(y.size[js], x.size[i]))
                for j in js[(NUM + DEN) * most >= NUM * (y.size[js] + x.size[i])]:
                    p, q = int(sides[0][i]), int(sides[1][j])
                    if find(p) == find(q):
                        continue
                    s, t = x.sets[i], y.sets[j]
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    if DEN * both >= NUM * (len(s) + len(t) - both):
                        parent[max(find(p), find(q))] = min(find(p), find(q))
                        yield p, q
            continue
        if (find(int(sides[0][a0])) == find(int(sides[1][b0]))
                and len({find(int(k)) for k in sides[0][a0:a1]} | {find(int(k)) for k in sides[1][b0:b1]}) == 1):
            continue
        if x is y and a == b:
            todo += [(p, q) for i, p in enumerate(x.kids[a]) for q in x.kids[a][i:]]
        elif x.kids[a] and (not y.kids[b] or a1 - a0 >= b1 - b0):
            todo += [(p, b) for p in x.kids[a]]
        else:
            todo += [(a, q) for q in y.kids[b]]


def _verify(rows: pd.DataFrame) -> pd.DataFrame:
    """Of a whole cluster, each linked set but the least of its group, with that least
    one; of two parts of a cluster, the links between them."""
    out = []
    for (_, a, b), part in rows.groupby(["cluster", "a", "b"], sort=True):
        part = part.sort_values("u")
        ids, whole = part["u"].to_numpy(), int(part["parts"].iloc[0]) == 1
        sets = [np.frombuffer(s, np.uint64) for s in part["shingles"]]
        links = list(_links(sets, None if a == b else (part["part"] == b).to_numpy().astype(int)))
        if whole:
            links = [(p, r) for p, r in enumerate(_roots(len(ids), links)) if p != r]
        out += [(ids[p], ids[q], whole) for p, q in links]
    return pd.DataFrame({"u": np.array([o[0] for o in out], np.int64), "v": np.array([o[1] for o in out], np.int64),
                         "whole": np.array([o[2] for o in out], bool)})


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, sets in _texts(batches):
        yield pa.RecordBatch.from_arrays([pa.array([_set_id(s) for s in sets], pa.int64()),
                                          pa.array([s.tobytes() for s in sets], pa.binary())], names=["u", "shingles"])


def labelled(docs: DataFrame) -> DataFrame:
    """_k1, _k2, doc_id, n_shingles and group of every row: rows with the same non-null
    group are linked, directly or through others.  A row without shingles has a null group."""
    spark = docs.sparkSession
    keyed = with_row_key(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("_k1", "_k2", "doc_id", "text")
    survey = stored(keyed.mapInArrow(_survey, "kind int, _k1 bigint, _k2 bigint, doc_id bigint, n bigint, id bigint"), "survey")
    sets = survey.where("kind = 0").select("_k1", "_k2", "doc_id", "n", "id")
    # Stored first: collecting the limit would bring as many rows of every task to the driver.
    noted = stored(survey.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n"))
                   .orderBy(F.desc("n"), "id").limit(FREQUENT), "frequent").toArrow()     # at most FREQUENT rows
    frequent = noted["id"].to_numpy().view(np.uint64)
    level = noted["n"].to_numpy()
    order = np.argsort(frequent)
    list_ = spark.sparkContext.broadcast((frequent[order], level[order]))

    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = (keyed.select("text").mapInArrow(lambda it: _sharing(*list_.value, buckets)(it), PACKED)
              .groupBy("bucket").applyInPandas(_shared, "u bigint, n bigint").groupBy("u").agg(F.sum("n").alias("_shares")))
    one = stored(sets.where("n > 0").groupBy(F.col("id").alias("u")).agg(F.min(F.struct("_k1", "_k2")).alias("_k"), F.first("n").alias("n"))
                 .join(shares, "u").where(F.col("_shares") > F.floor(F.col("n") / MORE)).select("u", "n", "_k._k1", "_k._k2"), "sharing")
    # Each remaining set once, from one document; the keys are broadcast while they are few.
    # Otherwise rows that are alike become one before the exchange, so that no key is hot.
    wanted, key = one.select("_k1", "_k2"), ["_k1", "_k2"]
    if one.count() <= FEW:
        texts = keyed.join(F.broadcast(wanted), key, "left_semi").dropDuplicates(key)
    else:
        texts = keyed.dropDuplicates(key).join(wanted.hint("merge"), key, "left_semi")
    kept = stored(texts.select("text").mapInArrow(_sets_of, "u bigint, shingles binary"), "sets")

    met = stored(kept.mapInArrow(lambda it: _dealing(*list_.value, buckets)(it), PACKED)
                 .groupBy("bucket").applyInPandas(_meet, "u bigint, v bigint, shingle bigint"), "met")
    very = met.where(F.col("v").isNull())
    first = very.groupBy("shingle").agg(F.min("u").alias("_least"))
    met = met.where(F.col("v").isNotNull()).select("u", "v").unionAll(
        very.join(first, "shingle").select("u", F.col("_least").alias("v")))
    clusters = components(met)
    members = clusters.select("u", F.col("v").alias("cluster")).unionAll(
        clusters.select(F.col("v").alias("u"), F.col("v").alias("cluster")).distinct())
    one = stored(members.join(one.select("u", "n"), "u"), "members")
    size = one.groupBy("cluster").agg(F.count(F.lit(1)).alias("_m"), F.sum("n").alias("_n")).select(
        "cluster", F.greatest(F.ceil(F.col("_m") / CLUSTER_SETS), F.ceil(F.col("_n") / CLUSTER_SHINGLES)).cast("int").alias("parts"))
    size = stored(size, "clusters")
    placed = stored(one.select("u", "cluster").join(size, "cluster").select("u", "cluster", "parts"), "placed")
    # One row a set, broadcast while they are few: then only those sets are exchanged.  Pairs of
    # parts are made after the join; their number may grow faster than that of the sets.
    placed = F.broadcast(placed) if placed.count() <= FEW else placed.hint("merge")
    part = F.pmod(F.xxhash64("u"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    tasks = (kept.join(placed, "u").withColumn("part", part).withColumn("_other", other)
             .withColumns({"a": F.least("part", "_other"), "b": F.greatest("part", "_other")})
             .withColumn("task", F.when(F.col("parts") == 1, F.pmod(F.xxhash64("cluster"), F.lit(buckets)))
                         .otherwise(F.xxhash64("cluster", "a", "b"))))
    links = stored(tasks.select("task", "cluster", "parts", "a", "b", "part", "u", "shingles")
                   .groupBy("task").applyInPandas(_verify, "u bigint, v bigint, whole boolean"), "links")
    groups = links.where("whole").select(F.col("u").alias("id"), F.col("v").alias("_root"))
    cut = links.where("not whole").select("u", "v")
    if not cut.isEmpty():                # clusters that were cut into parts
        groups = groups.unionAll(components(cut).select("u", "v"))
    # Both sides are read from storage, so a set that a third of all rows share can be split.
    return (sets.join(groups, "id", "left")
            .select("_k1", "_k2", "doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.coalesce("_root", "id")).alias("group")))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    rows = stored(labelled(docs).select("doc_id", "n_shingles", "group"), "groups")
    least = stored(rows.where(F.col("group").isNotNull()).groupBy("group").agg(F.min("doc_id").alias("_least")), "least")
    return (rows.join(least, "group", "left")
            .select("doc_id", "n_shingles", F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("_least")).alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group (that of the smallest doc_id, null last) and
    every row without shingles; rows equal in doc_id and text count once."""
    rows = stored(labelled(docs).select("_k1", "_k2", "doc_id", "group"), "groups")
    by = F.struct(F.col("doc_id").isNull(), "doc_id", "_k1", "_k2")
    chosen = (rows.where(F.col("group").isNotNull()).groupBy("group").agg(F.min(by).alias("_k")).select("_k._k1", "_k._k2")
              .unionAll(rows.where(F.col("group").isNull()).select("_k1", "_k2"))).distinct()
    whole = F.struct(*map(field, docs.columns)).alias("_row")       # whatever the columns' names
    keyed = with_row_key(docs.select("doc_id", "text", whole)).select("_k1", "_k2", "_row")
    return (keyed.join(stored(chosen, "chosen"), ["_k1", "_k2"], "left_semi")
            .dropDuplicates(["_k1", "_k2"]).select("_row.*"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM d),
e AS (SELECT doc_id, hash(s1) AS h FROM (SELECT doc_id, unnest(s) AS s1 FROM g)),
f AS (SELECT h FROM e GROUP BY h HAVING count(*) > 1),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM e a JOIN f USING (h) JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN g a ON a.doc_id = x JOIN g b ON b.doc_id = y WHERE 100 * n >= 75 * (len(a.s) + len(b.s) - n)),
r AS (SELECT doc_id AS x, doc_id AS c FROM g UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.x WHERE r.c < l.y)
SELECT g.doc_id, len(s)::BIGINT AS n_shingles, min(r.c) AS component_id FROM g JOIN r ON r.x = g.doc_id GROUP BY 1, 2
"""
