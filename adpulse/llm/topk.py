"""Exact top-k search by inner product with dual cover trees.

Vectors become integers, floor(64 x) for each component.  A few pivots, drawn from a
bounded sample, split the rows into cells; each cell is cut into blocks of about
``BLOCK`` rows (a cell of equal vectors as well).  The search has two passes:

1. Each query meets the first block of its own cell, which gives a floor for its kth
   score.  Pairs of cells whose covering radii cannot reach the worst floor of the
   cell's queries are dropped.
2. Each block and each chunk of queries routed to it are indexed together: a cover tree
   over either, whose nodes know their centre and covering radius; radii halve from level
   to level, and a node that cannot be covered so by ``KIDS`` others is a leaf.  A pair of nodes is pruned when  <p,q> + r_p |q| + r_q |p| + r_p r_q  is
   less than the worst kth score among the node's queries; leaves are multiplied out in
   one matrix product.

The best of each block are merged by a window.  Results are exact whatever the sample:
it only sets the order of the work.

Edge cases: rows with a null vec_id, or a vector that is null or holds a null or
non-finite component, take no part; rows equal in id and vector count once; vectors of
different lengths meet in the components that both have; ties go to the smaller vec_id;
a query with fewer than k candidates returns them all.  Scores must fit 64 bits."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

TOP = 20
EVERY = 20               # queries: ids divisible by this
BLOCK = 4096
CHUNK = 2048             # queries
MOST_PIVOTS = 64
LEAF = 512               # rows that are multiplied out without looking further
KIDS = 24                # of a node; one that needs more is a leaf


def integer_vectors(vectors: DataFrame, scale: int = 64) -> DataFrame:
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad)
            .select("vec_id", F.transform("embedding", lambda x: F.floor(x * scale).cast("long")).alias("v"))
            .dropDuplicates(["vec_id", "v"]))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = (x * x).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(axis=1)
    at = np.argmin(d, axis=1)
    return at, np.sqrt(np.maximum(((x - centres[at]) ** 2).sum(axis=1), 0))


class _CoverTree:
    """Nodes (a row as centre, covering radius, kids or a leaf's rows) over the rows of a
    matrix.  Kids' centres are rows of the node, each farther than half the node's radius from
    those before, until every row is within half the radius of one; so radii halve from level
    to level.  A node that would need more than ``KIDS`` of them has no such shape to use and
    stays a leaf, as do nodes of up to ``LEAF`` rows: leaves are multiplied out as a whole."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.norm: list[float] = []
        self.kids: list[list[int]] = []
        self.rows: list[np.ndarray] = []
        if len(x):
            middle = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
            self._node(np.arange(len(x)), middle)

    def _node(self, rows: np.ndarray, centre: int) -> int:
        me, gap = len(self.centre), np.sqrt(((self.x[rows] - self.x[centre]) ** 2).sum(axis=1))
        self.centre.append(self.x[centre])
        self.radius.append(float(gap.max()))
        self.norm.append(float(np.sqrt((self.x[centre] ** 2).sum())))
        self.kids.append([])
        self.rows.append(rows)
        half = self.radius[me] / 2
        if len(rows) > LEAF and half > 0:
            pick, owner = [centre], np.zeros(len(rows), np.int64)
            while gap.max() > half and len(pick) < KIDS:
                pick.append(int(rows[np.argmax(gap)]))
                d = np.sqrt(((self.x[rows] - self.x[pick[-1]]) ** 2).sum(axis=1))
                owner[d < gap] = len(pick) - 1
                gap = np.minimum(gap, d)
            if gap.max() <= half:
                self.kids[me] = [self._node(rows[owner == k], c) for k, c in enumerate(pick) if (owner == k).any()]
        return me


_NONE = np.iinfo(np.int64)


def _merge(best: np.ndarray, who: np.ndarray, worst: np.ndarray, q: np.ndarray, ids: np.ndarray, query_ids: np.ndarray,
           score: np.ndarray, k: int) -> None:
    """Takes the scores of rows ``ids`` for queries ``q`` into the best ``k`` of each."""
    least = worst[q].astype(score.dtype)
    many = np.flatnonzero((score >= least[:, None]).sum(axis=1) > 2 * k)
    if len(many):      # one more than k, as the query's own row may be among them
        least[many] = np.maximum(least[many], np.partition(score[many], -(k + 1), axis=1)[:, -(k + 1)])
    row, col = np.nonzero(score >= least[:, None])
    other = ids[col] != query_ids[q[row]]
    row, col = row[other], col[other]
    if not len(row):
        return
    some = np.unique(q[row])
    old = who[some] != _NONE.max
    of = np.concatenate([q[row], np.repeat(some, old.sum(axis=1))])
    value = np.concatenate([score[row, col].astype(np.int64), best[some][old]])
    name = np.concatenate([ids[col], who[some][old]])
    order = np.lexsort((name, -value, of))
    of, value, name = of[order], value[order], name[order]
    place = np.arange(len(of)) - np.searchsorted(of, of)
    top = place < k
    best[some], who[some] = _NONE.min, _NONE.max
    best[of[top], place[top]], who[of[top], place[top]] = value[top], name[top]
    worst[some] = np.maximum(worst[some], best[some, k - 1])


def _search(ids: np.ndarray, data: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray,
            k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vec id, score) of the best k of ``data`` for each query, but for those
    whose score is below the query's floor."""
    safe = float(np.abs(data).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, data.shape[1]) < 2.0 ** 52
    x, y = data.astype(float), queries.astype(float)
    tree, asked = _CoverTree(x), _CoverTree(y)
    best = np.full((len(y), k), _NONE.min, np.int64)
    who = np.full((len(y), k), _NONE.max, np.int64)
    worst = floor.copy()                      # a score below it cannot be among a query's best

    def bound(a: int, b: int) -> float:
        v = (float((asked.centre[a] * tree.centre[b]).sum()) + asked.radius[a] * tree.norm[b]
             + tree.radius[b] * asked.norm[a] + asked.radius[a] * tree.radius[b])
        return v + 1e-6 * (1 + abs(v))

    todo = [(-bound(0, 0), 0, 0)] if len(x) and len(y) else []
    while todo:
        most, a, b = heapq.heappop(todo)
        if -most < worst[asked.rows[a]].min():
            continue
        if not asked.kids[a] and not tree.kids[b]:
            q, d = asked.rows[a], tree.rows[b]
            score = y[q] @ x[d].T if safe else (queries[q].astype(object) @ data[d].astype(object).T).astype(np.int64)
            _merge(best, who, worst, q, ids[d], query_ids, score, k)
            continue
        # The wider of the two nodes is opened.
        if tree.kids[b] and (not asked.kids[a] or tree.radius[b] >= asked.radius[a]):
            pairs = [(a, c) for c in tree.kids[b]]
        else:
            pairs = [(c, b) for c in asked.kids[a]]
        for p, c in pairs:
            v = bound(p, c)
            if v >= worst[asked.rows[p]].min():
                heapq.heappush(todo, (-v, p, c))
    found = (who != _NONE.max) & (best >= floor[:, None])
    return np.repeat(query_ids, k)[found.ravel()], who[found], best[found]


def _searcher(width: int, k: int, kth_only: bool):
    def run(key, data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        q, v, s = _search(data["row_id"].to_numpy(np.int64), _matrix(data["row"], width), asked["vec_id"].to_numpy(np.int64),
                          _matrix(asked["v"], width), asked["floor"].to_numpy(np.int64), k)
        out = pd.DataFrame({"query_id": q, "vec_id": v, "score": s})
        if kth_only:
            size = out.groupby("query_id")["score"].agg(["size", "min"])
            size = size[size["size"] >= k]
            return pd.DataFrame({"query_id": size.index.to_numpy(np.int64), "floor": size["min"].to_numpy(np.int64)})
        return out
    return run


def search(vectors: DataFrame, k: int = TOP, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best rows."""
    spark = vectors.sparkSession
    rows = stored(integer_vectors(vectors), "vectors")
    total, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(width or 0, 1)
    count = max(1, min(MOST_PIVOTS, -(-total // BLOCK)))
    sample = [r.v for r in rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(count).collect()]   # at most MOST_PIVOTS
    pivots = spark.sparkContext.broadcast(_matrix(sample or [[0]], width).astype(float))

    def place(batches):
        for b in batches:
            at, d = _nearest(_matrix(b.column(1).to_pylist(), width).astype(float), pivots.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at.astype(np.int32)), pa.array(d)],
                                             names=["vec_id", "v", "cell", "far"])

    placed = stored(rows.mapInArrow(place, "vec_id bigint, v array<bigint>, cell int, far double"), "cells")
    is_query = F.col("vec_id") % every == 0
    cells = {r.cell: r for r in placed.groupBy("cell").agg(                       # at most MOST_PIVOTS rows
        F.count(F.lit(1)).alias("n"), F.sum(is_query.cast("int")).alias("asked"), F.max("far").alias("far"),
        F.max(F.when(is_query, F.col("far"))).alias("asked_far")).collect()}

    def table(pairs: list[tuple], schema: str) -> DataFrame:
        return F.broadcast(spark.createDataFrame(pairs, schema))

    blocks = table([(c, -(-r.n // BLOCK)) for c, r in cells.items()], "cell int, blocks int")
    data = (placed.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int"))
            .select(F.col("vec_id").alias("row_id"), F.col("v").alias("row"), F.col("cell").alias("row_cell"),
                    F.col("block").alias("row_block")))
    chunks = table([(c, -(-(r.asked or 0) // CHUNK) or 1) for c, r in cells.items()], "cell int, chunks int")
    asked = (placed.where(is_query).join(chunks, "cell")
             .select("vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int").alias("chunk")))
    lowest = F.lit(np.iinfo(np.int64).min + 1)

    # First pass: the own cell's first block, for every chunk of the cell's queries.
    mine = (data.where("row_block = 0").join(chunks.withColumnRenamed("cell", "row_cell"), "row_cell")
            .withColumn("row_chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    floors = stored(mine.groupBy("row_cell", "row_chunk").cogroup(
        asked.withColumn("floor", lowest).groupBy("cell", "chunk")).applyInPandas(
        _searcher(width, k, True), "query_id bigint, floor bigint"), "floors")
    asked = stored(asked.join(floors.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
                   .withColumn("floor", F.coalesce("floor", lowest)), "queries")
    worst = {r.cell: r.floor for r in asked.groupBy("cell").agg(F.min("floor").alias("floor")).collect()}

    # Second pass: cells that can reach the worst floor of a cell's queries.
    p = pivots.value
    norm = np.sqrt((p * p).sum(axis=1))
    routes, runs, size = [], {}, 0
    for a in sorted(worst):                    # neighbouring cells share a run of about CHUNK queries
        runs[a] = size // CHUNK
        size += cells[a].asked
    for a, least in worst.items():
        for b, r in cells.items():
            most = float((p[a] * p[b]).sum()) + cells[a].asked_far * norm[b] + r.far * norm[a] + cells[a].asked_far * r.far
            if most + 1e-6 * (1 + abs(most)) >= least:
                routes.append((a, b, runs[a]))
    route = table(routes or [(-1, -1, 0)], "cell int, to int, run int")          # at most MOST_PIVOTS squared
    sent = (asked.join(route, "cell")
            .withColumn("run", F.concat_ws(":", "run", F.when(F.col("chunk") > 0, F.concat_ws(":", "cell", "chunk")))))
    wanted = sent.select(F.col("to").alias("row_cell"), F.col("run").alias("row_run")).distinct()
    pairs = data.join(wanted, "row_cell")
    sent = (sent.drop("cell").withColumnRenamed("to", "cell").join(blocks, "cell")
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("vec_id", "v", "cell", "block", "run", "floor"))
    found = pairs.groupBy("row_cell", "row_block", "row_run").cogroup(sent.groupBy("cell", "block", "run")).applyInPandas(
        _searcher(width, k, False), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = r"""
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
