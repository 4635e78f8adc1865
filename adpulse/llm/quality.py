"""Quality rules: fixed base rules, and a calibrated logistic regression over
hashed word and character n-grams.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows (a documented bound),
in one task: of each class the rows with the smallest hashes of doc_id, so the
choice does not depend on file order.  Each class has its share of them, but a rare
one up to a tenth of all, so that it is learned at every size.  Everything else - counts, rules, scores - covers every
row and every whole text, in one map-only pass over Arrow batches.

Weights are rounded to integers before scoring, so a text's score is an exact sum
and does not depend on what else is in its batch.

Edge cases: a null or empty text has no words and fails the base rules; without
labels of both classes there is no model and the base rules alone decide;
repeated rows are judged alike, each on its own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_ROWS, columns, drawn_by_group, map_texts
from .hashing import IS_WORD_BYTE, join_texts, mix, window_hashes, word_bounds, range_hashes, prefix_sums

TRAIN_ROWS = 3000
RARE_SHARE = 0.1        # of the training rows, that a class may always have
HOLD_OUT = 5            # every fifth training row fits the calibration instead
BITS = 16
STEPS = 120
SCALE = 100.0           # of a text's mean weight
UNIT = 2.0 ** 20        # integer weights count this many to one
KEEP_AT = 0.3           # least calibrated probability of good quality
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
SLICE_BYTES = 1 << 18   # of text, or one document, that the arrays of a step are made for

BASE_SCHEMA = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def _bytes(texts: list) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]


def _slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Runs of documents of about SLICE_BYTES: what a step holds does not grow with the batch."""
    place = np.cumsum([len(t) for t in texts]) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(place)) + 1), len(texts)]
    return (texts[a:b] for a, b in zip(cuts, cuts[1:]))


def _per_text(flag: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flag, dtype=np.int64)))
    return total[end] - total[start]


def _counts(texts: list[bytes]) -> tuple[dict, tuple]:
    buf, start, end = join_texts(texts)
    ws, we = word_bounds(buf)
    first, last = np.searchsorted(ws, start), np.searchsorted(ws, end)
    words = range_hashes(prefix_sums(buf), ws, we)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    doc_of = np.repeat(np.arange(len(texts)), last - first)
    grams = window_hashes(words, 3)
    inside = doc_of[2:] == doc_of[:-2] if len(words) > 2 else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    _, back, many = np.unique(mix(grams[at] + doc_of[at].astype(np.uint64)), return_inverse=True, return_counts=True)
    again = at[many[back] > 1]
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[again + k] = True
    dup = []
    for t in texts:
        lines = [x for x in t.split(b"\n") if x.split()] if b"\n" in t else []
        dup.append(len(lines) - len(set(lines)))
    out = {"n_words": last - first, "word_chars": _per_text(IS_WORD_BYTE[buf] & ((buf & 0xC0) != 0x80), start, end),
           "n_symbols": _per_text(symbol[buf], start, end), "n_dup_lines": np.array(dup, np.int64),
           "n_repeat_words": _per_text(covered, first, last)}
    return out, (words, doc_of)


def base_failed(counts: dict) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])


def _grams(texts: list[bytes], words: np.ndarray, doc_of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram family the text and the bucket of every n-gram: characters by
    one to three code points, words alone and in pairs."""
    chars = [t.decode("utf-8", "surrogatepass") for t in texts]
    size = np.fromiter((len(c) for c in chars), np.int64, len(chars))
    code = np.frombuffer("".join(chars).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    for family, (unit, of, top) in enumerate(((code, np.repeat(np.arange(len(texts)), size), 3), (words, doc_of, 2))):
        for n in range(1, top + 1):
            if len(unit) >= n:
                inside = of[n - 1:] == of[:len(of) - n + 1]
                bucket = mix(window_hashes(unit, n) + np.uint64(16 * family + n)) >> np.uint64(64 - BITS)
                yield of[:len(inside)][inside], bucket[inside].astype(np.int64)


def _mean_weights(texts: list[bytes], weights: np.ndarray, words: np.ndarray, doc_of: np.ndarray) -> np.ndarray:
    total, n = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for of, bucket in _grams(texts, words, doc_of):
        sums = np.concatenate(([0], np.cumsum(weights[bucket])))
        lo, hi = np.searchsorted(of, np.arange(len(texts))), np.searchsorted(of, np.arange(len(texts)), "right")
        total += sums[hi] - sums[lo]
        n += hi - lo
    return total / np.maximum(n, 1)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through held-out scores.  The targets
    stay a little away from 0 and 1, so that separable rows keep finite figures;
    Newton steps are halved until the loss falls."""
    up, down = y.sum(), (1 - y).sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))

    def loss(ab: np.ndarray) -> float:
        s = ab[0] * z + ab[1]
        return float((np.logaddexp(0, s) - t * s).sum())

    ab = np.array([1.0, 0.0])
    for _ in range(60):
        p = _logistic(ab @ np.stack([z, np.ones_like(z)]))
        g, k = np.array([((p - t) * z).sum(), (p - t).sum()]), p * (1 - p) + 1e-9
        move = np.linalg.solve(np.array([[(k * z * z).sum() + 1e-6, (k * z).sum()], [(k * z).sum(), k.sum() + 1e-6]]), g)
        size = 1.0
        while size > 1e-6 and loss(ab - size * move) >= loss(ab):
            size /= 2
        if size <= 1e-6:
            break
        ab = ab - size * move
    return float(ab[0]), float(ab[1])


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    """Full-batch Adam on the sparse mean n-gram counts, then a two-parameter
    logistic calibration on the rows that were held out."""
    rows = rows.drop_duplicates(["doc_id", "text"]).sort_values(["doc_id", "text"])
    texts, y = _bytes(rows["text"].tolist()), rows["good"].to_numpy(float)
    held = np.arange(len(y)) % HOLD_OUT == 0
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        return pd.DataFrame({"weights": [], "slope": [], "offset": []})
    row, col, val, at = [], [], [], 0
    for part in _slices(texts):
        _, (words, doc_of) = _counts(part)
        made = list(_grams(part, words, doc_of)) or [(np.zeros(0, np.int64), np.zeros(0, np.int64))]     # only empty texts
        of, bucket = map(np.concatenate, zip(*made, strict=True))
        cell, n = np.unique(of << BITS | bucket, return_counts=True)
        size = np.bincount(of, minlength=len(part))
        row.append(((cell >> BITS) + at).astype(np.int32))
        col.append((cell & (1 << BITS) - 1).astype(np.int32))
        val.append(n / size[cell >> BITS] * SCALE)
        at += len(part)
    row, col, val = map(np.concatenate, (row, col, val))
    use = ~held[row]
    row_u, col_u, val_u = row[use], col[use], val[use]
    w, b = np.zeros(1 << BITS), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(row_u, w[col_u] * val_u, len(y)) + b
        miss = np.where(held, 0, _logistic(z) - y) / max(1, (~held).sum())
        g = np.append(np.bincount(col_u, miss[row_u] * val_u, len(w)) + 1e-6 * w, miss.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.02 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    whole = np.rint(w * UNIT).astype(np.int64)
    z = np.bincount(row, (whole / UNIT)[col] * val, len(y))[held]
    slope, offset = _calibrate(z, y[held])
    return pd.DataFrame({"weights": [whole.tobytes()], "slope": [slope], "offset": [offset]})


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict | None:
    """The fitted model, or None without labelled rows of both classes.  The model
    has a fixed size (2**16 weights), whatever the input."""
    usable = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("quality").alias("good")))
    size = {r.good: r.n for r in usable.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}   # two rows at most
    if len(size) < 2:
        return None
    rare = min(size, key=size.get)
    quota = {rare: min(size[rare], max(round(rows * size[rare] / sum(size.values())), int(RARE_SHARE * rows)))}
    quota[1 - rare] = min(size[1 - rare], rows - quota[rare])
    allowed = F.when(F.col("good") == rare, quota[rare]).otherwise(quota[1 - rare])
    chosen = (drawn_by_group(usable, "good", F.col("doc_id"), allowed)
              .withColumn("_r", F.row_number().over(Window.partitionBy("good").orderBy("_h", "doc_id")))
              .where(F.col("_r") <= allowed).select("doc_id", "good"))
    texts = (columns(docs, "doc_id", "text").where(F.col("text").isNotNull())
             .join(F.broadcast(chosen), "doc_id"))  # at most ``rows`` rows
    # Repeated ids could bring in more: the bound holds for texts as well.
    texts = texts.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(rows)
    found = texts.groupBy(F.lit("all").alias("_all")).applyInPandas(_fit, "weights binary, slope double, offset double").collect()
    if not found:
        return None
    return {"weights": np.frombuffer(found[0].weights, np.int64), "slope": found[0].slope, "offset": found[0].offset}


def _judge(model: dict | None):
    def judge_slice(raw: list[bytes]) -> dict:
        out, (words, doc_of) = _counts(raw)
        out["base_failed"] = base_failed(out)
        if model is None:
            out["probability"] = np.where(out["base_failed"], 0.0, 1.0)
        else:
            z = _mean_weights(raw, model["weights"], words, doc_of) / UNIT * SCALE
            out["probability"] = _logistic(model["slope"] * z + model["offset"])
        out["kept"] = ~out["base_failed"] & (out["probability"] >= KEEP_AT)
        return out

    def judge(texts: list) -> dict:
        parts = [judge_slice(raw) for raw in _slices(_bytes(texts))]
        return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}
    return judge


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, the base counts, base_failed, probability and kept of every row."""
    return map_texts(docs, lambda: _judge(model), BASE_SCHEMA + ", base_failed boolean, probability double, kept boolean")


def keep_good(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    names = docs.columns
    at = names.index("text")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _judge(model)
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE_ROWS):
                part = whole.slice(i, SLICE_ROWS)
                yield part.filter(pa.array(judge(part.column(at).to_pylist())["kept"])).rename_columns(names)

    return docs.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(step, docs.schema)
