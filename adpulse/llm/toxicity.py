"""Toxicity by a linear-chain conditional random field over the words of a text.

1. Learning, on at most ``TRAIN_ROWS`` labelled documents (a documented bound, half of them
   toxic where there are enough), in one task.  Labels are of documents, so the words of the
   sample are labelled first: a word counts as toxic where it stands in a toxic document, if
   it, or its beginning or ending, is in toxic documents so much more often than in clean
   ones that chance is ruled out (log-likelihood ratio, near copies counted once).  The field
   has two tags; a word's own form, beginnings, endings and shape and both its neighbours
   decide on the tag with the tag before.  Weights are fitted to the labelled words by gradient steps on the conditional
   likelihood, the expected counts coming from the forward-backward sums.
2. Scoring, one map-only pass over all whole texts: forward-backward marginals give each
   word's probability of being toxic.  Words of one half or more make up the offending
   spans (code point offsets); their expected number and the most certain word give the
   document's score, by a logistic curve that was fitted to the sample's document labels.

The sums over a batch run in blocks: 2 x 2 matrices are multiplied within blocks side by
side, carried across blocks, and applied within blocks again.  That is the exact chain for
words of any number.

Edge cases: a null text is empty; a text without words has the score that no evidence gives;
without labelled documents of both classes, or if no word is certain, every score is the
share of toxic rows among the labelled ones (0 without labels); a null doc_id is neither held out nor
learned from; repeated rows are scored alike and learned from once."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, columns, drawn_by_group
from .quality import _calibrate as calibrate

TRAIN_ROWS = 2000
HOLD_OUT = 4              # every fourth training row fits the document curve instead
STEPS = 40
RATE = 0.2
SHRINK = 1e-4             # pull of the weights towards 0, a token
SEEN = 2                  # training documents that a feature must stand in
CHANCE = 12.0             # least log-likelihood ratio of a toxic word or stem, beyond 2 ln(number of them)
PURE = 0.98               # least share of toxic documents among those with it, by rates
STEMS = (4, 5, 6)         # letters of a beginning or ending that may be toxic as a whole
COPY = 0.5                # share of known three-word windows that makes a document a copy
BLOCK = 128               # words in a block of the chain
CACHE_ENTRIES = 300_000   # words that a worker remembers; it starts anew when full
PORTION = 1 << 20         # characters that are scored at a time
TOKEN = re.compile(r"[^\W_]+")

_WORKER: dict = {}


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# ---------------------------------------------------------------- the chain


class Chain:
    """Tag probabilities of many chains laid end to end.  ``odds``: what each word itself
    says for the tag T against O (log); ``opens``: where chains begin; ``step``: log weights
    [tag before, tag]; ``begin``: log weight of T at an opening."""

    def __init__(self, odds: np.ndarray, opens: np.ndarray, step: np.ndarray, begin: float):
        n, s = len(odds), np.exp(step)
        self.n, self.rows = n, max(1, -(-n // BLOCK))
        up, open_ = np.exp(np.clip(self._lay(odds), -30, 30)), self._lay(opens)
        opening = math.exp(begin)
        oo, to = (np.where(open_, 1.0, s[i, 0]) for i in (0, 1))
        ot, tt = (np.where(open_, opening, s[i, 1]) * up for i in (0, 1))
        past = self._lay(np.ones(n, bool)) < 1                  # the padding changes nothing
        for x, v in ((oo, 1.0), (ot, 0.0), (to, 0.0), (tt, 1.0)):
            x[past] = v
        self.m = m = (oo, ot, to, tt)
        whole = [np.ones(self.rows), np.zeros(self.rows), np.zeros(self.rows), np.ones(self.rows)]
        for j in range(BLOCK):
            a, b, c, d = whole
            whole = [a * oo[j] + b * to[j], a * ot[j] + b * tt[j], c * oo[j] + d * to[j], c * ot[j] + d * tt[j]]
            scale = 1 / (whole[0] + whole[1] + whole[2] + whole[3])
            whole = [x * scale for x in whole]
        ahead, behind = np.ones((2, self.rows)), np.ones((2, self.rows))
        blocks = list(zip(*(x.tolist() for x in whole)))
        p, q = 1.0, 1.0
        for r in range(self.rows - 1):
            a, b, c, d = blocks[r]
            p, q = p * a + q * c, p * b + q * d
            p, q = p / (p + q), q / (p + q)
            ahead[:, r + 1] = p, q
        p, q = 1.0, 1.0
        for r in range(self.rows - 1, 0, -1):
            a, b, c, d = blocks[r]
            p, q = a * p + b * q, c * p + d * q
            p, q = p / (p + q), q / (p + q)
            behind[:, r - 1] = p, q
        self.before, self.after = np.empty((2, BLOCK, self.rows)), np.empty((2, BLOCK, self.rows))
        p, q = ahead
        for j in range(BLOCK):
            p, q = p * oo[j] + q * to[j], p * ot[j] + q * tt[j]
            scale = 1 / (p + q)
            p, q = p * scale, q * scale
            self.before[0, j], self.before[1, j] = p, q
        p, q = behind
        for j in range(BLOCK - 1, -1, -1):
            self.after[0, j], self.after[1, j] = p, q
            p, q = oo[j] * p + ot[j] * q, to[j] * p + tt[j] * q
            scale = 1 / (p + q)
            p, q = p * scale, q * scale
        both = self.before[1] * self.after[1]
        self.toxic = self._flat(both / (both + self.before[0] * self.after[0]))

    def _lay(self, x: np.ndarray) -> np.ndarray:
        """[place in block, block], so that a step over all blocks reads one row."""
        full = np.zeros(self.rows * BLOCK, x.dtype)
        full[:self.n] = x
        return np.ascontiguousarray(full.reshape(self.rows, BLOCK).T)

    def _flat(self, x: np.ndarray) -> np.ndarray:
        return x.T.ravel()[:self.n]

    def pairs(self, opens: np.ndarray) -> np.ndarray:
        """Expected number of each [tag before, tag] within the chains."""
        inner = ~opens[1:]
        earlier = [self._flat(x)[:-1] for x in self.before]
        p = [earlier[k >> 1] * self._flat(self.m[k])[1:] * self._flat(self.after[k & 1])[1:] for k in range(4)]
        scale = inner / (p[0] + p[1] + p[2] + p[3])
        return np.array([(x * scale).sum() for x in p]).reshape(2, 2)


# ---------------------------------------------------------------- features


def _key(kind: str, what: str) -> int:
    return xxhash.xxh64_intdigest(f"{kind}={what}".encode("utf-8", "surrogatepass")) - (1 << 63)


def units(low: str) -> list[str]:
    """A word and its beginnings and endings, as words of one stem differ in the rest."""
    return [low, *(low[:k] + "*" for k in STEMS if len(low) > k), *("*" + low[-k:] for k in STEMS if len(low) > k)]


OWN = 7     # features of the word itself; the last two are lent to the words beside it


def features(word: str) -> list[int]:
    """The word, its beginnings, endings and shape; what it says of the next word and of the one before."""
    low = word.lower()
    shape = "digit" if any(c.isdigit() for c in word) else "upper" if word.isupper() else "title" if word[:1].isupper() else "lower"
    return [_key("word", low), _key("start", low[:3]), _key("start", low[:4]), _key("start", low[:5]), _key("end", low[-3:]), _key("end", low[-4:]),
            _key("shape", shape), _key("before", low), _key("behind", low)]


def _shares(types: np.ndarray, opens: np.ndarray, own: np.ndarray, lent: np.ndarray, owed: np.ndarray) -> np.ndarray:
    """Each word's odds: its own, with what its neighbours in the text lend."""
    odds = own[types].copy()
    odds[1:] += np.where(opens[1:], 0, lent[types[:-1]])
    odds[:-1] += np.where(opens[1:], 0, owed[types[1:]])
    return odds


# ---------------------------------------------------------------- learning


def toxic_units(texts: list[list[str]], toxic: np.ndarray) -> set[str]:
    """Words and stems that stand in toxic documents far beyond chance, and hardly in clean
    ones.  A document that shares half of its three-word windows with those before it counts
    as their copy."""
    seen: set = set()
    counts, size = [Counter(), Counter()], [0, 0]
    for ws, y in zip(texts, toxic, strict=True):
        windows = set(zip(ws, ws[1:], ws[2:])) or {tuple(ws)}
        if len(windows & seen) > COPY * len(windows):
            continue
        seen |= windows
        counts[y].update({u for w in set(ws) for u in units(w)})
        size[y] += 1
    if not all(size):
        return set()
    limit = CHANCE + 2 * math.log(len(counts[0].keys() | counts[1].keys()) + 1)
    share, found = size[1] / sum(size), set()
    for u, a in counts[1].items():
        b = counts[0][u]
        # Purity is judged by shares, as the sample holds more toxic documents than the labels do.
        if a / size[1] >= PURE * (a / size[1] + b / size[0]):
            ratio = a * math.log(a / (share * (a + b))) + (b * math.log(b / ((1 - share) * (a + b))) if b else 0)
            if 2 * ratio > limit:
                found.add(u)
    return found


def _number(words: list[str]) -> tuple[np.ndarray, list[str]]:
    index: dict[str, int] = {}
    types = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    return types, list(index)


def fit(texts: list[list[str]], tags: list[np.ndarray], steps: int = STEPS) -> dict:
    """Weights of a field from labelled words: ``tags`` are 1 for toxic words, else 0."""
    types, index = _number([w for ws in texts for w in ws])
    size = np.array([len(ws) for ws in texts], np.int64)
    y = np.concatenate(tags).astype(float) if len(types) else np.zeros(0)
    opens = np.zeros(len(types), bool)
    opens[(np.cumsum(size) - size)[size > 0]] = True
    raw = np.array([features(w) for w in index], np.int64).reshape(len(index), OWN + 2)
    doc = np.repeat(np.arange(len(texts)), size)
    once = np.unique(np.stack([doc, types]), axis=1)[1]
    keys, back = np.unique(raw, return_inverse=True)
    back = back.reshape(raw.shape)
    documents = np.bincount(back[once].ravel(), minlength=len(keys))
    keep = documents >= SEEN
    place = np.where(keep, np.cumsum(keep) - 1, keep.sum())[back]        # the last place stands for none
    w = np.zeros(int(keep.sum()) + 1)
    rest = np.array([0.0, -4.0, 0.0, 0.0, -4.0])                         # steps OO, OT, TO, TT; opening
    m, v = np.zeros(len(w) + 5), np.zeros(len(w) + 5)
    inner = np.flatnonzero(~opens)
    seen = np.bincount((2 * y[inner - 1] + y[inner]).astype(np.int64), minlength=4)
    for step in range(1, steps + 1):
        chain = Chain(_shares(types, opens, w[place[:, :OWN]].sum(axis=1), w[place[:, OWN]], w[place[:, OWN + 1]]), opens, rest[:4].reshape(2, 2), rest[4])
        miss = chain.toxic - y
        ahead, behind = np.where(opens[1:], 0, miss[1:]), np.where(opens[1:], 0, miss[:-1])
        of_type = np.bincount(types, miss, len(index))
        g = sum(np.bincount(place[:, k], of_type, len(w)) for k in range(OWN))
        g += np.bincount(place[:, OWN], np.bincount(types[:-1], ahead, len(index)), len(w))
        g += np.bincount(place[:, OWN + 1], np.bincount(types[1:], behind, len(index)), len(w))
        g = g + SHRINK * len(types) * w / len(w)
        g = np.concatenate([g, chain.pairs(opens).ravel() - seen, [miss[opens].sum()]])
        g[len(w) - 1], g[len(w)] = 0, 0                                  # no feature; OO stays 0
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, rest = w - move[:len(w)], rest - move[len(w):]
    order = np.argsort(keys[keep])
    return {"keys": keys[keep][order], "weights": w[:-1][order], "rest": rest}


def _evidence(toxic: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of each text: how certain its most certain word is, more for every likely one."""
    likely = np.concatenate(([0], np.cumsum(np.where(toxic >= 0.5, toxic, 0))))
    out = np.log1p(likely[end] - likely[start])
    peak = np.zeros(len(start))
    some = np.flatnonzero(end > start)
    if len(some):
        peak[some] = np.maximum.reduceat(toxic, start[some])
    peak = np.clip(peak, 1e-3, 1 - 1e-3)
    return out + np.log(peak / (1 - peak))


_MODEL = "keys binary, weights binary, rest binary, curve binary"


def _learn(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.drop_duplicates(["doc_id", "text"]).sort_values(["doc_id", "text"])
    texts = [TOKEN.findall(t) for t in rows["text"]]
    low = [[w.lower() for w in ws] for ws in texts]
    toxic, share = rows["toxic"].to_numpy(np.int64), float(rows["share"].iloc[0])
    known = toxic_units(low, toxic)
    if not known:
        return pd.DataFrame({"keys": [], "weights": [], "rest": [], "curve": []})
    marked = {w for w in {w for ws in low for w in ws} if not known.isdisjoint(units(w))}
    tags = [np.array([y and w in marked for w in ws], bool) for ws, y in zip(low, toxic, strict=True)]
    fits = np.arange(len(texts)) % HOLD_OUT != 0
    # A toxic document without a known word may hold an unknown one: its words are not labelled.
    use = [k for k in np.flatnonzero(fits) if len(texts[k]) and (not toxic[k] or tags[k].any())]
    model = fit([texts[k] for k in use], [tags[k] for k in use])
    field, found = Field(model), []
    for k in range(0, len(texts), SLICE_ROWS):
        part = [texts[i] for i in range(k, min(k + SLICE_ROWS, len(texts))) if not fits[i]]
        found.append(_evidence(*field.probabilities(part)))
    y = toxic[~fits].astype(float)
    if len(set(y)) < 2:
        return pd.DataFrame({"keys": [], "weights": [], "rest": [], "curve": []})
    slope, offset = calibrate(np.concatenate(found), y)
    # The sample holds more toxic rows than the labels do.
    offset += math.log(share / (1 - share)) - math.log(y.mean() / (1 - y.mean()))
    curve = np.array([slope, offset])
    return pd.DataFrame({k: [v.tobytes()] for k, v in (*model.items(), ("curve", curve))})


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """The model: at most a few hundred thousand weights, as ``rows`` bounds the sample."""
    usable = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    size = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}     # two rows at most
    share = size.get(1, 0) / max(1, sum(size.values()))
    if len(size) < 2:
        return {"share": share}
    quota = {c: min(size[c], max(rows // 2, rows - size[1 - c])) for c in size}
    asked = F.when(F.col("toxic") == 1, quota[1] / 2).otherwise(quota[0] / 2)        # about twice that is drawn
    chosen = drawn_by_group(usable, "toxic", F.col("doc_id"), asked).select("doc_id", "toxic")
    texts = (columns(docs, "doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")   # about ``rows`` rows
             .orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(rows + rows // 4))    # repeated ids could bring in more
    found = texts.withColumn("share", F.lit(share)).groupBy(F.lit("all").alias("_all")).applyInPandas(_learn, _MODEL).collect()
    if not found:
        return {"share": share}
    kinds = {"keys": np.int64}
    return {"share": share} | {k: np.frombuffer(found[0][k], kinds.get(k, np.float64)) for k in ("keys", "weights", "rest", "curve")}


# ---------------------------------------------------------------- scoring


class Field:
    def __init__(self, model: dict):
        self.model = model
        self.step, self.begin = model["rest"][:4].reshape(2, 2), float(model["rest"][4])
        self.known: dict[str, int] = {}
        self.parts = np.zeros((0, 3))

    def _weights(self, found: list[str]) -> np.ndarray:
        key = np.array([features(w) for w in found], np.int64).reshape(len(found), OWN + 2)
        keys, weights = self.model["keys"], self.model["weights"]
        if not len(keys):
            return np.zeros((len(found), 3))
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        w = np.where(keys[at] == key, weights[at], 0.0)
        return np.stack([w[:, :OWN].sum(axis=1), w[:, OWN], w[:, OWN + 1]], axis=1)

    def probabilities(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each word's probability of being toxic, and where each text starts and ends."""
        if len(self.known) > CACHE_ENTRIES:
            self.known, self.parts = {}, self.parts[:0]
        known = self.known
        new = list({w for ws in texts for w in ws if w not in known})
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.parts = np.concatenate([self.parts, self._weights(new)])
        size = np.array([len(ws) for ws in texts], np.int64)
        end = np.cumsum(size)
        types = np.fromiter((known[w] for ws in texts for w in ws), np.int64, int(size.sum()))
        opens = np.zeros(len(types), bool)
        opens[(end - size)[size > 0]] = True
        if not len(types):
            return np.zeros(0), end - size, end
        odds = _shares(types, opens, *self.parts.T)
        return Chain(odds, opens, self.step, self.begin).toxic, end - size, end

    def judge(self, texts: list[str | None]) -> dict:
        found = [TOKEN.findall(t) if t else [] for t in texts]
        toxic, start, end = self.probabilities(found)
        slope, offset = self.model["curve"]
        z = slope * _evidence(toxic, start, end) + offset
        spans: list[list] = [[] for _ in texts]
        likely = np.flatnonzero(toxic >= 0.5)
        for k in np.unique(np.searchsorted(end, likely, "right")):
            marked, last = toxic[start[k]:end[k]] >= 0.5, -2
            for i, word in enumerate(TOKEN.finditer(texts[k])):
                if marked[i] and last == i - 1:
                    spans[k][-1]["end"] = word.end()
                elif marked[i]:
                    spans[k].append({"start": word.start(), "end": word.end()})
                last = i if marked[i] else last
        return {"score": np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 9), "spans": spans}


def _portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in order, PORTION characters or one text at a time."""
    some, size = [], 0
    for t in texts:
        if some and size + len(t or "") > PORTION:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t or "")
    if some:
        yield some


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted and the offending spans of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # bounded by the training sample
    name = uuid.uuid4().hex

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _WORKER.get("name") != name:
            _WORKER.update(name=name, field=Field(shared.value) if "keys" in shared.value else None)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                part = whole.slice(at, SLICE_ROWS)
                if _WORKER["field"] is None:
                    made = {"score": np.full(part.num_rows, shared.value["share"]), "spans": [[]] * part.num_rows}
                else:
                    parts = [_WORKER["field"].judge(some) for some in _portions(part.column(2).to_pylist())]
                    made = {"score": np.concatenate([p["score"] for p in parts]), "spans": [s for p in parts for s in p["spans"]]}
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(made["score"], pa.float64()),
                     pa.array((made["score"] >= 0.5).astype(np.int32)), pa.array(made["spans"], _SPANS)],
                    names=["doc_id", "held_out", "score", "predicted", "spans"])

    rows = columns(docs, F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(step, "doc_id bigint, held_out boolean, score double, predicted int, spans array<struct<start:bigint,end:bigint>>")
