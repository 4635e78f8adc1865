"""Language identification by segmentation-marginalised unigrams.

For each language a probability is learned for every piece of a fixed public
vocabulary; a word's probability is the sum over all its segmentations into
pieces, by the forward algorithm, and a text's is the product over its words
(white-space segments in lower case, with the blank before them).  The language
that makes the text most probable is predicted.

The probabilities are fitted by expectation maximisation on at most ``TRAIN_ROWS``
documents of each language (a documented bound), in one task: of those that are not
held out, the different ones with the language's smallest hashes, however rare it is.
Every row's whole text is scored, in one map-only pass; a worker remembers the words
it has scored.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, as is
every text if nothing was learned; a word may have any length, as may a piece;
a null doc_id is neither held out nor learned from; repeated rows are scored alike and
learned from once."""

from __future__ import annotations

import base64
import re
import uuid
from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, drawn_by_group, map_texts

TRAIN_ROWS = 300          # documents of each language
BLOCK = 32                # bytes of a word between two scalings of its sums
BATCH_CELLS = 1 << 22     # numbers held at a time: words x places x languages
ROUNDS = 3
FLOOR = 0.02              # count that every piece starts with
CACHE_ENTRIES = 400_000   # words that a worker remembers; it starts anew when full
SLOTS = 1 << 20
LETTER = re.compile(r"[^\W\d_]")

_WORKER: dict = {}


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Pieces:
    """The vocabulary's pieces, of any length, as a tree of their prefixes; zero bytes do
    not occur in words.  A child is found by its parent's number and a byte, in tables of
    slots; children whose slot is taken go to the next table."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            found = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
        found = sorted({p for p in found if p and 0 not in p} | {bytes([b]) for b in range(1, 256)})
        self.n, self.longest = len(found), max(map(len, found))
        node, key = {b"": 0}, [(1 << 64) - 1]
        for p in found:
            for k in range(1, len(p) + 1):
                if p[:k] not in node:
                    node[p[:k]] = len(node)
                    key.append(node[p[:k - 1]] << 8 | p[k - 1])
        self.key = np.array(key, np.uint64)
        self.piece = np.full(len(key), -1, np.int32)
        self.piece[[node[p] for p in found]] = np.arange(self.n)
        self.tables, left = [], np.arange(1, len(key))
        while len(left):
            table = np.full(SLOTS, -1, np.int32)
            slot = self._slot(self.key[left], len(self.tables))
            table[slot] = left
            self.tables.append(table)
            left = left[table[slot] != left]

    @staticmethod
    def _slot(key: np.ndarray, level: int) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15 + 2 * level)) >> np.uint64(44 - 4 * level)).astype(np.int64) & (SLOTS - 1)

    def child(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node that each byte leads to, or -1."""
        key = node.astype(np.uint64) << np.uint64(8) | byte
        out = np.full(len(key), -1, np.int32)
        for level, table in enumerate(self.tables):
            at = table[self._slot(key, level)]
            hit = (at >= 0) & (self.key[at] == key)
            out[hit] = at[hit]
        return out


def _pieces(path: str) -> Pieces:
    if _WORKER.get("path") != path:
        _WORKER.update(path=path, pieces=Pieces(path))
    return _WORKER["pieces"]


def _batches(pieces: Pieces, words: list[str], langs: int):
    """The words' numbers and bytes, each word with the blank before it, longest first;
    as many at a time as BATCH_CELLS allows."""
    raw = [b" " + w.lower().encode("utf-8", "surrogatepass").replace(b"\0", b"") for w in words]
    order = sorted(range(len(raw)), key=lambda i: -len(raw[i]))
    at = 0
    while at < len(order):
        width = min(len(raw[order[at]]), BLOCK + pieces.longest) + 1
        part = order[at:at + max(1, BATCH_CELLS // (width * max(1, langs)))]
        yield np.array(part), [raw[i] for i in part]
        at += len(part)


class Block(NamedTuple):
    """The pieces that begin at BLOCK places in a row of each word.  Cell ``row * width + k``
    stands for the place k bytes behind the first."""
    first: int
    rows: int               # words that reach beyond the first place
    width: int
    start: np.ndarray       # cell before each piece
    end: np.ndarray         # cell behind it
    piece: np.ndarray
    groups: list[slice]     # pieces of one start and one length: at most one in a word


def _blocks(pieces: Pieces, raw: list[bytes]):
    """Words, longest first, block by block: a word of any length takes the memory of one."""
    flat = np.frombuffer(b"".join(raw), np.uint8)
    size = np.array([len(r) for r in raw])
    base = np.cumsum(size) - size
    for first in range(0, size[0], BLOCK):
        rows = int((size > first).sum())
        width = int(min(BLOCK + pieces.longest, size[0] - first)) + 1
        row, off = (a.ravel() for a in np.meshgrid(np.arange(rows), np.arange(min(BLOCK, size[0] - first)), indexing="ij"))
        node, found, k = np.zeros(len(row), np.int32), [], 0
        while len(row):
            on = size[row] > first + off + k
            row, off, node = row[on], off[on], node[on]
            node = pieces.child(node, flat[base[row] + first + off + k])
            row, off, node, k = row[node >= 0], off[node >= 0], node[node >= 0], k + 1
            whole = pieces.piece[node] >= 0
            found.append((row[whole] * width + off[whole], np.full(whole.sum(), k), pieces.piece[node[whole]], off[whole]))
        start, length, piece, off = (np.concatenate(a) for a in zip(*found, strict=True))
        group = off * (pieces.longest + 1) + length
        order = np.argsort(group, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(group[order])) + 1), len(order)]
        yield Block(first, rows, width, start[order], (start + length)[order], piece[order],
                    [slice(a, b) for a, b in zip(cuts, cuts[1:])])


def _forward(blocks, size: np.ndarray, prob: np.ndarray):
    """For each block its sums over all segmentations up to each cell, [row, cell, language],
    the logarithm that they are scaled by, and the words that end in it."""
    scale, carry = np.zeros((len(size), prob.shape[1])), np.ones((len(size), 1, prob.shape[1]))
    for b in blocks:
        sums = np.zeros((b.rows, b.width, prob.shape[1]))
        sums[:, :carry.shape[1]] = carry
        cells = sums.reshape(-1, prob.shape[1])
        for g in b.groups:
            cells[b.end[g]] += cells[b.start[g]] * prob[b.piece[g]]
        ending = np.flatnonzero(size[:b.rows] <= b.first + BLOCK)
        yield b, sums, scale[:b.rows].copy(), ending
        going = b.rows - len(ending)
        if going:
            carry = sums[:going, BLOCK:]
            top = carry.max(axis=1)
            scale[:going] += np.log(top)
            carry = carry / top[:, None]


def _ends(b: Block, sums: np.ndarray, scale: np.ndarray, ending: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.log(sums[ending, size[ending] - b.first]) + scale[ending]


def log_likelihoods(pieces: Pieces, words: list[str], prob: np.ndarray) -> np.ndarray:
    """log P(word | language), for every word and language."""
    out = np.zeros((len(words), prob.shape[1]))
    for word, raw in _batches(pieces, words, prob.shape[1]):
        size = np.array([len(r) for r in raw])
        for b, sums, scale, ending in _forward(_blocks(pieces, raw), size, prob):
            out[word[ending]] = _ends(b, sums, scale, ending, size)
    return out


def _expected(blocks: list[Block], size: np.ndarray, prob: np.ndarray, weight: np.ndarray, made: np.ndarray) -> None:
    """Adds to ``made`` how often each piece is expected in the weighted words."""
    done = list(_forward(blocks, size, prob))
    total = np.zeros(weight.shape)
    for b, sums, scale, ending in done:
        total[ending] = _ends(b, sums, scale, ending, size)
    carry = np.zeros((0, BLOCK, weight.shape[1]))
    with np.errstate(divide="ignore"):
        for b, sums, scale, ending in reversed(done):
            logs = np.full(sums.shape, -np.inf)              # of the sums from each cell to the word's end
            logs[:len(carry), BLOCK:] = carry[:, :max(0, b.width - BLOCK)]
            logs[ending, size[ending] - b.first] = 0
            used = np.zeros(b.rows * b.width, bool)
            used[b.end] = True
            known = np.where(used.reshape(b.rows, b.width, 1), logs, -np.inf)
            after = known.max(axis=1)
            rest = np.exp(known - after[:, None])
            cells, before = rest.reshape(-1, prob.shape[1]), sums.reshape(-1, prob.shape[1])
            for g in reversed(b.groups):
                cells[b.start[g]] += cells[b.end[g]] * prob[b.piece[g]]
            row = b.start // b.width
            factor = scale + after - total[:b.rows]
            for c in range(prob.shape[1]):
                share = np.exp(np.log(before[b.start, c]) + np.log(cells[b.end, c]) + factor[row, c])
                made[:, c] += np.bincount(b.piece, share * prob[b.piece, c] * weight[row, c], len(made))
            logs[:, :BLOCK] = np.log(rest[:, :BLOCK]) + after[:, None]
            carry = logs


def _fit(pieces: Pieces, counts: list[Counter]) -> np.ndarray:
    """Piece probabilities [piece, language]."""
    words = sorted(set().union(*counts))
    weight = np.array([[c[w] for c in counts] for w in words], float).reshape(len(words), len(counts))
    parts = [(word, np.array([len(r) for r in raw]), list(_blocks(pieces, raw)))
             for word, raw in _batches(pieces, words, len(counts))]
    prob = np.full((pieces.n, len(counts)), 1.0 / pieces.n)
    for _ in range(ROUNDS):
        made = np.full(prob.shape, FLOOR)
        for word, size, blocks in parts:
            _expected(blocks, size, prob, weight[word], made)
        prob = made / made.sum(axis=0)
    return prob


def learn(docs: DataFrame, path: str, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """The languages and the piece probabilities."""
    usable = (columns(docs, "doc_id", "text", "lang")
              .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                     & ~held_out(F.col("doc_id"))))
    chosen = (drawn_by_group(usable, "lang", F.struct("doc_id", "text"), F.lit(rows))
              .withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id", "text")))
              .where(F.col("_r") <= rows).select("lang", "text"))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        langs = sorted(part["lang"].unique())
        counts = [Counter(w for t in part.loc[part["lang"] == lang, "text"] for w in t.split()) for lang in langs]
        prob = _fit(_pieces(path), counts)
        return pd.DataFrame({"lang": langs, "prob": [prob[:, c].tobytes() for c in range(len(langs))]})

    found = (chosen.groupBy(F.lit("all").alias("_all")).applyInPandas(fit, "lang string, prob binary")
             .collect())          # one vector of the vocabulary's size for each language
    langs = [r.lang for r in found]
    return langs, np.stack([np.frombuffer(r.prob) for r in found], axis=1) if found else np.zeros((0, 0))


class Scorer:
    def __init__(self, path: str, langs: list[str], prob: np.ndarray):
        self.pieces, self.langs, self.prob = _pieces(path), langs, prob
        self.cache: dict[str, int] = {}
        self.score = np.zeros((0, len(langs)))

    def predict(self, texts: list[str | None]) -> dict:
        lang, score = ["und"] * len(texts), [0.0] * len(texts)
        use = [i for i, t in enumerate(texts) if t and self.langs and LETTER.search(t)]
        words = [texts[i].split() for i in use]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache, self.score = {}, self.score[:0]
        new = list({w for ws in words for w in ws if w not in self.cache})
        if new:
            self.cache.update(zip(new, range(len(self.score), len(self.score) + len(new))))
            self.score = np.concatenate([self.score, log_likelihoods(self.pieces, new, self.prob)])
        for i, ws in zip(use, words, strict=True):
            total = self.score[np.fromiter(map(self.cache.__getitem__, ws), np.int64, len(ws))].sum(axis=0)
            best = int(np.argmax(total))
            lang[i], score[i] = self.langs[best], float(1 / np.exp(total - total[best]).sum())
        return {"lang_pred": lang, "score": score}


def identify(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    langs, prob = learn(docs, path)
    model = docs.sparkSession.sparkContext.broadcast((langs, prob))   # languages x vocabulary, whatever the input
    name = uuid.uuid4().hex

    def make():
        if _WORKER.get("model") != name:
            _WORKER.update(model=name, scorer=Scorer(path, *model.value))
        return _WORKER["scorer"].predict

    rows = columns(docs, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    return map_texts(rows, make, "lang_pred string, score double", keep=("doc_id", "held_out"))
