"""Packing documents into sequences of a fixed number of tokens, by cutting-stock
column generation.

1. One map-only pass encodes every whole text and cuts it into full pieces of
   ``capacity`` tokens and one rest.  Pieces carry a checksum of their ids, so the
   ids need not be kept.
2. The histogram of piece lengths, in steps of ``STEP`` tokens, has at most
   capacity / STEP classes, however many documents there are.  Over it, the linear
   program of the cutting-stock problem is solved by column generation: a knapsack
   by dynamic programming prices the next pattern.  Patterns are rounded down, the
   few pieces left are packed first-fit by falling length.
3. Within each class pieces are ranked (salted: a class may hold a third of all
   pieces) and the ranks are dealt to the patterns' places.

Edge cases: a null or empty text has only the closing id; repeated rows are packed
each on its own; a null doc_id is kept; an empty table gives no rows."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_ROWS, columns, stored

CAPACITY = 2048
STEP = 8                 # tokens to a length class
SALTS = 256              # parts that each class is ranked in
CLOSE = 1                # the id that ends each document
CACHE_ENTRIES = 400_000  # segments that a worker remembers; it starts anew when full
LONGEST = 48
GAP = 5e-4               # of the linear program's bound, where column generation may stop
MAX_COLUMNS = 4000

_WORKER: dict = {}


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, equal to those of
    the tokenizer.  A text whose white space is single blanks and newlines between
    other characters is put together from remembered segments, each with the blank
    or newline before it (the vocabulary's own word borders); others are encoded
    whole."""

    def __init__(self, path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.opens = np.zeros(max(ranks.values()) + 1, bool)
        self.opens[[r for t, r in ranks.items() if t[:1] in (b" ", b"\n")]] = True
        self.cache: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.encode(text)
        return np.array(ids, "<u4").tobytes()

    def _learn(self, segments: list[str]) -> dict[str, bytes]:
        good = [s for s in segments if len(x := s.removeprefix("\n")) and x.split() == [x] and "<|" not in x
                and not any(c in x for c in "\x85\xa0")]
        if not good:
            return {}
        ids = np.array(self.encode("".join(s if s[0] == "\n" else " " + s for s in good)), "<u4")
        at = np.flatnonzero(self.opens[ids])
        raw, cut = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
        if len(at) != len(good):  # some character opens tokens in an unexpected place
            return {}
        # "\n" before a segment is an id of its own, which also opens.
        return {s: raw[a:b] for s, a, b in zip(good, cut, cut[1:])}

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        parts = [("\n" + t).replace("\n", " \n").split(" ")[1:] if t else [] for t in texts]
        known = self.cache
        missed = {s for p in parts for s in p if s not in known}
        after_blank = [s for s in missed if s[:1] != "\n"]
        after_line = [s for s in missed if s[:1] == "\n"]
        new = self._learn(after_blank)
        bare = self._learn(list({s[1:] for s in after_line} - {""}))
        first = {s: self.whole(s[1:]) for s in after_line if s[1:] in bare}
        line = self.whole("\n")
        new |= {s: line + b for s, b in first.items()}
        known.update((s, b) for s, b in new.items() if len(s) <= LONGEST)
        out = []
        for t, p in zip(texts, parts, strict=True):
            if not t:
                out.append(b"")
                continue
            try:
                got = [known[s] if s in known else new[s] for s in p]
            except KeyError:
                out.append(self.whole(t))
                continue
            got[0] = got[0][len(line):]
            out.append(b"".join(got))
        return out


def _encoder(path: str, ranks_path: str, pattern: str) -> Encoder:
    if _WORKER.get("path") != path:
        _WORKER.update(path=path, encoder=Encoder(path, ranks_path, pattern))
    return _WORKER["encoder"]


def pieces(docs: DataFrame, tokenizer: dict, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: doc_id, start, length, ids_crc32, doc_tokens."""
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    close = np.array([CLOSE], "<u4").tobytes()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(**tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                part = whole.slice(at, SLICE_ROWS)
                rows = []
                for doc, raw in zip(part.column(0).to_pylist(), encoder.encode_all(part.column(1).to_pylist()), strict=True):
                    raw = memoryview(raw + close)
                    n = len(raw) // 4
                    rows += [(doc, a, min(capacity, n - a), zlib.crc32(raw[4 * a:4 * (a + capacity)]), n)
                             for a in range(0, n, capacity)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else
                                                 [pa.array([], pa.int64())] * 5,
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(step, schema)


def _best_pattern(price: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the classes (1..room) that are worth most in ``room``."""
    worth, last = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for r in range(1, room + 1):
        gain = worth[r - 1::-1][:r] + price[:r]   # class c leaves r - c
        c = int(np.argmax(gain))
        worth[r], last[r] = (gain[c], c + 1) if gain[c] > worth[r - 1] else (worth[r - 1], 0)
    made, r = np.zeros(room, np.int64), room
    while r > 0:
        if last[r]:
            made[last[r] - 1] += 1
            r -= last[r]
        else:
            r -= 1
    return float(worth[room]), made


def cut_patterns(need: np.ndarray, room: int) -> list[tuple[int, np.ndarray]]:
    """(copies, pieces by class) of patterns that hold exactly ``need`` pieces of each
    class 1..room in about as few sequences as there can be."""
    used = np.flatnonzero(need)
    if not len(used):
        return []
    size, want = used + 1, need[used].astype(float)
    m = len(used)
    basis = np.diag(room // size).astype(float)      # a column for each class alone
    inverse = np.diag(1.0 / np.diag(basis))

    def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * b).sum(axis=1)                   # no BLAS: its threads would contend with the JVM's

    x = times(inverse, want)
    for _ in range(MAX_COLUMNS):
        price = inverse.sum(axis=0)                  # each sequence costs 1
        offer = np.zeros(room)
        offer[used] = price
        value, made = _best_pattern(offer, room)
        if value <= 1 + GAP or x.sum() <= (1 + GAP) * float((price * want).sum()) / value:
            break
        column = made[used].astype(float)
        d = times(inverse, column)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(d > 1e-9, x / d, np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
        row = inverse[out] / d[out]
        inverse = inverse - d[:, None] * row
        inverse[out] = row
        x = np.maximum(times(inverse, want), 0)
    left, found = need.astype(np.int64).copy(), []

    def take(copies: int, made: np.ndarray) -> None:
        nonlocal left
        copies = min([copies, *(left[made > 0] // made[made > 0])])
        if copies > 0:
            left = left - copies * made
            found.append((int(copies), made))

    for k in np.argsort(-x, kind="stable"):
        made = np.zeros(room, np.int64)
        made[used] = np.rint(basis[:, k]).astype(np.int64)
        take(int(np.floor(x[k] + 1e-6)), made)
    while left.any():  # each round fills one sequence as far as it goes, for as many copies as there are
        made, free = np.zeros(room, np.int64), room
        for c in np.flatnonzero(left)[::-1]:
            if c + 1 <= free:
                made[c] = min(left[c], free // (c + 1))
                free -= made[c] * (c + 1)
        take(1 << 62, made)
    return found


def pack(docs: DataFrame, tokenizer: dict, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document with sequence_id and offset."""
    docs = columns(docs, "doc_id", "text")
    cut = stored(pieces(docs, tokenizer, capacity), "pieces").withColumns({
        "_class": F.ceil(F.col("length") / STEP).cast("int"),
        "_salt": F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SALTS)).cast("int")})
    room = -(-capacity // STEP)
    parts = cut.groupBy("_class", "_salt").agg(F.count(F.lit(1)).alias("_n"))     # at most room * SALTS rows
    need = np.zeros(room, np.int64)
    for r in parts.groupBy("_class").agg(F.sum("_n").alias("n")).collect():       # at most room rows
        need[r["_class"] - 1] = r["n"]

    # Places by class: the ranks from low on go to `copies` sequences from `base` on, `each` at a time.
    low, places, base = np.zeros(room, np.int64), [], 0
    for copies, made in cut_patterns(need, room):
        for c in np.flatnonzero(made):
            places.append((c + 1, low[c], made[c], base))
            low[c] += copies * made[c]
        base += copies
    places = np.array(sorted(places), np.int64).reshape(-1, 4)
    key = places[:, 0] << 44 | places[:, 1]

    before = Window.partitionBy("_class").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    ranked = cut.join(F.broadcast(offsets), ["_class", "_salt"]).withColumn(
        "_rank", F.col("_before") + F.row_number().over(
            Window.partitionBy("_class", "_salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")) - 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c, rank = (b.column(b.schema.get_field_index(n)).to_numpy() for n in ("_class", "_rank"))
            p = places[np.searchsorted(key, c.astype(np.int64) << 44 | rank, "right") - 1] if len(rank) else places[:0]
            made = p[:, 3] + (rank - p[:, 1]) // np.maximum(p[:, 2], 1)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(made, pa.int64())], names=[*names, "sequence_id"])

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_class"]
    dealt = ranked.select(*names, F.col("_rank").cast("long").alias("_rank")).mapInArrow(
        deal, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, _class int, sequence_id bigint")
    inside = (Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    return dealt.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")).drop("_class")
