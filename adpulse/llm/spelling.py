"""Spelling variants: words of a corpus grouped under the much more frequent word that they
differ from by one letter, by Bloom-guided neighbourhoods.

1. Words are counted by one aggregation over all texts (runs of letters, in lower case).
2. The words that are long and frequent enough are the vocabulary.  Its words go into
   blocked Bloom filters, a shard for each length: a word sets ``SET_BITS`` bits of one
   64-bit block of its length's shard.
3. Every word's edits are probed against the broadcast filters in Arrow batches: each
   letter left out, and each letter replaced by one that comes later in the alphabet.  That
   meets every pair once, as a pair of words one letter apart in length is found from the
   longer one and a replacement from the side of the earlier letter.
4. Only edits that the filters hold are shuffled, to an exact join with the vocabulary,
   which drops the false positives.
5. Each word's best neighbour by count becomes its form if it is ``RATIO`` times as
   frequent; forms are followed to their end by pointer doubling.

The filters take 32 bits a word.  A broadcast holds at most ``MOST_BITS`` of them: a larger
vocabulary is split by hash and every part probed in a pass of its own, so the result does
not depend on the bound.

Edge cases: a null text has no words; a null doc_id counts as an empty number in the hash
that misspells; an empty table gives no rows; repeated rows count as often as they stand."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, stored

#: The letters that a run holds, once A to Z are in lower case.
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = r"[A-Za-zÀ-ÿ]"
MISSPELT = 199            # one run in so many loses a letter
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5                 # of a form's count to its variant's
BITS_A_WORD = 32
SET_BITS = 5
MOST_BITS = 1 << 28       # of the filters that are broadcast at once: 32 MB
CHUNK = 1 << 14           # blocks that are gathered as one value
PROBES = 1 << 21          # edits that are generated at a time
DOUBLINGS = 64            # far above log2 of any chain: counts grow fivefold along it

_RNG = np.random.default_rng(20240412)
_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = np.uint64(pow(_STEP, -1, 2**64))
_LETTERS = np.array([ord(c) for c in ALPHABET], np.int64)


def words(docs: DataFrame) -> DataFrame:
    """word, n: the misspelt runs of at least MIN_LENGTH letters and how often each occurs."""
    run = F.explode(F.regexp_extract_all("text", F.lit(f"({RUN}{{{MIN_LENGTH},}})"), F.lit(1)))
    runs = (columns(docs, "doc_id", "text").select("doc_id", run.alias("run"))
            .select("doc_id", F.translate("run", UPPER, LOWER).alias("run")))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    cut = (h % F.length("run")).cast("int")
    word = F.when(h % MISSPELT != 0, F.col("run")).otherwise(
        F.concat(F.col("run").substr(F.lit(1), cut), F.col("run").substr(cut + 2, F.length("run"))))
    return (runs.select(word.alias("word")).where(F.length("word") >= MIN_LENGTH)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _STEP, np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def _mask(h: np.ndarray) -> np.ndarray:
    """SET_BITS bits of a block, from the low bits of the mixed hash."""
    bits = np.zeros(len(h), np.uint64)
    for k in range(SET_BITS):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return bits


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    """The block of a mixed hash, from its high bits."""
    return (((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def _by_length(found: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length the words' places and a matrix of their code points."""
    size = np.fromiter(map(len, found), np.int64, len(found))
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        code = np.frombuffer("".join(found[k] for k in at).encode("utf-32-le"), np.uint32).astype(np.int64)
        yield int(n), at, code.reshape(len(at), n)


def _part(h: np.ndarray, passes: int) -> np.ndarray:
    """The pass that a word belongs to; a hash of its own, as the blocks use the bits of h."""
    return (_mix(h) % np.uint64(passes)).astype(np.int64)


def _entries(passes: int, blocks: dict[int, int], number: int):
    """(length, chunk, block, mask) of the vocabulary's words of one pass."""
    def step(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for n, _, code in _by_length(part["word"].tolist()):
                h = _mix((_VALUE[code] * _powers(n)).sum(axis=1, dtype=np.uint64))
                h = h[_part(h, passes) == number]
                at = _block(h, blocks[n])
                yield pd.DataFrame({"length": np.full(len(h), n), "chunk": at // CHUNK, "block": at % CHUNK, "mask": _mask(h).view(np.int64)})
    return step


def _gather(part: pd.DataFrame) -> pd.DataFrame:
    """One chunk of a shard: its blocks as bytes."""
    bits = np.zeros(CHUNK, np.int64)
    bits[part["block"].to_numpy()] = part["mask"].to_numpy()
    return pd.DataFrame({"length": part["length"].iloc[:1], "chunk": part["chunk"].iloc[:1], "bits": [bits.tobytes()]})


def _filters(vocabulary: DataFrame, passes: int, blocks: dict[int, int], number: int) -> dict[int, np.ndarray]:
    """The shards of one pass, at most MOST_BITS in all and a chunk for each length."""
    found = (vocabulary.select("word").mapInPandas(_entries(passes, blocks, number), "length int, chunk bigint, block bigint, mask bigint")
             .groupBy("length", "chunk", "block").agg(F.bit_or("mask").alias("mask"))
             .groupBy("length", "chunk").applyInPandas(_gather, "length int, chunk bigint, bits binary").collect())
    shards = {n: np.zeros(size, np.uint64) for n, size in blocks.items()}
    for row in found:
        place = shards[row["length"]][row["chunk"] * CHUNK:(row["chunk"] + 1) * CHUNK]
        place[:] = np.frombuffer(row["bits"], np.uint64)[:len(place)]
    return shards


def _probing(shards, passes: int, blocks: dict[int, int], number: int):
    """The edits of each word that the filters of one pass may hold, with the word and its count."""
    def held(h: np.ndarray, n: int) -> np.ndarray:
        if n not in blocks:
            return np.zeros(len(h), bool)
        mask = _mask(h)
        found = (shards.value[n][_block(h, blocks[n])] & mask) == mask
        if passes > 1:
            at = np.flatnonzero(found)
            found[at] = _part(h[at], passes) == number
        return found

    def edits(code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, edited code points) of what the filters hold."""
        n, power = code.shape[1], _powers(code.shape[1])
        terms = _VALUE[code] * power
        whole = terms.sum(axis=1, dtype=np.uint64)
        before = np.cumsum(terms, axis=1, dtype=np.uint64)
        for i in range(n):
            # Left out: what follows moves one place back.  Of a run of one letter only the first.
            rows = np.arange(len(code)) if i == 0 else np.flatnonzero(code[:, i] != code[:, i - 1])
            h = before[rows, i] - terms[rows, i] + (whole[rows] - before[rows, i]) * _BACK
            hit = rows[held(_mix(h), n - 1)]
            if len(hit):
                yield hit, np.delete(code[hit], i, axis=1)
            # Replaced by each later letter of the alphabet.
            change = (_VALUE[_LETTERS][None, :] - _VALUE[code[:, i]][:, None]) * power[i]
            row, letter = np.nonzero(_LETTERS[None, :] > code[:, i][:, None])
            hit = np.flatnonzero(held(_mix(whole[row] + change[row, letter]), n))
            if len(hit):
                made = code[row[hit]].copy()
                made[:, i] = _LETTERS[letter[hit]]
                yield row[hit], made

    def step(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found, counts = part["word"].tolist(), part["n"].to_numpy()
            edit, of = [], []
            for n, at, code in _by_length(found):
                rows = max(1, PROBES // max(n, len(_LETTERS)))
                for a in range(0, len(code), rows):
                    for hit, made in edits(code[a:a + rows]):
                        text, width = made.astype(np.uint32).tobytes().decode("utf-32-le"), made.shape[1]
                        edit += [text[k:k + width] for k in range(0, len(text), width)]
                        of += at[a + hit].tolist()
            yield pd.DataFrame({"edit": edit, "word": [found[k] for k in of], "n": counts[of] if of else np.zeros(0, np.int64)})
    return step


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """word, near, near_n: every ordered pair of words of ``vocabulary`` (word, n) that differ
    by exactly one inserted, deleted or replaced letter of ALPHABET."""
    size = {r["length"]: r["words"] for r in vocabulary.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("words")).collect()}
    passes = max(1, -(-sum(size.values()) * BITS_A_WORD // MOST_BITS))
    blocks = {n: max(1, -(-count * BITS_A_WORD // (64 * passes))) for n, count in size.items()}       # a row a length
    spark, pairs = vocabulary.sparkSession, None
    for number in range(passes):
        shards = spark.sparkContext.broadcast(_filters(vocabulary, passes, blocks, number))           # at most MOST_BITS
        found = vocabulary.mapInPandas(_probing(shards, passes, blocks, number), "edit string, word string, n bigint")
        pairs = found if pairs is None else pairs.unionAll(found)
    pairs = stored(pairs.join(vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit"), "near")
    return pairs.select("word", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")).unionAll(
        pairs.select(F.col("edit").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(links: DataFrame) -> DataFrame:
    """word, root: where the links (word, form) of each word end.  Forms grow in count, so
    there is no cycle; each step doubles how far a pointer goes."""
    to = stored(links.select("word", F.col("form").alias("root")), "roots")
    for _ in range(DOUBLINGS):
        ahead = to.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = stored(to.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        if further.where("_moved").isEmpty():
            return to
        to = further.select("word", "root")
    raise RuntimeError("the forms lead in a circle")


def group(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary."""
    vocabulary = stored(words(docs).where(F.col("n") >= MIN_COUNT), "vocabulary")
    best = neighbours(vocabulary).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("_best"))
    above = -F.col("_best.less") >= RATIO * F.col("n")
    found = stored(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(above, F.col("_best.near")).alias("form"),
        F.when(above, -F.col("_best.less")).alias("form_n")), "forms")
    ends = roots(found.where(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# crc32 is linear in the message's bits: the crc of a message is that of as many zero bytes,
# with the effect of each byte (by value and distance from the end) added by exclusive or.
SQL = r"""
WITH RECURSIVE bits AS (
  SELECT range AS b, range AS v, 0 AS k FROM range(256)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(3988292384::BIGINT, v >> 1) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
runs AS MATERIALIZED (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= 6 GROUP BY 1, 2),
messages AS MATERIALIZED (
  SELECT doc_id, run, c, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS m, octet_length(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS size
  FROM runs),
longest AS (SELECT max(size) AS top FROM messages),
effect AS (
  SELECT range AS b, t[range + 1] AS v, 0 AS k FROM range(256), tab
  UNION ALL SELECT b, xor(t[(v & 255) + 1], v >> 8), k + 1 FROM effect, tab, longest WHERE k < top),
zeros AS (
  SELECT 4294967295::BIGINT AS v, 0 AS k
  UNION ALL SELECT xor(t[(v & 255) + 1], v >> 8), k + 1 FROM zeros, tab, longest WHERE k < top),
hex AS (SELECT m, size, unnest(range(1, size + 1)) AS i, hex(m) AS x FROM (SELECT DISTINCT m, size FROM messages)),
crc AS (
  SELECT hex.m, any_value(hex.size) AS size, bit_xor(effect.v) AS v
  FROM hex JOIN effect ON effect.b = CAST('0x' || x[2 * i - 1:2 * i] AS INTEGER) AND effect.k = hex.size - i GROUP BY 1),
hashed AS (SELECT run, c, xor(xor(crc.v, zeros.v), 4294967295) AS h FROM messages JOIN crc USING (m) JOIN zeros ON zeros.k = crc.size),
misspelt AS (
  SELECT CASE WHEN h % 199 <> 0 THEN run ELSE substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) END AS word, c
  FROM hashed),
voc AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM misspelt WHERE length(word) >= 6 GROUP BY 1 HAVING sum(c) >= 5),
cuts AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM voc)),
pairs AS (
  SELECT a.word AS x, b.word AS y FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, v.word FROM cuts c JOIN voc v ON v.word = c.rest
  UNION SELECT v.word, c.word FROM cuts c JOIN voc v ON v.word = c.rest),
best AS (
  SELECT x AS word, count(*) AS n_near, first(y ORDER BY v.n DESC, encode(y)) AS y, max(v.n) AS near_n
  FROM pairs JOIN voc v ON v.word = y GROUP BY 1),
forms AS MATERIALIZED (
  SELECT voc.word, voc.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * voc.n THEN y END AS form,
    CASE WHEN near_n >= 5 * voc.n THEN near_n END AS form_n
  FROM voc LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS last, form AS next FROM forms
  UNION ALL SELECT walk.word, walk.next, forms.form FROM walk JOIN forms ON forms.word = walk.next)
SELECT forms.word, form, walk.last AS root, n, n_near, form_n FROM forms JOIN walk ON walk.word = forms.word AND walk.next IS NULL
"""
