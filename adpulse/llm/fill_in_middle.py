"""Fill-in-middle transformation of documents, with a learned rank index for the cuts.

A text's tokens are its runs of ASCII letters and its other code points.  The offsets of
all their boundaries are covered by line segments, each within ``error`` code points of
every boundary it covers; what a line misses is stored as one signed byte a boundary.  A
cut after k tokens is predicted by the segment that covers rank k and set right by the
stored residual, so it is exact (``RankIndex``).

The cuts and the form follow from a hash of the seed and doc_id, so reruns agree.  A text
that holds one of the markers, and an empty one, stays as it is, as does a share of all.
``restore`` rebuilds the text from output and form alone: the parts hold no marker, and no
marker can arise across a seam, as none begins with the end of another.

Edge cases: a null text is empty; a null doc_id counts as an empty number in the hash;
repeated rows are transformed alike, each on its own.  One map-only pass over whole texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, columns

SEED = 1
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TRANSFORMED = 90          # of 100 documents
SUFFIX_FIRST = 20         # of 100 transformed ones
ERROR = 126               # code points that a segment may be off, so that a residual is one byte
WINDOW = 256              # boundaries that a segment is first tried on


class RankIndex:
    """Offsets of sorted boundaries by rank: segments (first rank, its offset, slope) and
    one byte of residual for each boundary."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        assert 0 < error <= ERROR
        n, at = len(offsets), 0
        first, slopes = [], []
        while at < n:
            end, slope = _segment(offsets, at, error)
            first.append(at)
            slopes.append(slope)
            at = end
        self.first = np.array(first, np.int64)
        self.base = offsets[self.first] if n else np.zeros(0, np.int64)
        self.slope = np.array(slopes)
        covers = np.diff(self.first, append=n)
        ranks = np.arange(n)
        line = np.repeat(self.base, covers) + np.rint(np.repeat(self.slope, covers) * (ranks - np.repeat(self.first, covers)))
        self.residual = (offsets - line.astype(np.int64)).astype(np.int8)

    def predict(self, rank: int) -> int:
        s = int(np.searchsorted(self.first, rank, "right")) - 1
        return int(self.base[s]) + int(np.rint(self.slope[s] * (rank - self.first[s])))

    def offset(self, rank: int) -> int:
        return self.predict(rank) + int(self.residual[rank])


def _segment(offsets: np.ndarray, at: int, error: int) -> tuple[int, float]:
    """The longest segment from boundary ``at`` on, through it, that stays within ``error``
    of all it covers: where it ends, and its slope."""
    n, lo, hi, done, window = len(offsets), -np.inf, np.inf, at + 1, WINDOW
    while done < n:
        stop = min(n, done + window)
        run = np.arange(done - at, stop - at)
        rise = offsets[done:stop] - offsets[at]
        low = np.maximum(np.maximum.accumulate((rise - error) / run), lo)
        high = np.minimum(np.minimum.accumulate((rise + error) / run), hi)
        bad = np.flatnonzero(low > high)
        if len(bad):
            k = int(bad[0])
            if k:
                lo, hi = low[k - 1], high[k - 1]
            return done + k, 0.0 if done + k == at + 1 else float((lo + hi) / 2)
        lo, hi, done, window = low[-1], high[-1], stop, window * 2
    return n, 0.0 if n == at + 1 else float((lo + hi) / 2)


def boundaries(text: str) -> np.ndarray:
    """Offsets (code points) of the start of the text and of the end of each of its tokens."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((code | 32) >= 97) & ((code | 32) <= 122)
    ends = np.ones(len(code), bool)
    ends[:-1] = ~(letter[:-1] & letter[1:])
    return np.append(0, np.flatnonzero(ends) + 1).astype(np.int64)


def transform_text(doc_id: int | None, text: str, seed: int = SEED) -> dict:
    """The transformed text with its form, lengths and index size."""
    offsets = boundaries(text)
    n = len(offsets) - 1
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))
    if not text or h3 % 100 >= TRANSFORMED or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None, "n_segments": 0, "output": text}
    index = RankIndex(offsets)
    a, b = (index.offset(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    if h4 % 100 < SUFFIX_FIRST:
        form, output = "spm", SUFFIX + text[b:] + PREFIX + text[:a] + MIDDLE + text[a:b]
    else:
        form, output = "psm", PREFIX + text[:a] + SUFFIX + text[b:] + MIDDLE + text[a:b]
    return {"n": n, "form": form, "prefix_chars": a, "middle_chars": b - a, "n_segments": len(index.first), "output": output}


_FIELDS = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
           ("n_segments", pa.int64()), ("output", pa.string())]


def transform(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, n_segments and output of every row."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                part = whole.slice(at, SLICE_ROWS)
                made = [transform_text(i, t or "", seed) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0)] + [pa.array([m[k] for m in made], t) for k, t in _FIELDS],
                                                 names=["doc_id", *(k for k, _ in _FIELDS)])

    rows = columns(docs, F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(step, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, n_segments bigint, output string")


def restore(output: F.Column, form: F.Column) -> F.Column:
    """The original text, from output and form alone."""
    def part(after: str | None, before: str | None) -> F.Column:
        begin = F.locate(after, output) + len(after)
        return F.substring(output, begin, F.length(output) if before is None else F.locate(before, output) - begin)

    return (F.when(form == "psm", F.concat(part(PREFIX, SUFFIX), part(MIDDLE, None), part(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(part(PREFIX, MIDDLE), part(MIDDLE, None), part(SUFFIX, PREFIX)))
            .otherwise(output))


def digest(made: DataFrame) -> DataFrame:
    """The transformed rows with hashes in place of the texts."""
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
e AS (
  SELECT doc_id, t, w, len(w)::BIGINT AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d),
f AS (
  SELECT doc_id, t, w, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM e),
g AS (
  SELECT doc_id, t, n, form, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:], '') AS s
  FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
         ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM g
"""
