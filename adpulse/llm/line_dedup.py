"""Line deduplication by distinct-site spread.

A line (trimmed, not blank) that stands on ``MIN_SITES`` different sites or more is
boilerplate.  A HyperLogLog sketch of the sites is kept for each line's hash and
merged by aggregation; lines whose estimate is within ``BAND`` of the threshold get
an exact distinct count.  Boilerplate lines go from every document but the one that
has them first (smallest doc_id, then earliest line), so that no content is lost
altogether and a text mirrored on many sites survives once.

All of it is DataFrame functions.  Only hashes are shuffled for the counts; texts are
shuffled once, as lists of lines.  A line that a third of all documents share is one
row a task after map-side aggregation, and where lines meet the boilerplate list an
adaptive skew join can split it.

Edge cases: a null text stays null, a blank line stays and is never counted; null is
a site of its own; rows equal in doc_id and text are the same document and are
treated alike, null ids come last; other columns pass through untouched, whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import field, stored, with_row_key

MIN_SITES = 6
BAND = 1.0               # about the threshold, in sites, but at least 5 standard errors
SKETCH_BITS = 12         # 1.6 % standard error
BLANKS = " \t\r\x0b\x0c"
LAST_ID = (1 << 63) - 1


def _lines(docs: DataFrame) -> DataFrame:
    """A row for each line that is not blank: its hashes, site and place."""
    line = F.btrim(F.col("_line"), F.lit(BLANKS))
    return (docs.select("_k1", "_k2", F.coalesce("doc_id", F.lit(LAST_ID)).alias("_doc"),
                        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("_site"),
                        F.posexplode(F.split("text", "\n", -1)).alias("_at", "_line"))
            .where(line != "")
            .select("_k1", "_k2", "_doc", "_site", "_at", F.xxhash64(line).alias("_h1"), F.xxhash64(F.lit(1), line).alias("_h2")))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, band: float = BAND) -> DataFrame:
    """Hashes of the lines on ``min_sites`` sites or more, with their first place."""
    band = max(band, 5 * 0.016 * min_sites)
    counted = stored(
        lines.groupBy("_h1", "_h2")
        .agg(F.hll_sketch_agg("_site", F.lit(SKETCH_BITS)).alias("_sketch"), F.count(F.lit(1)).alias("_n"),
             F.min(F.struct("_doc", "_at")).alias("_first"))
        .where(F.col("_n") >= min_sites)                     # fewer occurrences cannot have more sites
        .withColumn("_sites", F.hll_sketch_estimate("_sketch"))
        .where(F.col("_sites") >= min_sites - band)
        .select("_h1", "_h2", "_sites", "_first"), "spread")
    sure = counted.where(F.col("_sites") > min_sites + band).select("_h1", "_h2", "_first")
    near = counted.where(F.col("_sites") <= min_sites + band).select("_h1", "_h2", "_first")
    exact = (lines.select("_h1", "_h2", "_site").distinct().join(near, ["_h1", "_h2"])
             .groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"), F.first("_first").alias("_first"))
             .where(F.col("_n") >= min_sites).select("_h1", "_h2", "_first"))
    return sure.unionAll(exact)


def cleaned(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """_row (the row of ``docs``, with the text without its boilerplate lines), _n_lines and
    _n_removed.  The caller's columns travel inside a struct, so none can clash."""
    rest = F.struct(*[field(c) for c in docs.columns if c != "text"])
    keyed = with_row_key(docs.select("doc_id", "text", "source", rest.alias("_rest")))
    lines = _lines(keyed)
    gone = (lines.join(boilerplate(lines, min_sites), ["_h1", "_h2"])
            .where((F.col("_doc") != F.col("_first._doc")) | (F.col("_at") != F.col("_first._at")))
            .groupBy("_k1", "_k2").agg(F.collect_set("_at").alias("_gone")))
    split = keyed.select("_k1", "_k2", F.split("text", "\n", -1).alias("_lines"), "_rest")
    places = F.sequence(F.lit(0), F.size("_lines") - 1)
    kept = F.transform(F.array_except(places, F.col("_gone")), lambda i: F.get(F.col("_lines"), i))
    text = F.array_join(F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(kept), "\n")
    n_lines = F.size(F.filter(F.col("_lines"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    row = F.struct(*[(text if c == "text" else field(f"_rest.{c}", 1)).alias(c) for c in docs.columns])
    return (split.join(gone, ["_k1", "_k2"], "left")
            .select(row.alias("_row"),
                    F.when(F.col("_lines").isNull(), 0).otherwise(n_lines).cast("long").alias("_n_lines"),
                    F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("_n_removed")))


def clean(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the text without its boilerplate lines, and _n_lines, _n_removed, which
    replace columns of these names."""
    own = [f"_row.{c}" for c in docs.columns if c not in ("_n_lines", "_n_removed")]
    return cleaned(docs, min_sites).select(*[field(c, 1) for c in own], "_n_lines", "_n_removed")


SQL = r"""
WITH l AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS site, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
t AS (SELECT doc_id, site, pos, line, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS body FROM l),
b AS (SELECT body, min((doc_id, pos)) AS first FROM t WHERE body <> '' GROUP BY body HAVING count(DISTINCT site) >= 6),
m AS (SELECT t.*, b.body IS NOT NULL AND (t.doc_id, t.pos) <> b.first AS gone FROM t LEFT JOIN b ON t.body = b.body AND t.body <> '')
SELECT d.doc_id, count(m.body) FILTER (m.body <> '')::BIGINT AS n_lines, count(*) FILTER (m.gone)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(m.line, chr(10) ORDER BY m.pos) FILTER (NOT m.gone), '')) AS kept_sha256
FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id
GROUP BY d.doc_id
"""
