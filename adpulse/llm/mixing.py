"""Mixing sources to target weights, by hash-random keys and distributed prefix sums.

Every row gets a random key from a hash of its doc_id.  Within each source rows are
ordered by that key; the key's leading digits deal a source's rows to ``4096``
ranges of equal width, so that a source with a third of all rows is still spread
evenly.  Range totals give each range's offset, a window within the range the rest
of the prefix sum.  A source's budget is its target in whole words: so many whole
epochs, and one more up to the row where the prefix sum reaches what is left, which
gives only its missing words.

All of it is DataFrame functions; reruns give the same rows, whatever the
partitioning, since ties in the key are ordered by size and equal rows are alike.

Edge cases: a null text has size 0; null is a source of its own, the last one; a
source without words has target 0; repeated rows count each for themselves; an empty
table gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import field, size_in_words, stored

WEIGHTS = (3, 1, 2)      # of the sources in code point order, repeating
SHARE = 1.5              # of all sizes, given out in total
MOST = 2                 # times its size that a source or row gives at most
RANGE_DIGITS = 3         # hexadecimal digits of the key that name its range


def _sized(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    key = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    return docs.select(
        "doc_id", size_in_words(F.col("text")).alias("size"),
        F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")).alias("_source"),  # null sorts last
        key.alias("_key"), F.substring(key, 1, RANGE_DIGITS).alias("_range"), *extra)


def source_targets(parts: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """Each source's size and target, from any sums of sizes by source.

    Sources that reach ``most`` times their size stop there, and the excess is shared
    anew by weight: with sources ordered by limit over weight, the level at which the
    rest is shared is the largest of what is left over the weights that are left."""
    sizes = parts.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    ordered = Window.orderBy("_source")          # one row for each source
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(ordered) - 1) % len(weights) + 1)
    by_limit = Window.orderBy("_limit_by_weight", "_source")
    all_ = Window.partitionBy()
    stopped = F.coalesce(F.sum(most * F.col("source_size")).over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    return (sizes.withColumn("_weight", weight)
            .withColumn("_limit_by_weight", most * F.col("source_size") / F.col("_weight"))
            .withColumn("_total", F.sum("source_size").over(all_) * F.lit(float(share)))
            .withColumn("_level", (F.col("_total") - stopped) / rest)
            .withColumn("_level", F.max("_level").over(all_))
            .select("_source", "source_size", F.least((most * F.col("source_size")).cast("double"),
                                                      F.col("_weight") * F.col("_level")).alias("target")))


def _taken(rows: DataFrame) -> DataFrame:
    parts = rows.groupBy("_source", "_range").agg(F.sum("size").alias("_size"))
    targets = source_targets(parts)
    offsets = parts.join(targets, "_source").select(
        "_source", "_range", "source_size", "target",
        F.coalesce(F.sum("_size").over(Window.partitionBy("_source").orderBy("_range")
                                       .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    budget = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    inside = Window.partitionBy("_source", "_range").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return (rows.join(offsets, ["_source", "_range"])
            .withColumn("_epochs", whole.cast("long"))
            .withColumn("_part", F.greatest(F.lit(0), F.least(
                F.col("size"), budget - F.col("_epochs") * F.col("source_size") - before)).cast("long"))
            .withColumn("taken", F.col("_epochs") * F.col("size") + F.col("_part")))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row."""
    rows = stored(_sized(docs), "mix")           # a few numbers for each row
    return _taken(rows).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each row as often as whole epochs take it, and once more if the
    last epoch takes at least half of its words; the columns of ``docs``."""
    kept = F.struct(*map(field, docs.columns)).alias("_row")
    taken = _taken(_sized(docs, (kept,)))
    copies = (F.col("_epochs") + F.when((F.col("_part") > 0) & (2 * F.col("_part") >= F.col("size")), 1).otherwise(0)).cast("int")
    return (taken.where(copies > 0).select("_row", F.explode(F.sequence(F.lit(1), copies)).alias("_copy"))
            .select("_row.*"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('0' || source, '1') AS s, md5('mix:' || coalesce(cast(doc_id AS VARCHAR), 'null')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
src AS (SELECT s, sum(size)::BIGINT AS source_size, [3, 1, 2][((row_number() OVER (ORDER BY s) - 1) % 3 + 1)::INT] AS w
        FROM d GROUP BY s),
lev AS (
  SELECT max((1.5 * (SELECT sum(source_size) FROM src)
              - (SELECT coalesce(sum(2 * b.source_size), 0) FROM src b
                 WHERE (2.0 * b.source_size / b.w, b.s) < (2.0 * a.source_size / a.w, a.s)))
             / (SELECT sum(c.w) FROM src c WHERE (2.0 * c.source_size / c.w, c.s) >= (2.0 * a.source_size / a.w, a.s))) AS v
  FROM src a),
t AS (SELECT s, source_size, least((2 * source_size)::DOUBLE, w * (SELECT v FROM lev))::DOUBLE AS target FROM src),
p AS (
  SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY s ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t USING (s))
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN (budget // source_size) * size
             + greatest(0, least(size, budget - (budget // source_size) * source_size - before)) ELSE 0 END)::BIGINT AS taken
FROM p
"""
