"""Incremental sync of a growing table with a stored high-watermark.

A run extracts the rows above the mark and appends them as one numbered batch; the mark that
the batch reached is written after it, and a batch without its mark does not count.  A run
that dies between the two is repeated by the next one under the same number, so nothing is
lost and nothing appears twice.  The mark is taken from the rows that were written (an
``Observation`` of that write), not from the source read once more."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import versions


def _marks(root: str) -> str:
    return f"{root.rstrip('/')}/marks"


def _batch(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/rows/batch={number}"


def stored_mark(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """(number of the last batch, its mark as text); (0, None) before the first."""
    made = versions.complete(spark, _marks(root))
    if not made:
        return 0, None
    row = spark.read.parquet(made[-1][1]).first()      # one row
    return row["number"], row["mark"]


def run(source: DataFrame, root: str, watermark_col: str, before_mark=None) -> dict:
    """Append the rows of ``source`` above the stored mark; the first run takes all.  A run
    without new rows writes nothing.  ``before_mark`` is called between batch and mark."""
    spark = source.sparkSession
    number, mark = stored_mark(spark, root)
    kind = source.schema[watermark_col].dataType
    new = source if mark is None else source.where(F.col(watermark_col) > F.lit(mark).cast(kind))
    seen = Observation("sync")
    path = _batch(root, number + 1)
    new.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(F.col(watermark_col)).cast("string").alias("mark")).write.mode("overwrite").parquet(path)
    got = seen.get
    if not got["rows"]:
        return {"batch": number, "rows": 0, "mark": mark}
    if before_mark is not None:
        before_mark()
    # Rows without a value of the watermark column come with the first run and have no mark.
    reached = got["mark"] if got["mark"] is not None else mark
    one = spark.range(1).select(F.lit(number + 1).alias("number"), F.lit(reached).cast("string").alias("mark"), F.lit(got["rows"]).cast("long").alias("rows"))
    versions.write(one.coalesce(1), _marks(root), number + 1)
    return {"batch": number + 1, "rows": got["rows"], "mark": reached}


def synced(spark: SparkSession, root: str, batch: int | None = None) -> DataFrame | None:
    """The rows of every batch that counts, or of one; None before the first.  Marks stay,
    one small file a batch, so that the list of batches is the list of marks."""
    numbers = [n for n, _ in versions.complete(spark, _marks(root)) if batch is None or n == batch]
    return spark.read.parquet(*[_batch(root, n) for n in numbers]) if numbers else None
