"""What the corpus operators share: table access, the cluster's shared folder,
row keys that survive nulls and repeats, and map-only passes over texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Texts handed to a Python step at a time, so that a batch of long texts stays small.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that no other column's name can clash with
    the names that an operator uses."""
    return df.select(*names)


def field(name: str, inside: int = 0) -> F.Column:
    """The column of that name, dots and all; the first ``inside`` dots lead into structs."""
    return F.col(".".join("`" + part.replace("`", "``") + "`" for part in name.split(".", inside)))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, and
    a lost executor costs no recomputation of what came before."""
    path = f"{shared_folder(df.sparkSession)}/adpulse-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_key(docs: DataFrame) -> DataFrame:
    """Adds ``_k1``, ``_k2``: never null, equal for rows that agree in doc_id and
    text.  Per-document results are joined back on them, so null ids keep their
    rows and repeated rows neither multiply nor vanish."""
    return docs.withColumns({
        "_k1": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
        "_k2": F.xxhash64(F.col("doc_id").isNull(), F.col("text").isNull(), F.col("text")),
    })


def sampled(df: DataFrame, key: F.Column, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df``, or all if there are fewer: those whose hash of
    ``key`` is below a threshold taken from the row count.  The same rows each time, from
    every part of the table, and no more leave any task than are kept."""
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < int((1 << 40) * rows / total))


def drawn_by_group(df: DataFrame, group: str, key: F.Column, rows: F.Column) -> DataFrame:
    """The different rows of ``df`` with the smallest hashes of ``key`` in each group, about
    twice ``rows`` of them or all if there are fewer, with the hash as ``_h``.  ``rows`` may
    use ``_n``, about how many different hashes the group has; a threshold of the group's
    own follows from it, so a rare group gives as many rows as a frequent one, and no more
    leave any task than are drawn."""
    df = df.withColumn("_h", F.xxhash64(key))
    counts = df.groupBy(group).agg(F.approx_count_distinct("_h").alias("_n"))
    limits = counts.select(F.col(group).alias("_g"), (F.lit(2.0) * rows / F.col("_n") * 2.0 ** 64 - 2.0 ** 63).alias("_limit"))
    return (df.join(F.broadcast(limits), F.col(group) == F.col("_g"))      # one row a group
            .where(F.col("_h").cast("double") <= F.col("_limit")).drop("_g", "_limit").distinct())


def size_in_words(text: F.Column) -> F.Column:
    """Number of words (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_texts(docs: DataFrame, make: Callable[[], Callable[[list], dict]], schema: str,
              keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Map-only pass: ``make()`` runs once for each task and returns a function
    from a list of texts (str or None) to new columns, which are put after the
    ``keep`` columns.  No shuffle; lost tasks are simply run again."""
    out = T.StructType([f for c in keep for f in docs.select(c).schema.fields] + T._parse_datatype_string(schema).fields)
    arrow = _arrow_types(T._parse_datatype_string(schema))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                part = whole.slice(at, SLICE_ROWS)
                made = apply(part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))] + [pa.array(made[n], type=t) for n, t in arrow],
                    names=[*keep, *(n for n, _ in arrow)])

    return docs.select(*keep, F.col("text")).mapInArrow(step, out)


def _arrow_types(schema: T.StructType) -> list[tuple[str, pa.DataType]]:
    simple = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
              "string": pa.string(), "binary": pa.binary()}
    return [(f.name, simple[f.dataType.simpleString()]) for f in schema.fields]
