"""Sinks (S6-S20): partitioned writes, idempotent partition replace, scoped
publish, sanitised TSV export, renames.

Writes go through Spark's writers; nothing is collected to the driver (the
reference publishes with one INSERT per collected row).  Replacing partitions
uses dynamic partition overwrite, so re-running a day or a range is idempotent
and touches only the partitions present in the new data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import broadcast_if_bounded
from ..session import shared_folder

PARTS_DAY = ["year", "month", "day"]
PARTS_HOUR = ["year", "month", "day", "hour"]


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "append",
                      compression: str = "snappy") -> None:
    """Partitioned Parquet (partition columns last, as Hive lays them out)."""
    (df.write.mode(mode).option("compression", compression).partitionBy(*partition_cols).parquet(path))


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str, partition_cols: list[str]) -> None:
    """A table without rows, known to the session's catalog by its columns and its folder.
    A table of that name that exists already stays as it is."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} LOCATION '{path}'")


def append_rows(df: DataFrame, name: str) -> None:
    """Rows appended to a table of the catalog, columns matched by name; new partitions
    become known with the insert."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name, overwrite=False)


def register_partitions(spark: SparkSession, name: str) -> None:
    """Partitions whose folders another job wrote become known to the catalog."""
    spark.catalog.recoverPartitions(name)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder."""
    return f"{shared_folder(spark)}/adpulse-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, for a table that several parts of a
    job read: it is computed once, and a lost executor costs no recomputation of it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder wherever Spark's file systems reach."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def replace_partitions(df: DataFrame, path: str, partition_cols: list[str],
                       requested: list[dict] | None = None) -> dict:
    """Replace partitions in one job and return the written row count
    per the ``Observation`` attached to the write (the load audit).

    ``requested`` lists the partitions that the run stands for (a day, or every
    day of a range): those of them that came out without rows are removed, as the
    reference deletes them before it inserts.  Without it only the partitions
    present in ``df`` are replaced."""
    spark = df.sparkSession
    obs = Observation("load_audit")
    name = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in partition_cols])
    (df.observe(obs, F.count(F.lit(1)).alias("rows"), F.collect_set(name).alias("partitions"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
     .partitionBy(*partition_cols).parquet(path))
    made = obs.get
    empty = ["/".join(f"{c}={r[c]}" for c in partition_cols) for r in requested or []]
    for part in sorted(set(empty) - set(made.get("partitions") or [])):
        delete_folder(spark, f"{path.rstrip('/')}/{part}")
    return {"rows": made.get("rows", 0)}


def serving_projection(df: DataFrame, table: str) -> DataFrame:
    """S14 projection: for ``*_daily`` / ``*_hour`` tables drop the partition
    columns and publish ``date`` as ``day``; other tables pass through."""
    if not (table.endswith("daily") or table.endswith("hour")):
        return df
    drop = set(PARTS_DAY) | ({"hour"} if table.endswith("hour") else set())
    cols = [F.col(c) for c in df.columns if c.lower() not in drop and c.lower() != "date"]
    date_cols = [c for c in df.columns if c.lower() == "date"]
    if date_cols:
        cols.append(F.col(date_cols[0]).alias("day"))
    return df.select(*cols)


def scoped_replace(existing: DataFrame, new: DataFrame, in_scope, keep_codes: DataFrame | None = None,
                   code_col: str = "mediacd", keep_if: str = "not_in") -> DataFrame:
    """The serving table after ``DELETE WHERE scope [AND code filter]``
    followed by ``INSERT new``, as a DataFrame to write out (file-backed sink)
    or to hand to a JDBC writer.

    ``keep_if='not_in'``: rows whose code is NOT IN the code list are deleted
    (``mediacd not in (...)``); a NULL in that list makes NOT IN delete nothing,
    as in SQL.  ``keep_if='in'``: only rows whose code is IN the list are deleted.
    """
    scope = in_scope if not isinstance(in_scope, str) else F.expr(in_scope)
    if keep_codes is None:
        kept = existing.where(~scope | scope.isNull())
    else:
        codes = keep_codes.select(F.col(keep_codes.columns[0]).alias("_code"))
        # One row, computed within the plan: does the list hold a NULL?
        null = codes.agg(F.coalesce(F.max(F.col("_code").isNull()), F.lit(False)).alias("_null"))
        known = broadcast_if_bounded(codes.where(F.col("_code").isNotNull()).distinct())
        flagged = existing.join(known, existing[code_col] == F.col("_code"), "left")
        in_list = F.col("_code").isNotNull()
        if keep_if == "not_in":
            flagged = flagged.crossJoin(F.broadcast(null))                     # one row
            deleted = scope & (~in_list) & ~F.col("_null") & existing[code_col].isNotNull()
        else:
            deleted = scope & in_list
        kept = flagged.where(~F.coalesce(deleted, F.lit(False))).drop("_code", "_null")
    return kept.unionByName(new.select(*existing.columns))


def sanitize_for_tsv(df: DataFrame) -> DataFrame:
    """Every column as text, NULL and the literal 'None' as '', tabs,
    newlines, carriage returns and pipes as spaces, double quotes as single
    quotes, runs of whitespace collapsed and ends trimmed."""
    def clean(c):
        t = F.coalesce(F.col(c).cast("string"), F.lit(""))
        t = F.regexp_replace(t, r"[\n\r\t|]", " ")
        t = F.regexp_replace(t, '"', "'")
        t = F.trim(F.regexp_replace(t, r"\s+", " "))
        return F.when(t == "None", F.lit("")).otherwise(t).alias(c)
    return df.select(*[clean(c) for c in df.columns])


def export_tsv(df: DataFrame, path: str) -> None:
    """S19 writer: tab-separated with a header row."""
    sanitize_for_tsv(df).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename opaque metric-id columns through a lookup (unknown ids keep their name)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace a whole (dimension / code) table."""
    df.write.mode("overwrite").parquet(path)
