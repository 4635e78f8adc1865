"""Tables kept as numbered versions in a folder, of which only complete ones count.

A version is a folder ``v<number>`` that a finished write has marked; a half-written one is
never seen, and the next write of the same number replaces it.  Whoever lists the folder
sees the newest complete version or the one before it, nothing in between."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .tables import delete_folder

_NAME = re.compile(r"^v(\d{10})$")


def complete(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, path) of the complete versions, oldest first.  Only a missing folder means
    that there are none; any other error is raised."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    found = []
    for entry in fs.listStatus(base):
        m = _NAME.match(entry.getPath().getName())
        if m and fs.exists(jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")):
            found.append((int(m[1]), entry.getPath().toString()))
    return sorted(found)


def write(df: DataFrame, root: str, number: int) -> str:
    """Write ``df`` as version ``number``; a half-written one of that number is replaced."""
    path = f"{root.rstrip('/')}/v{number:010d}"
    df.write.mode("overwrite").parquet(path)
    return path


def drop_old(spark: SparkSession, root: str, keep: int) -> None:
    """Remove all but the newest ``keep`` complete versions."""
    for _, path in complete(spark, root)[:-keep]:
        delete_folder(spark, path)
