"""Admission of whole log files by their hour.

The hourly run of an hour starts a fixed time after the hour's end and reads the files that
lie in the hour's folder by then; what lands later is never read.  As a stream: a file is
admitted if it was last written by the end of its folder's hour plus ``wait``, whole, or
refused, whole.  Both go out in the same micro-batch, each under the batch's number, so that
a repeated batch replaces its own rows: admitted rows to the table, refused files' rows to a
side table where they can be looked into and admitted by hand."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_file(logs: DataFrame) -> DataFrame:
    """Adds the path and the time of last change of the file that a row comes from."""
    return logs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_landed"))


def folder_hour(file: Column) -> Column:
    """The hour of a file's year=/month=/day=/hour= folder; NULL if there is none."""
    part = lambda name: F.regexp_extract(file, rf"/{name}=(\d+)/", 1)
    return F.try_to_timestamp(F.concat_ws("-", part("year"), part("month"), part("day"), part("hour")), F.lit("yyyy-MM-dd-HH"))


def admitted(wait: str = "2 minutes") -> Column:
    """Whether a row's file had landed when the run of its hour began; a file outside of hour folders is refused."""
    due = folder_hour(F.col("_file")) + F.expr(f"INTERVAL 1 HOUR + INTERVAL {wait}")
    return F.coalesce(F.col("_landed") <= due, F.lit(False))


def admit_into(accepted: str, refused: str, wait: str = "2 minutes") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over a stream of ``with_file`` rows."""
    def run(batch: DataFrame, batch_id: int) -> None:
        judged = batch.withColumn("_admitted", admitted(wait)).persist()
        try:
            for path, rows in ((accepted, judged.where("_admitted")), (refused, judged.where("NOT _admitted"))):
                rows.drop("_admitted").write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")
        finally:
            judged.unpersist()
    return run
