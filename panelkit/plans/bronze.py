"""Landing of raw snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.sources.readers import read_text, require_source
from panelkit.sources.sinks import fill_partitions, write_partitions


def snapshot_slice(df: DataFrame, day, column: str = "snapshot_date") -> DataFrame:
    """Rows of one snapshot date; a date that does not parse belongs to none."""
    return df.filter(F.col(column).try_cast("date") == F.lit(day).cast("date"))


def land(spark: SparkSession, table: str, paths: Sequence[str], columns: Sequence[str], target: str,
         days: DataFrame | None = None, force: bool = True) -> None:
    """History and increments as text, written by snapshot date in one job.

    ``days`` (one column ``snapshot_date``) limits the landing to those dates; without ``force`` dates already
    landed stay as they are.
    """
    raw = read_text(spark, require_source(spark, table, paths), columns)
    raw = raw.withColumn("snapshot_date", F.col("snapshot_date").try_cast("date"))
    if days is not None:
        raw = raw.join(days.select("snapshot_date").distinct(), "snapshot_date", "left_semi")
    if force:
        write_partitions(raw, target, ["snapshot_date"])
    else:
        fill_partitions(raw, target, "snapshot_date")
