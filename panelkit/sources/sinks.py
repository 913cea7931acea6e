"""Sinks: partitioned overwrite, fill-in of missing partitions, append-only events, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.sources.readers import path_exists


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a whole table."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(path)


def write_partitions(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in the frame, all in one job.

    The rebalance hint lets adaptive execution give a large partition several files and pack small ones,
    so one month holding a third of the rows does not become one task.
    """
    writer = (df.hint("rebalance", *by).write.mode("overwrite").format(fmt)
              .option("partitionOverwriteMode", "dynamic").partitionBy(*by))
    (writer.option("header", "true") if fmt == "csv" else writer).save(path)


def fill_partitions(df: DataFrame, path: str, by: str, force: bool = False) -> None:
    """Write only partitions the table does not hold yet; with ``force`` replace them."""
    spark = df.sparkSession
    if not force and path_exists(spark, path):
        present = spark.read.parquet(path).select(F.col(by).alias("__present")).distinct()
        df = df.join(present, F.col(by).eqNullSafe(F.col("__present")), "left_anti")  # the null partition is one of them
    write_partitions(df, path, [by])


def event_row(df: DataFrame, as_of: str, event: str, logged_at: str) -> DataFrame:
    """Audit rows: nested fields as JSON, everything as text."""
    base = ["as_of_date", "event", "logged_at"]
    nested = (T.StructType, T.MapType, T.ArrayType)
    named = df.withColumns({"as_of_date": F.col(as_of), "event": F.col(event), "logged_at": F.col(logged_at)})
    rest = [f for f in df.schema.fields if f.name not in {as_of, event, logged_at, *base}]
    return named.select(
        *[F.col(c).cast("string").alias(c) for c in base],
        *[(F.to_json(f.name) if isinstance(f.dataType, nested) else F.col(f.name).cast("string")).alias(f.name)
          for f in rest])


def append_events(df: DataFrame, path: str) -> None:
    """Append to an event log; rows already written are never touched."""
    df.write.mode("append").parquet(path)


def write_report(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Ordered CSV with a header."""
    df.orderBy(*order).write.mode("overwrite").option("header", "true").csv(path)
