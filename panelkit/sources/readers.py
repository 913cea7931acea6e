"""Readers: raw text history plus increments, partitioned Parquet, source checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.dates import month_start
from panelkit.sources.schema import text_schema


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system that owns it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def require_source(spark: SparkSession, table: str, paths: Sequence[str]) -> list[str]:
    """The paths of a source that exist; an error when none does."""
    found = [p for p in paths if path_exists(spark, p)]
    if not found:
        raise FileNotFoundError(f"{table}: none of {list(paths)} exists")
    return found


def read_text(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """CSV files with a header, every column as text, history and increments as one table.

    An empty field stays an empty string, as delivered; typing happens in the silver build.
    """
    return (spark.read.schema(text_schema(columns))
            .option("header", "true").option("nullValue", "\u0000").option("emptyValue", "")
            .csv(list(paths)))


def read_catalog(spark: SparkSession, catalog: Mapping[str, tuple[str, Sequence[str]]]) -> dict[str, DataFrame]:
    """One text table per catalog entry ``name -> (folder, columns)``."""
    return {name: read_text(spark, [folder], columns) for name, (folder, columns) in catalog.items()}


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table, with only the named columns read."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def availability(features: DataFrame, labels: DataFrame, feature_date: str, label_date: str, as_of) -> DataFrame:
    """Rows to score on a date, labels maturing on it and distinct labelled months before it: one row."""
    day = F.lit(as_of).cast("date")
    scored = features.agg(F.count(F.when(F.col(feature_date) == day, 1)).alias("n_to_score"))
    matured = labels.agg(
        F.count(F.when(F.col(label_date) == day, 1)).alias("n_new_labels"),
        F.count_distinct(F.when(F.col(label_date) < day, month_start(label_date))).alias("labelled_months"))
    # both sides are one aggregate row
    one = F.lit(1).alias("one")
    return scored.select(one, "*").join(matured.select(one, "*"), "one").drop("one")
