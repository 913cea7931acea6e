"""Incremental landing of monthly files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import materialize
from panelkit.sources.readers import path_exists
from panelkit.sources.schema import enforce, text_schema
from panelkit.sources.sinks import write_partitions
from panelkit.sources.versions import publish_merged


def land_new_files(spark: SparkSession, source: str, columns: Sequence[str], types: Mapping[str, str], target: str,
                   checkpoint: str, key: Sequence[str], date: str = "snapshot_date", versioned: bool = False) -> None:
    """Read files not seen before and merge them into the months they deliver.

    The stream's checkpoint remembers processed files, so a restart after a lost driver goes on where it stopped.
    A delivered row replaces the landed row of its key; other landed rows of the month stay. Replaying a batch, or a file
    delivered again, therefore changes nothing. Only delivered months are read and rewritten. Of several rows of a key in one
    delivery the one from the latest file stays, of equal times the greatest file name, in one file the greatest row.
    Rows whose date can't be read go as text, with their file, to the table ``<target>_rejected``, in a partition for each
    batch, so a replayed batch replaces its own. ``versioned``: the target is a table in versions (see ``publish``), whose readers
    see a delivery as a whole or not at all; a batch that was published is not published again.
    """
    names = list(columns)

    def merge(batch: DataFrame, batch_id: int) -> None:
        typed = materialize(enforce(batch.withColumn("__raw", F.struct(*names)), types), "batch")
        bad = typed.filter(F.col(date).isNull()).select("__raw.*", F.col("__file").alias("source_file"), F.lit(batch_id).alias("batch_id"))
        if bad.limit(1).count():
            write_partitions(bad, f"{target.rstrip('/')}_rejected", ["batch_id"])
        rest = [c for c in names if c not in (date, *key)]
        row = F.struct(*rest) if rest else F.struct(F.lit(1).alias("__none"))
        newest = F.max_by(row, F.struct("__time", "__file", row))
        new = (typed.filter(F.col(date).isNotNull()).groupBy(date, *key).agg(newest.alias("__row"))
               .select(date, *key, *[F.col(f"__row.{c}") for c in rest]).select(*names))
        if versioned:
            publish_merged(new, target, date, key, f"{checkpoint}#{batch_id}")
            return
        if path_exists(spark, target):
            new = materialize(new, "latest")
            months = new.select(date).distinct()
            landed = spark.read.schema(new.schema).parquet(target).join(months, date, "left_semi")
            kept = landed.join(new.select(date, *key), [date, *key], "left_anti")
            new = materialize(new.unionByName(kept), "merged")  # written before its own partitions are replaced
        write_partitions(new, target, [date])

    stream = (spark.readStream.schema(text_schema(columns)).option("header", "true")
              .option("recursiveFileLookup", "true").csv(source)
              .select("*", F.col("_metadata.file_modification_time").alias("__time"), F.col("_metadata.file_path").alias("__file")))
    (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
