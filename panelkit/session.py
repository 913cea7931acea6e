"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "panelkit", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf) -> SparkSession:
    """Session with adaptive execution on; on a cluster leave master and partitions to spark-submit."""
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="panelkit-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/panelkit/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table", group_bytes: int | None = None) -> DataFrame:
    """Write once and read back: lineage is cut, a lost executor re-reads files, and the
    planner knows the real size, so it decides by itself whether the table may be broadcast. ``group_bytes`` bounds the row groups of tables with long values."""
    path = fresh_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    (writer.option("parquet.block.size", group_bytes) if group_bytes else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
