"""Partitioned tables in versions: a pointer names the version that readers see, and is swapped when a write is whole."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.session import materialize
from panelkit.sources.readers import path_exists

POINTER = "CURRENT"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path, in Hadoop's terms."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _read_text(spark: SparkSession, path: str) -> str:
    system, hadoop = _files(spark, path)
    stream = system.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    system, hadoop = _files(spark, path)
    stream = system.create(hadoop, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _swap(spark: SparkSession, new: str, old: str) -> None:
    """Rename a file over another in one step."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    overwrite = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    kinds = gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    kinds[0] = overwrite
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    qualified = _files(spark, old)[0].makeQualified(path(old))
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration()).rename(
        _files(spark, new)[0].makeQualified(path(new)), qualified, kinds)


def current(spark: SparkSession, root: str) -> dict:
    """The manifest in force: ``version``, ``by``, ``parts`` (partition folder -> version folder) and ``runs`` that are in it."""
    pointer = f"{root}/{POINTER}"
    if not path_exists(spark, pointer):
        return {"version": None, "by": None, "parts": {}, "runs": []}
    return json.loads(_read_text(spark, f"{root}/manifests/{_read_text(spark, pointer).strip()}.json"))


def publish(df: DataFrame, root: str, by: str, run: str | None = None, remembered: int = 1000) -> bool:
    """Replace the partitions present in ``df`` (of the column ``by``) and leave the others, all at once for readers.

    Files go to a folder of their own first; then a manifest that lists the folder of every partition is written, and
    last the pointer is renamed over the old one. Until that rename readers see the version before, and a run that ends
    anywhere earlier leaves only files that nothing refers to (see ``clean``). A ``run`` that is in the manifest already is not
    published again, so a repeated run changes nothing: False is returned. The manifest keeps the last ``remembered`` runs. One
    writer at a time: if the pointer moved meanwhile the new version is not published and an error raised.
    """
    spark = df.sparkSession
    before = current(spark, root)
    if run is not None and run in before["runs"]:
        return False
    if before["by"] not in (None, by):
        raise ValueError(f"the table is partitioned by {before['by']}")
    version = uuid.uuid4().hex
    folder = f"{root}/data/version={version}"
    df.hint("rebalance", by).write.partitionBy(by).parquet(folder)
    system, hadoop = _files(spark, folder)
    written = [s.getPath().getName() for s in system.listStatus(hadoop) if s.isDirectory()]  # one a partition
    manifest = {"version": version, "by": by, "parts": before["parts"] | {p: version for p in written},
                "runs": (before["runs"] + [run] if run is not None else before["runs"])[-remembered:]}
    _write_text(spark, f"{root}/manifests/{version}.json", json.dumps(manifest))
    if current(spark, root)["version"] != before["version"]:
        raise RuntimeError("another writer published meanwhile")
    _write_text(spark, f"{root}/{POINTER}.{version}", version)
    _swap(spark, f"{root}/{POINTER}.{version}", f"{root}/{POINTER}")
    return True


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The table as of the version in force when this is called; a later publish doesn't change it."""
    told = current(spark, root)
    if not told["parts"]:
        raise FileNotFoundError(f"nothing is published at {root}")
    paths = [f"{root}/data/version={version}/{part}" for part, version in sorted(told["parts"].items())]
    return spark.read.option("basePath", f"{root}/data").option("mergeSchema", "true").parquet(*paths).drop("version")


def publish_merged(df: DataFrame, root: str, by: str, key: Sequence[str], run: str | None = None) -> bool:
    """Publish the partitions of ``df`` with the rows that were there and whose ``key`` it doesn't hold."""
    spark = df.sparkSession
    if run is not None and run in current(spark, root)["runs"]:
        return False
    if current(spark, root)["parts"]:
        df = materialize(df, "delivered")
        landed = read_published(spark, root).join(df.select(by).distinct(), by, "left_semi")
        df = df.unionByName(landed.join(df.select(by, *key), [by, *key], "left_anti"), allowMissingColumns=True)
    return publish(df, root, by, run)


def unreferenced(spark: SparkSession, root: str) -> list[str]:
    """Version folders that the manifest in force doesn't refer to: left over, or replaced since."""
    used = {f"version={v}" for v in current(spark, root)["parts"].values()}
    if not path_exists(spark, f"{root}/data"):
        return []
    system, hadoop = _files(spark, f"{root}/data")
    return sorted(f"{root}/data/{n}" for n in (s.getPath().getName() for s in system.listStatus(hadoop)) if n not in used)


def clean(spark: SparkSession, root: str, keep_ms: int = 7 * 86_400_000) -> list[str]:
    """Delete folders that are not referred to and older than ``keep_ms``, so that running readers of older versions end in peace."""
    now, gone = spark._jvm.java.lang.System.currentTimeMillis(), []
    for path in unreferenced(spark, root):
        system, hadoop = _files(spark, path)
        if now - system.getFileStatus(hadoop).getModificationTime() >= keep_ms:
            system.delete(hadoop, True)
            gone.append(path)
    return gone


def months_of(spark: SparkSession, root: str) -> DataFrame:
    """Partitions of the table in force and the version that holds each."""
    told = current(spark, root)
    rows = [(p.split("=", 1)[1], v) for p, v in sorted(told["parts"].items())]
    return spark.createDataFrame(rows, "partition string, version string").withColumn("by", F.lit(told["by"]))
