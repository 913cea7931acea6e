"""Tables in versions: whole or not at all, and the same after a repeated run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelkit.session import fresh_path
from panelkit.sources import versions
from panelkit.sources.versions import clean, current, months_of, publish, publish_merged, read_published, unreferenced


def frame(spark, months, value, n=30):
    return spark.createDataFrame([(k, value, dt.date(2024, m, 1)) for m in months for k in range(n)], "id int, v string, month date")


def seen(spark, root):
    return {(r["month"].month, r["v"]): r["n"] for r in read_published(spark, root).groupBy("month", "v").agg(F.count("*").alias("n")).collect()}


def test_partitions_are_replaced_as_a_whole(spark):
    root = fresh_path(spark, "v")
    with pytest.raises(FileNotFoundError):
        read_published(spark, root)
    assert publish(frame(spark, [1, 2, 3], "a"), root, "month", "r1")
    old = read_published(spark, root)
    assert publish(frame(spark, [2, 4], "b"), root, "month", "r2")
    assert seen(spark, root) == {(1, "a"): 30, (2, "b"): 30, (3, "a"): 30, (4, "b"): 30}
    assert old.filter("v = 'b'").count() == 0 and old.count() == 90  # a reader of the version before goes on with it
    assert not publish(frame(spark, [1, 2, 3, 4], "c"), root, "month", "r2")
    assert (2, "c") not in seen(spark, root) and current(spark, root)["runs"] == ["r1", "r2"]
    assert {r["partition"] for r in months_of(spark, root).collect()} == {f"2024-0{m}-01" for m in (1, 2, 3, 4)}
    with pytest.raises(ValueError):
        publish(frame(spark, [1], "d"), root, "v")


@pytest.mark.parametrize("step", ["_write_text", "_swap"])
def test_a_run_that_ends_early_leaves_the_old_version(spark, step, monkeypatch):
    root = fresh_path(spark, "v")
    publish(frame(spark, [1, 2], "a"), root, "month", "r1")

    def lost(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, step, lost)
        with pytest.raises(OSError):
            publish(frame(spark, [1, 2], "b"), root, "month", "r2")
    assert seen(spark, root) == {(1, "a"): 30, (2, "a"): 30} and len(unreferenced(spark, root)) == 1
    assert publish(frame(spark, [1, 2], "b"), root, "month", "r2")  # again
    assert seen(spark, root) == {(1, "b"): 30, (2, "b"): 30}
    assert clean(spark, root, 10 ** 12) == [] and len(unreferenced(spark, root)) == 2
    assert len(clean(spark, root, 0)) == 2 and unreferenced(spark, root) == [] and seen(spark, root) == {(1, "b"): 30, (2, "b"): 30}


def test_a_failing_task_publishes_nothing(spark):
    root = fresh_path(spark, "v")
    publish(frame(spark, [1, 2], "a"), root, "month")
    broken = frame(spark, [1, 2], "b").withColumn("v", F.when(F.col("id") == 29, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception):  # noqa: B017
        publish(broken, root, "month")
    assert seen(spark, root) == {(1, "a"): 30, (2, "a"): 30}


def test_two_writers(spark, monkeypatch):
    root = fresh_path(spark, "v")
    publish(frame(spark, [1], "a"), root, "month")
    real = versions._write_text

    def meanwhile(spark_, path, text):
        real(spark_, path, text)
        if "/manifests/" in path and not meanwhile.done:
            meanwhile.done = True
            publish(frame(spark, [3], "other"), root, "month")

    meanwhile.done = False
    monkeypatch.setattr(versions, "_write_text", meanwhile)
    with pytest.raises(RuntimeError):
        publish(frame(spark, [2], "b"), root, "month")
    assert seen(spark, root) == {(1, "a"): 30, (3, "other"): 30}


def test_merged_rows(spark):
    root = fresh_path(spark, "v")
    assert publish_merged(frame(spark, [1, 2], "a"), root, "month", ["id"], "b0")
    assert publish_merged(frame(spark, [2], "b", 10), root, "month", ["id"], "b1")
    assert not publish_merged(frame(spark, [2], "c"), root, "month", ["id"], "b1")
    assert seen(spark, root) == {(1, "a"): 30, (2, "a"): 20, (2, "b"): 10}
