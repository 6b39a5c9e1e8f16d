"""Session-level helpers shared by operators: table access, shared storage, bounded broadcasts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table `name` under `sf_dir`."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it.

    Only a local master without that setting (tests) gets a folder of its own; a cluster without it
    is refused, as executors would write to disks that the others cannot read.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        folder = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_open: list[list[tuple[SparkSession, str]]] = []


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted with `intermediates()` or when the application ends."""
    path = f"{shared_dir(spark)}/lodestone-{label}-{uuid.uuid4().hex}"
    target, fs = _file_system(spark, path)
    fs.deleteOnExit(target)
    if _open:
        _open[-1].append((spark, path))
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cuts lineage: writes `df` once to the shared folder and returns the written table.

    A lost executor then costs a re-read, not a recomputation of the whole history. The table goes
    at the end of the enclosing `intermediates()`, at the latest when the application ends.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates() -> Iterator[None]:
    """Deletes at its end the tables that `materialize` wrote within; use their results inside."""
    _open.append([])
    try:
        yield
    finally:
        for spark, path in _open.pop():
            target, fs = _file_system(spark, path)
            fs.delete(target, True)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """`df` with a broadcast hint if it holds at most `max_rows` rows, else as it is.

    The count stops after max_rows + 1 rows, so the check itself is bounded.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def sorted_side(df: DataFrame) -> DataFrame:
    """`df` as a side of a join that shuffles and sorts, never broadcast from the size of its files.

    The planner takes a table's size from its files: exploded arrays and repeated texts are many times
    that in rows, and a broadcast would gather them all on the driver.
    """
    return df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer partitions than cores, dealt out over the cores before a costly Python step.

    Larger scans stay as they are and are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
