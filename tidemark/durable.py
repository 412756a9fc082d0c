"""Lineage cuts and scratch space that survive the loss of an executor."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A frame of at most this many narrow rows (days, bucket edges, per-slice
# totals) is a few MB once serialised.
BROADCAST_ROWS = 100_000
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session, where the executors are this machine, may fall
    back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written to yet, under the shared folder."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs run inside are deleted as each job's query ends.

    Else they stay until the driver happens to collect its garbage, and those of
    many writes in a row add up on the executors' disks.
    """
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder, once, and go on from what was written.

    Cuts the lineage like a checkpoint does, but the copy is columnar and its
    size is known to later joins. Nothing reads the shuffles behind it any more, so they go.
    """
    path = scratch_path(df.sparkSession, "durable")
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was written under ``path``, in whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Written intermediate frames by name, deleted as soon as they are replaced, dropped or left behind.

    Drop a frame only after all that is computed from it has been written itself.
    Leaving the ``with`` block, by an error or not, deletes all that is left; ``keep`` takes a frame out of that.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths, self.frames = spark, {}, {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop(*list(self.paths))

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df``; a frame put under the same name before, which ``df`` may read, is deleted then."""
        path = scratch_path(self.spark, name)
        try:
            with shuffles_freed(self.spark):
                df.write.parquet(path)
        except BaseException:
            remove(self.spark, path)
            raise
        self.drop(name)
        self.paths[name] = path
        self.frames[name] = self.spark.read.schema(df.schema).parquet(path)
        return self.frames[name]

    def read(self, name: str) -> DataFrame:
        return self.frames[name]

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                remove(self.spark, self.paths.pop(name))

    def keep(self, name: str) -> None:
        self.paths.pop(name)


def broadcast_within(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint ``df`` for broadcast only if it is counted to hold at most ``max_rows``.

    Beyond that the frame is returned without a hint, so that the join shuffles
    and adaptive execution may split skewed partitions. Pass a materialised
    (``durable``) frame: it is counted here and read again by the join.
    """
    return F.broadcast(df) if df.count() <= max_rows else df
