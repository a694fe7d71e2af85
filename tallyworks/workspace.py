"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one on a local master only."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="/tmp/run-")


@contextmanager
def own_shuffles(spark: SparkSession) -> Iterator[None]:
    """Each query that runs meanwhile removes its shuffle files when it ends. Else they stay until the driver's memory
    is next collected, and those of a large job add up on every disk. A DataFrame run again makes them anew."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Workspace:
    """A folder of written intermediate tables.

    ``settle`` writes a DataFrame and reads it back. That cuts its lineage in a way that
    survives lost executors, freezes values such as line ordinals that a second evaluation
    could number differently, and gives the planner the true size: a following join then
    broadcasts only a table that is known to be small and sort-merges any other.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{(root or shared_folder(spark)).rstrip('/')}/tallyworks-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def inner(self) -> Workspace:
        """A workspace inside this one, for tables that are dropped sooner."""
        return Workspace(self.spark, self.root)

    def settle(self, df: DataFrame, name: str, dictionary: bool = True, compact: bool | None = None) -> DataFrame:
        """``dictionary=False`` where most values of a row differ from those of others, as in rows read from text:
        looking for repeated values then costs more, to write and to read, than the space it saves. Such rows, and others
        that are ``compact``, are compressed by zstd, to nearly half of what they take otherwise, in the same time."""
        path = self.path(name)
        writer = df.write.option("parquet.enable.dictionary", str(dictionary).lower())
        if not dictionary if compact is None else compact:
            writer = writer.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1")
        with own_shuffles(self.spark):
            writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete this workspace's own folder."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.root)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        folder.getFileSystem(conf).delete(folder, True)
