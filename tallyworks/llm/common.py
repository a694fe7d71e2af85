"""What the operators share: reading tables, columns added to any frame, numpy at the Arrow border."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of one Arrow batch; a batch of very long texts stays within a worker's memory.
BATCH_BYTES = 2 << 20


class Remembered(dict):
    """Results of a pure function by argument, at most about twice ``REMEMBERED``: what is asked again moves to
    the younger half, and the older half is dropped when the younger one is full."""

    REMEMBERED = 1 << 17

    def __init__(self, function: Callable):
        super().__init__()
        self.function, self.older = function, {}

    def __missing__(self, key: object) -> object:
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(self) >= self.REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once, unless the session already says how."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(BATCH_BYTES))



def packed(docs: DataFrame) -> Column:
    """All columns as one, so that none can clash with an operator's own."""
    return F.struct(*[docs[c] for c in docs.columns]).alias("_row")


def unpacked(docs: DataFrame, *made: str) -> list[Column]:
    """The columns of ``docs`` out of ``_row``, without those that the operator makes."""
    return [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in made]


def whole_text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def content_key(docs: DataFrame) -> Column:
    """16 hex digits of a hash over doc_id and text; equal only for rows that repeat both."""
    said = F.concat_ws("|", F.coalesce(docs["doc_id"].cast("string"), F.lit("")), whole_text(docs))
    return F.substring(F.md5(said), 1, 16)
