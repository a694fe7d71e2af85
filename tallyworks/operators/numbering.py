"""Dense numbering without a global window.

Rows carry a block (a file split or a partition) and an ordinal that rises within it. Only the
per-block counts, one small row each, are put in order; a row's number is then the offset of
its block plus its place in the block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyworks.workspace import Workspace

# monotonically_increasing_id keeps the partition number above its lower 33 bits
PARTITION_BITS = 33


def block_offsets(blocks: DataFrame, block: str, within: tuple[str, ...] = ()) -> DataFrame:
    """Add ``offset``, the rows (column ``n``) in all earlier blocks.

    The window sorts counts, never rows: its input holds one row per file split.
    """
    order = W.partitionBy(*within).orderBy(block) if within else W.orderBy(block)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    return blocks.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))


def dense_numbers(
    df: DataFrame, space: Workspace, column: str, order: str | None = None, start: int = 1
) -> DataFrame:
    """Number the rows ``start, start + 1, …`` without gaps.

    With ``order``, a column of distinct values, the numbers follow its sort order: a range
    partitioning spreads the values evenly, and each partition sorts only its own share.
    Without it they follow the rows as they lie, and nothing is shuffled.
    """
    if order is not None:
        df = df.repartitionByRange(F.col(order)).sortWithinPartitions(order)
    placed = space.settle(
        df.withColumn("_ordinal", F.monotonically_increasing_id()).withColumn(
            "_block", F.shiftright("_ordinal", PARTITION_BITS)
        ),
        column,
    )
    blocks = placed.groupBy("_block").agg(
        F.count(F.lit(1)).alias("n"), F.min("_ordinal").alias("_first")
    )
    offsets = space.settle(
        block_offsets(blocks, "_block").select("_block", "_first", "offset"), f"{column}-offsets"
    )
    return (
        placed.join(offsets, "_block")
        .withColumn(column, F.col("offset") + F.col("_ordinal") - F.col("_first") + F.lit(start))
        .drop("_block", "_ordinal", "_first", "offset")
    )
