"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time ``t`` in [0, 1]: its mean weight times
``1 + slope * (2 t - 1)``. The integral over [0, t] is the source's cumulative demand
``target * (t + slope * (t * t - t))``. A document stands at a place in its source's supply, the
documents in the order of a content hash laid end to end, up to ``cap`` times over. Inverting the
demand at that place gives the time at which training reaches the document, and a range sort by
time gives the training order.

Defined cases: a null text has no words and is never taken; a null source is a source, the last;
a source without words has the target 0; rows that repeat each other take places of their own; an
empty table gives no rows; other columns are ignored by ``plan`` and kept by ``train_order``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import content_key, packed, unpacked, whole_text
from tallyworks.workspace import Workspace

WEIGHTS = (1, 2, 3)
#: How each source's weight moves over training time, repeating like the weights.
SLOPES = (0.5, 0.0, -0.5)
CAP = 3
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP,
            slopes: Sequence[float] = SLOPES) -> DataFrame:
    """(source, source_size, target, slope) from (source, source_size), one row for each source.

    Targets are ``min(level * weight, cap * size)`` with the level at which they sum to the whole:
    with sources in order of ``cap * size / weight`` those below the level come first, so running
    sums find it. The windows hold one row for each source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.struct(F.lit(int(w)).alias("weight"), F.lit(float(s)).alias("slope"))
                      for w, s in zip(weights, slopes, strict=True)])
    named = sizes.withColumn("nth", F.row_number().over(by_name)).withColumn(
        "of", F.element_at(cycle, (F.col("nth") - 1) % len(weights) + 1))
    ranked = named.select("source", "source_size", "nth", "of.weight", "of.slope",
                          (F.col("source_size") * cap).alias("most"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "nth")
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = ranked.select(
        "*",
        F.row_number().over(order).alias("place"),
        (F.sum("source_size").over(everything)
         - F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("most")).alias("left"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("sharing"),
    ).withColumn("capped", F.col("left") * F.col("weight") > F.col("most") * F.col("sharing"))
    level = F.min(F.when(~F.col("capped"), F.struct("place", "left", "sharing"))).over(everything)
    return summed.withColumn("level", level).select(
        "source", "source_size",
        F.when(F.col("capped"), F.col("most").cast("double"))
        .otherwise(F.col("weight") * F.col("level.left") / F.col("level.sharing")).alias("target"),
        "slope")


def time_of(done: Column, slope: Column) -> Column:
    """The time at which a share ``done`` of a source's target has been demanded."""
    rest = 1 - slope
    root = F.sqrt(rest * rest + 4 * slope * done)
    return F.when(slope == 0, done).otherwise(2 * done / (rest + root))


def plan(docs: DataFrame, space: Workspace, weights: Sequence[int] = WEIGHTS, cap: int = CAP,
         slopes: Sequence[float] = SLOPES) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and the places taken."""
    planned = _planned(docs, docs["doc_id"].alias("_row"), space, weights, cap, slopes)
    return planned.select(F.col("_row").alias("doc_id"), "size", "source_size", "target", "taken", "places")


def _planned(docs: DataFrame, row: Column, space: Workspace, weights: Sequence[int] = WEIGHTS, cap: int = CAP,
             slopes: Sequence[float] = SLOPES) -> DataFrame:
    """``row`` of each document with size, source_size, target, taken and places.

    ``places`` has (epoch, words, time) for each epoch in which training reads words of the
    document. The last one may be cut where the target ends, so that a source's taken words sum
    to its target, rounded. The running place in a hot source is a sum within range partitions
    plus the partitions' offsets; the rows are written first, so that they keep their order.
    """
    rows = docs.select(
        row, docs["source"].alias("source"),
        F.regexp_count(whole_text(docs), F.lit(WORD)).cast("long").alias("size"),
        content_key(docs).alias("key"), F.monotonically_increasing_id().alias("tie"))
    by = ("source", "key", "tie")
    rows = space.settle(
        rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id()), "mix")
    blocks = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    sources = targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap, slopes)
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("source", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    offsets = space.settle(
        blocks.alias("b").join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
        .select("b.*", "source_size", "target", "slope"), "offsets")
    inside = Window.partitionBy("source", "part").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.withColumn("ran", F.sum("size").over(inside) - F.col("size")).alias("r")
              .join(offsets.alias("o"), F.col("r.source").eqNullSafe(F.col("o.source"))
                    & (F.col("r.part") == F.col("o.part")))
              .select("r.*", "o.offset", "o.source_size", "o.target", "o.slope"))
    start, goal = F.col("offset") + F.col("ran"), F.floor(F.col("target") + 0.5)

    def place(epoch: int) -> Column:
        at = start + epoch * F.col("source_size")
        words = F.greatest(F.least(goal - at, F.col("size")), F.lit(0)).cast("long")
        return F.struct(F.lit(epoch).alias("epoch"), words.alias("words"),
                        time_of(F.least(F.try_divide(at, F.col("target")), F.lit(1.0)), F.col("slope")).alias("time"))

    taken = F.filter(F.array(*[place(e) for e in range(cap)]), lambda p: p["words"] > 0)
    return placed.withColumn("places", taken).select(
        "_row", "size", "source_size", "target",
        F.aggregate("places", F.lit(0).cast("long"), lambda n, p: n + p["words"]).alias("taken"), "places")


def train_order(docs: DataFrame, space: Workspace, **options: object) -> DataFrame:
    """The documents' rows in training order, once for each epoch that reads at least half of one, and at a source's
    start, where nothing else of the source is read, however little that is."""
    planned = _planned(docs, packed(docs), space, **options)
    epochs = planned.select("_row", "size", F.explode("places").alias("place"))
    read = epochs.filter((F.col("place.words") * 2 >= F.col("size")) | (F.col("place.time") == 0))
    return _by_time(read).select(*unpacked(docs))


def _by_time(epochs: DataFrame, *ties: str) -> DataFrame:
    """Places in training order, those of documents that are never read last. ``ties`` deal out places of one time."""
    order = [F.asc_nulls_last("place.time"), *ties]
    return epochs.repartitionByRange(*order).sortWithinPartitions(*order)


def sequence(docs: DataFrame, space: Workspace, **options: object) -> DataFrame:
    """The places of all documents in training order, written: ``row`` (doc_id and the row's own number ``nth``), size,
    source_size, target and ``place``, one row for each epoch that reads words of the document. A document that is never
    read has one row, without a place, after all others."""
    row = F.struct(docs["doc_id"], F.monotonically_increasing_id().alias("nth")).alias("_row")
    planned = _planned(docs, row, space, **options)
    places = planned.select(
        F.col("_row").alias("row"), "size", "source_size", "target", F.explode_outer("places").alias("place"))
    return space.settle(_by_time(places, "row.nth"), "sequence")


def summed_up(places: DataFrame) -> DataFrame:
    """One row per document out of its places in ``sequence``: what ``plan`` says of it, and when it is first read."""
    return places.groupBy("row", "size", "source_size", "target").agg(
        F.coalesce(F.sum("place.words"), F.lit(0)).alias("taken"), F.count("place").cast("int").alias("n_epochs"),
        F.min("place.time").alias("first_time"),
    ).select("row.doc_id", "size", "source_size", "target", "taken", "n_epochs", "first_time")
