"""Extendible hashing of documents into shards under a byte limit.

A shard is a prefix of a 60-bit content hash. A bucket over the limit is split on one more bit, any
other is left alone, so a document's shard is its shortest prefix whose documents fit the limit.
The sums of all prefixes come from one histogram over prefixes a few bits longer than shards need;
only buckets of the histogram that are still too large look at their documents again, on more bits.

Defined cases: a null text has no bytes; null ids count as an empty text in the hash. Rows that
repeat doc_id and text share all bits: where they exceed the limit together they are dealt by
rank into parts that fit. A single document over the limit has a part of its own. Columns named
like a result are replaced, all others pass.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import content_key, packed, unpacked, whole_text
from tallyworks.workspace import Workspace

BITS = 60
#: Bytes of text that a shard holds at most: what a trainer reads at once.
LIMIT = 1 << 20
#: Bits by which the histogram is finer than shards need on average, and bits of each later look.
FINER, DEEPER = 6, 12


def hashed(docs: DataFrame) -> DataFrame:
    """The rows with ``shard_hash`` and ``shard_size``."""
    hash60 = F.conv(F.substring(content_key(docs), 1, BITS // 4), 16, 10).cast("long")
    return docs.select(packed(docs), hash60.alias("shard_hash"), F.octet_length(whole_text(docs)).cast("long").alias("shard_size"))


def prefix(column: str, bits: Column | int, depth: Column | int) -> Column:
    """The leading ``depth`` bits of a number of ``bits`` bits."""
    return F.call_function("shiftright", F.col(column), F.lit(bits).cast("int") - F.lit(depth).cast("int"))


def directory(rows: DataFrame, space: Workspace, limit: int = LIMIT) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """Tables of (fine, depth, shard_bytes), one for each width of ``fine``, and the full buckets at all bits.

    There is one row for each fine bucket, some ``2 ** FINER`` for each shard; a table is broadcast
    by a later join only where its written size is under the session's threshold.
    """
    found, known, rest, low = [], rows.agg(F.sum("shard_size")).first()[0] or 0, rows, 0
    fine = min(BITS, max(1, math.ceil(math.log2(max(1, known / limit)))) + FINER)
    while True:
        histogram = space.settle(
            rest.groupBy(prefix("shard_hash", BITS, fine).alias("fine")).agg(F.sum("shard_size").alias("bytes")), "fine")
        steps = histogram.select("*", F.explode(F.sequence(F.lit(low), F.lit(fine))).alias("depth"))
        sums = space.settle(
            steps.groupBy("depth", prefix("fine", fine, F.col("depth")).alias("bucket"))
            .agg(F.sum("bytes").alias("shard_bytes")), "sums")
        parents = sums.filter(F.col("shard_bytes") > limit).select(
            (F.col("depth") + 1).alias("depth"), F.col("bucket").alias("parent"))
        fits = sums.filter(F.col("shard_bytes") <= limit).withColumn(
            "parent", F.call_function("shiftright", F.col("bucket"), F.lit(1)))
        leaves = fits.join(parents, ["depth", "parent"], "left_semi").unionByName(
            fits.filter(F.col("depth") == low)).select("depth", "bucket", "shard_bytes")
        leaves = space.settle(leaves.distinct() if low else leaves, "leaves")
        least = leaves.agg(F.min("depth")).first()[0]
        if least is not None:
            ways = histogram.select("fine", F.explode(F.sequence(F.lit(least), F.lit(fine))).alias("depth"))
            ways = ways.withColumn("bucket", prefix("fine", fine, F.col("depth")))
            table = ways.join(leaves, ["depth", "bucket"]).select("fine", "depth", "shard_bytes")
            found.append((fine, space.settle(table, "directory")))
        full = sums.filter((F.col("depth") == fine) & (F.col("shard_bytes") > limit)).select(
            F.col("bucket").alias("fine"), "shard_bytes")
        if full.isEmpty() or fine == BITS:
            return found, full
        rest = rest.join(full.select("fine"), prefix("shard_hash", BITS, fine) == F.col("fine"), "left_semi")
        low, fine = fine + 1, min(BITS, fine + DEEPER)


def assign(docs: DataFrame, space: Workspace, limit: int = LIMIT) -> DataFrame:
    """The frame with n_bytes, shard (depth-prefix-part), depth and shard_bytes; one row per document."""
    rows, columns = hashed(docs), unpacked(docs, "n_bytes", "shard", "depth", "shard_bytes")
    tables, full = directory(rows, space, limit)

    def named(found: DataFrame, part: Column) -> DataFrame:
        bucket = prefix("shard_hash", BITS, F.col("depth"))
        return found.select(
            *columns, F.col("shard_size").alias("n_bytes"),
            F.concat_ws("-", F.col("depth"), bucket, part).alias("shard"), F.col("depth").cast("int").alias("depth"),
            F.col("shard_bytes").cast("long").alias("shard_bytes"))

    parts = [named(rows.join(table, prefix("shard_hash", BITS, fine) == F.col("fine")), F.lit(0))
             for fine, table in tables]
    if not full.isEmpty():
        parts.append(named(_parts(rows, full, space, limit), F.col("part")))
    if not parts:
        return named(rows.withColumns({"depth": F.lit(0), "shard_bytes": F.lit(0)}).filter(F.lit(False)), F.lit(0))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _parts(rows: DataFrame, full: DataFrame, space: Workspace, limit: int) -> DataFrame:
    """Rows that share all bits, by rank: a rank within each partition plus the ranks before it."""
    same = rows.join(full.select("fine"), F.col("shard_hash") == F.col("fine"), "left_semi")
    same = space.settle(same.withColumn("tie", F.monotonically_increasing_id()), "same").withColumn(
        "from", F.call_function("shiftright", F.col("tie"), F.lit(33)))
    counts = same.groupBy("shard_hash", "from").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard_hash").orderBy("from").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard_hash", "from", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard_hash", "from").orderBy("tie")
    ranked = same.withColumn("nth", F.row_number().over(inside) - 1).join(counts, ["shard_hash", "from"])
    each = F.greatest(F.floor(F.lit(limit) / F.col("shard_size")), F.lit(1))
    dealt = ranked.withColumn("part", F.floor((F.col("nth") + F.col("offset")) / each).cast("long"))
    held = dealt.groupBy("shard_hash", "part").agg(F.sum("shard_size").alias("shard_bytes"))
    return dealt.join(held, ["shard_hash", "part"]).withColumn("depth", F.lit(BITS))


def write_shards(docs: DataFrame, path: str, space: Workspace, limit: int = LIMIT) -> None:
    """Write each shard below a folder of its own name."""
    sharded = assign(docs, space, limit)
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)
