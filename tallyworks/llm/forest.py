"""A forest of sorted prefix tries over MinHash signatures.

Each tree's trie is the sorted order of the nodes' paths (the tree, then LABELS minima of 16 bits each): nodes below one
trie vertex stand side by side, and what neighbours share is how deep they meet. One sort over all trees finds
how deep each node meets another one. Prefixes start at full length and are shortened, for each class of set sizes, until
the estimated share of matching nodes that were found is RECALL: nodes seen in one tree only and those seen in two tell how
many were seen in none (Chao's estimate, counted upwards where evidence is thin). No prefix needs to be shorter than the
depth at which a link of the least possible similarity is met with that probability, whatever the estimate says.

Equal paths are one row before the sort, so a large group of close texts doesn't meet in one task; neighbours
across the ends of sorted partitions are found from each partition's first and last row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.shingles import Permutations, mixed
from tallyworks.workspace import Workspace

RECALL = 0.999
TREES, LABELS = 24, 8
#: Bytes of a path.
WIDTH = 1 + 2 * LABELS
#: Set sizes from which a link may have any similarity close to the threshold.
LARGE = 64


def least_similarity(size: int, threshold: float) -> float:
    """The least Jaccard similarity at or over the threshold that a set of this size can have."""
    if size >= LARGE:
        return threshold
    values = [shared / (size + other - shared)
              for other in range(1, 2 * size + 1) for shared in range(1, min(size, other) + 1)]
    return min(v for v in values if v >= threshold - 1e-9)


def depth_for(similarity: float, trees: int = TREES, labels: int = LABELS, recall: float = RECALL) -> int:
    """The longest prefix with which links of this similarity are met often enough."""
    depth = labels
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def size_class(size: Column) -> Column:
    """Sizes below LARGE are classes of their own, the others are classed by doubling."""
    above = LARGE + F.floor(F.log2(size / F.lit(LARGE)) + 1e-9)
    return F.when(size < LARGE, size).otherwise(above).cast("int")


def paths(shingles: np.ndarray, number: np.ndarray, sizes: np.ndarray, threshold: float) -> list[list[bytes]]:
    """Each text's path in each tree."""
    labels = mixed(Permutations(TREES * LABELS, 1).minima(shingles, number).astype(np.uint64))
    out = np.empty((len(labels), TREES, WIDTH), np.uint8)
    out[:, :, 0] = np.arange(TREES, dtype=np.uint8)
    out[:, :, 1:] = labels.astype(np.uint16).view(np.uint8).reshape(len(labels), TREES, WIDTH - 1)
    whole = out.tobytes()
    made = [whole[k:k + WIDTH] for k in range(0, len(whole), WIDTH)]
    return [made[k:k + TREES] for k in range(0, len(made), TREES)]


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH)


def shared_labels(rows: np.ndarray) -> np.ndarray:
    """How many labels each path shares with the one before it; none for the first."""
    differs = rows[1:] != rows[:-1]
    at = np.where(differs.any(axis=1), differs.argmax(axis=1), WIDTH)
    return np.concatenate([np.zeros(min(len(rows), 1), np.int64), np.maximum(at - 1, 0) // 2])


def meeting(rows: DataFrame, least_depth: int) -> DataFrame:
    """(path, class, least, shared) of those sorted (path, class, least, many) that meet another one at this depth, and
    of the ends of each partition, whose neighbour another task holds."""
    ordered = rows.select("path", "class", "least", "many").repartitionByRange("path").sortWithinPartitions("path", "class")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, first = None, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if held is None else pa.concat_batches([held, batch])
            with_last = shared_labels(matrix(whole.column(0)))
            with_last[0] = before
            most = np.maximum(with_last[:-1], with_last[1:])
            yield kept(whole.slice(0, whole.num_rows - 1), most, first)
            first = first and whole.num_rows == 1
            held, before = whole.slice(whole.num_rows - 1), int(with_last[-1])
        if held is not None:
            yield kept(held, np.array([before]), True)

    def kept(batch: pa.RecordBatch, most: np.ndarray, end: bool) -> pa.RecordBatch:
        most = np.where(np.array(batch.column(3).to_pylist(), bool), LABELS, most)
        chosen = most >= least_depth
        chosen[:1] |= end
        arrays = [*batch.columns[:3], pa.array(most, pa.int32())]
        return pa.RecordBatch.from_arrays(arrays, names=["path", "class", "least", "shared"]).filter(pa.array(chosen, pa.bool_()))

    return ordered.mapInArrow(work, "path binary, class int, least binary, shared int")


def estimated_recall(seen: int, once: int, twice: int) -> float:
    """The share of matching nodes that were seen, from how many were seen in one tree only and in two."""
    return seen / (seen + (once + 1) ** 2 / (2 * (twice + 1)))


def shortened(counts: dict[int, tuple[int, int, int]], floor: int) -> int:
    """Shorten the prefix from all labels until the recall estimated from (seen, once, twice) is met, at most to ``floor``."""
    depth = LABELS
    while depth > floor and estimated_recall(*counts[depth]) < RECALL:
        depth -= 1
    return depth


def class_depths(hits: DataFrame, threshold: float) -> dict[int, int]:
    """The depth of each size class, from (node, class, shared) for each tree in which a node meets another one."""
    levels = range(depth_for(threshold), LABELS + 1)
    seen = hits.groupBy("class", "node").agg(*[F.count_if(F.col("shared") >= d).alias(f"in{d}") for d in levels])
    kinds = {"seen": ">= 1", "once": "= 1", "twice": "= 2"}
    counted = seen.groupBy("class").agg(
        *[F.count_if(F.expr(f"in{d} {test}")).alias(f"{kind}{d}") for d in levels for kind, test in kinds.items()])
    # one row for each of at most 100 classes
    return {r["class"]: shortened({d: tuple(r[f"{kind}{d}"] for kind in kinds) for d in levels},
                                  depth_for(least_similarity(r["class"], threshold)))
            for r in counted.collect()}


def runs(found: DataFrame, depths: dict[int, int]) -> DataFrame:
    """(level, path, a, b): edges from each of the meeting rows to the first one below the same vertex, without path;
    and the first and last row of each partition, without b. Two rows meet at the deeper of their depths."""
    ordered = found.repartitionByRange("path").sortWithinPartitions("path", "class")
    levels = sorted(set(depths.values()))
    names = ["level", "path", "a", "b"]

    def out(level: int, path: list, a: list, b: list) -> pa.RecordBatch:
        kinds = [pa.binary(), pa.binary(), pa.binary()]
        arrays = [pa.array([level] * len(a), pa.int32()), *map(pa.array, (path, a, b), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, tuple[bytes, bytes, bytes]] = {}  # for each level the last path, its node, its run's first node
        for batch in batches:
            depth = np.array([depths.get(c, LABELS + 1) for c in batch.column(1).to_pylist()])
            path, least = (batch.column(k).to_pylist() for k in (0, 2))
            for level in levels:
                at = np.flatnonzero(depth <= level).tolist()
                if not at:
                    continue
                before = last.get(level)
                if before is None:
                    yield out(level, [path[at[0]]], [least[at[0]]], [None])
                own = [path[k] for k in at]
                nodes = [least[k] for k in at]
                if before is not None:
                    own, nodes = [before[0], *own], [before[2], *nodes]
                starts = shared_labels(matrix(pa.array(own, pa.binary()))) < level
                starts[0] = True
                head = np.maximum.accumulate(np.where(starts, np.arange(len(own)), 0))
                edges = [(nodes[k], nodes[h]) for k, h in enumerate(head.tolist()) if nodes[k] != nodes[h]]
                yield out(level, [None] * len(edges), [a for a, _ in edges], [b for _, b in edges])
                last[level] = own[-1], least[at[-1]], nodes[head[-1]]
        for level, (path, node, _) in last.items():
            yield out(level, [path], [node], [None])

    return ordered.mapInArrow(work, "level int, path binary, a binary, b binary")


def edges(nodes: DataFrame, space: Workspace, threshold: float) -> DataFrame:
    """(a, b) that connect all nodes of (node, size, paths) which meet in the forest."""
    spread = nodes.select("node", size_class(F.col("size")).alias("class"), F.explode("paths").alias("path"))
    rows = spread.groupBy("path", "class").agg(F.min("node").alias("least"), (F.min("node") != F.max("node")).alias("many"))
    met = space.settle(meeting(rows, depth_for(threshold)), "meeting")
    # sort-merged at every size, as on a cluster: neither side has a bound
    hits = space.settle(spread.join(met.hint("merge"), ["path", "class"]).select("node", "class", "least", "shared"), "hits")
    depths = class_depths(hits, threshold)
    scanned = space.settle(runs(met, depths), "runs")
    ends = scanned.filter("path is not null")
    # two rows for each level and partition
    order = Window.partitionBy("level").orderBy("path")
    prefix = F.substring("path", F.lit(1), 1 + 2 * F.col("level"))
    joined = ends.select("a", F.lag("a").over(order).alias("b"), prefix.alias("own"), F.lag(prefix).over(order).alias("other"))
    return (scanned.filter("path is null").select("a", "b")
            .unionByName(joined.filter("own = other and a != b").select("a", "b"))
            .unionByName(hits.filter("node != least").select(F.col("node").alias("a"), F.col("least").alias("b"))))
