"""Exact links among candidate groups, and connected components, as Spark jobs.

Nodes are 16-byte keys of different shingle sets. Groups of any size are compared in blocks: a group
beyond one block is cut by set size, so that only sizes that can reach the threshold meet, and each
size class into blocks by hash; each pair of blocks is a task's work, and what leaves it is a row for
each node, never one for each pair.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.workspace import Workspace

#: Nodes of a block; a task compares two blocks.
BLOCK = 256
#: Parts into which a node's neighbours are dealt.
SALTS = 32
#: Columns of the incidence matrix held at once.
COLUMNS = 8192


def components(edges: DataFrame, space: Workspace) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); the root is the component's least node.

    Large-star and small-star steps in turn: a node's neighbours are hung on its least neighbour
    until every component is a star. The written edges of each round cut its lineage.
    """
    now = space.settle(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both).filter("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        large = space.settle(large.filter("a != b").distinct(), "large")
        hung = _with_least(large)
        small = hung.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            hung.select("a", F.col("least").alias("b")))
        now = space.settle(small.filter("a != b").distinct(), "small")


def _with_least(edges: DataFrame) -> DataFrame:
    """(a, b, least): the least b of each a. A hub's edges are dealt over SALTS parts; only each part's least one meets
    the others of the node."""
    dealt = edges.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    parts = dealt.groupBy("a", "part").agg(F.min("b").alias("low"))
    # at most SALTS rows of a node
    least = parts.select("a", "part", F.min("low").over(Window.partitionBy("a")).alias("least"))
    return dealt.join(least.hint("merge"), ["a", "part"]).select("a", "b", "least")


def block_plan(members: DataFrame, threshold: float, space: Workspace) -> DataFrame:
    """(node, task, side) from (node, size, grp): in which comparisons each node takes part."""
    ratio = math.log(1 / threshold)
    totals = members.groupBy("grp").agg(F.count("*").alias("total"))
    large = space.settle(totals.filter(F.col("total") > BLOCK), "large_groups")
    classed = members.withColumn("class", F.floor(F.log(F.col("size")) / ratio + 1e-9).cast("int"))
    small = members.join(large, "grp", "left_anti").select(
        "node", F.struct("grp", F.lit(0).alias("class"), F.lit(0).alias("one"), F.lit(0).alias("two")).alias("task"),
        F.lit(0).alias("side"))
    wide = classed.join(large.select("grp"), "grp", "left_semi")
    counts = space.settle(wide.groupBy("grp", "class").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("n")), "classes")
    around = counts
    for name, step in (("above", 1), ("below", -1)):
        other = counts.select("grp", (F.col("class") - step).alias("class"), F.col("n").alias(name))
        around = around.join(other, ["grp", "class"], "left")
    placed = wide.join(space.settle(around.fillna(0, ["above", "below"]), "around"), ["grp", "class"]).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))

    def upto(n: str) -> Column:
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))

    def tasks(name: str, low: Column, one: object, two: object, side: object) -> Column:
        return F.transform(upto(name), lambda s: F.struct(F.struct(
            F.col("grp"), low.alias("class"), one(s).cast("int").alias("one"), two(s).cast("int").alias("two")).alias("task"),
            side(s).cast("int").alias("side")))

    cls, own = F.col("class"), F.col("block")
    # odd numbers name comparisons of one class with the next, even ones those inside a class
    inside = tasks("n", cls * 2, lambda s: F.least(s, own), lambda s: F.greatest(s, own),
                   lambda s: (own > s).cast("int"))
    up = tasks("above", cls * 2 + 1, lambda s: own, lambda s: s, lambda s: F.lit(0))
    down = tasks("below", cls * 2 - 1, lambda s: s, lambda s: own, lambda s: F.lit(1))
    spread = placed.select("node", F.explode(F.concat(inside, up, down)).alias("t")).select("node", "t.task", "t.side")
    return small.unionByName(spread)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two sets share."""
    lengths = np.array([len(s) for s in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), lengths)
    shared = counts[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[row[a:b], column[a:b] - low] = 1
        out += held @ held.T
    return out


def _verify(threshold: float) -> object:
    def verify(rows: pd.DataFrame) -> pd.DataFrame:
        nodes = list(rows["node"])
        if len(nodes) < 2:
            return pd.DataFrame({"node": [], "links": [], "root": []})
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        shared, sizes = intersections(sets), np.array([len(s) for s in sets], np.float32)
        linked = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-3
        np.fill_diagonal(linked, False)
        sides = rows["side"].to_numpy()
        if sides.any():  # two blocks meet; links inside each are another task's
            linked &= sides[:, None] != sides[None, :]
        links = linked @ rows["copies"].to_numpy().astype(np.int64)
        ranks = np.argsort(np.argsort(np.array(nodes, object)))
        roots = ranks.copy()
        while True:
            least = np.minimum(roots, np.where(linked, roots[None, :], len(nodes)).min(axis=1))
            if (least == roots).all():
                break
            roots = least
        by_rank = sorted(nodes)
        found = np.flatnonzero(links)
        return pd.DataFrame({"node": [nodes[i] for i in found], "links": links[found],
                             "root": [by_rank[roots[i]] for i in found]})

    return verify


def verified(planned: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) for each comparison, from (node, copies, shingles, task, side).

    ``links`` counts the documents behind linked nodes; ``root`` is the least node reached inside
    the comparison.
    """
    return planned.groupBy("task").applyInPandas(_verify(threshold), "node binary, links long, root binary")

