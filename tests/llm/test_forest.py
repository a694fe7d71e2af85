import random

import numpy as np
import pyarrow as pa
import pytest

from tallyworks.llm import forest, ngram_join
from tests.llm.test_ngram_join import brute_links, near_copies

TRIE = "path binary, class int, least binary, many boolean"


def path(tree, *labels):
    filled = [*labels, *[0] * (forest.LABELS - len(labels))]
    return bytes([tree]) + b"".join(x.to_bytes(2, "big") for x in filled)


def common(a, b):
    if a[0] != b[0]:
        return 0
    parts = [(x[1 + 2 * k:3 + 2 * k]) for x in (a, b) for k in range(forest.LABELS)]
    k = 0
    while k < forest.LABELS and parts[k] == parts[forest.LABELS + k]:
        k += 1
    return k


def test_the_floor_keeps_links_of_every_possible_similarity():
    for size in range(1, 200):
        s = forest.least_similarity(size, 0.8)
        depth = forest.depth_for(s)
        assert 1 - (1 - s**depth) ** forest.TREES >= forest.RECALL
        assert depth == forest.LABELS or 1 - (1 - s ** (depth + 1)) ** forest.TREES < forest.RECALL
    assert forest.depth_for(1.0) == forest.LABELS and forest.least_similarity(1, 0.8) == 1


def test_prefixes_shorten_until_the_estimated_recall_is_reached():
    sure, unsure = (100_000, 5, 50), (100_000, 4000, 3000)
    assert forest.shortened({8: sure, 7: sure, 6: sure}, 6) == 8
    assert forest.shortened({8: unsure, 7: sure, 6: sure}, 6) == 7
    assert forest.shortened({8: unsure, 7: unsure, 6: unsure}, 6) == 6
    assert forest.shortened({8: (3, 0, 0), 7: (3, 0, 0), 6: (3, 0, 0)}, 6) == 6  # too little is known to stop early
    assert forest.shortened({8: (0, 0, 0)}, 8) == 8


def test_shared_labels():
    rows = [path(0, 1, 2, 3), path(0, 1, 2, 4), path(0, 1, 2, 4), path(1, 1, 2, 4), path(1, 1, 300)]
    assert forest.shared_labels(forest.matrix(pa.array(rows))).tolist() == [0, 2, 8, 0, 1]


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_neighbours_meet_across_batches_and_partitions(spark, room, batch):
    draw = random.Random(batch)
    rows = {}
    for n in range(400):
        p = path(draw.randrange(2), *[draw.choice([0, 0, 0, 1]) for _ in range(8)])
        rows[p, draw.choice([64, 65])] = b"%03d" % n
    frame = spark.createDataFrame([(p, c, node, False) for (p, c), node in rows.items()], TRIE)
    old = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        met = room.settle(forest.meeting(frame, 6), "met")
        depths = {64: 6, 65: 7}
        out = forest.runs(met, depths).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    found = {(r["path"], r["class"]): r["shared"] for r in met.collect()}
    items = sorted(rows)
    for key in items:
        deepest = max(common(key[0], other[0]) for other in items if other != key)
        assert deepest < 6 or key in found
        assert found.get(key, 0) <= deepest
    parent = {node: node for node in rows.values()}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        low, high = sorted((top(a), top(b)))
        parent[high] = low

    for r in out:
        if r["path"] is None:
            join(r["a"], r["b"])
    for level in (6, 7):
        ends = sorted((r["path"], r["a"]) for r in out if r["path"] and r["level"] == level)
        for (p, a), (q, b) in zip(ends, ends[1:], strict=False):
            if common(p, q) >= level:
                join(a, b)
    got = {node: top(node) for node in rows.values()}
    parent = {node: node for node in rows.values()}
    for i, one in enumerate(items):
        for two in items[i + 1:]:
            if common(one[0], two[0]) >= max(depths[one[1]], depths[two[1]]):
                join(rows[one], rows[two])
    assert got == {node: top(node) for node in rows.values()}


def test_a_full_path_of_many_nodes_is_one_row_of_the_trie(spark, room, monkeypatch):
    seen, meeting = [], forest.meeting
    monkeypatch.setattr(forest, "meeting", lambda rows, depth: seen.append(rows.count()) or meeting(rows, depth))
    nodes = spark.createDataFrame([(b"%04d" % n, 100, [path(t, 5) for t in range(3)]) for n in range(500)],
                                  "node binary, size int, paths array<binary>")
    edges = {(r["a"], r["b"]) for r in forest.edges(nodes, room, 0.8).collect()}
    assert seen == [3] and edges == {(b"%04d" % n, b"0000") for n in range(1, 500)}


def test_recall_with_longer_prefixes(frame, room, monkeypatch):
    """Prefixes that stay long lose links, the shortened ones don't: the tries decide what meets."""
    rows = near_copies(400, seed=3, groups=60)
    want = brute_links(rows)

    def found():
        return {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.join(frame(rows), room).collect()}

    assert found() == want
    monkeypatch.setattr(forest, "shortened", lambda counts, floor: forest.LABELS + 1)
    longer = found()  # only equal paths meet
    assert sum(n for _, n in longer.values()) <= sum(n for _, n in want.values())


def test_paths_hold_each_tree_once():
    shingles = np.arange(50, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    made = forest.paths(shingles, np.array([20, 0, 30]), np.array([20, 0, 30]), 0.8)
    assert len(made) == 3 and all([p[0] for p in own] == list(range(forest.TREES)) for own in made)
    assert {len(p) for own in made for p in own} == {forest.WIDTH}
