import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from tallyworks.llm import topk_search

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("score", T.StringType())])


def brute(rows, every, k=5):
    sound = [(n, [math.floor(256 * float(np.float32(x))) for x in v]) for n, v in rows
             if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, q in sound:
        if n is not None and n % every == 0:
            scored = sorted(((-sum(a * b for a, b in zip(q, c, strict=True)), m is None, m)
                             for m, c in sound if m != n and len(c) == len(q)), key=lambda x: (x[0], x[1], x[2] or 0))
            out += [(n, r + 1, m, -s) for r, (s, _, m) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def run(spark, room, rows, every=50, per_shard=64):
    vectors = spark.createDataFrame([(n, v, "own") for n, v in rows], SCHEMA)
    found = topk_search.top_k(vectors, room, every=every, per_shard=per_shard)
    return sorted([tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()], key=repr)


@pytest.mark.parametrize(("width", "spread"), [(16, 1.0), (3, 0.01), (40, 3.0)])
def test_against_brute_force(spark, room, width, spread):
    draw = random.Random(width)
    rows = [(n, [draw.gauss(0, spread) * (1 + 5 * (k == 0)) for k in range(width)]) for n in range(400)]
    rows += [(n + 400, rows[n % 7][1]) for n in range(60)]
    assert run(spark, room, rows, every=20) == brute(rows, 20)


def test_defined_cases(spark, room):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (1, [0.5, None]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (5, []), (6, [1.0, 2.0]),
            (None, [3.0, 3.0]), (50, [1.0, 2.0, 3.0]), (7, [-1.0, 0.0, 1.0]), (100, [0.1, 0.1]), (100, [0.2, 0.2]), (6, [1.0, 2.0])]
    assert run(spark, room, rows, per_shard=2) == brute(rows, 50)
    assert run(spark, room, []) == [] and run(spark, room, [(0, [1.0])]) == []


def test_blocks_of_queries(spark, room, monkeypatch):
    monkeypatch.setattr(topk_search, "QUERIES", 7)
    draw = random.Random(9)
    rows = [(n, [draw.gauss(0, 1) for _ in range(8)]) for n in range(120)]
    assert run(spark, room, rows, every=2, per_shard=30) == brute(rows, 2)


def test_scores_beyond_64_bits_rank_exactly(spark, room):
    rows = [(0, [1e30, 1.0]), (1, [-1.0, 1.0]), (2, [1e30, 1.0]), (3, [1e30, 2.0]), (4, [-1e30, 0.0]), (5, [3e38, -1.0]),
            (50, [-1e30, 5.0]), (6, [2e8, 2e8]), (100, [2e8, 2e8])]
    asked = [(n, r, m, min(max(s, topk_search.LEAST), topk_search.MOST)) for n, r, m, s in brute(rows, 50)]
    assert run(spark, room, rows, per_shard=3) == asked
    assert run(spark, room, rows) == asked


@pytest.mark.parametrize("size", [1, 2**20, 2**40])
def test_terms_below_the_floor_are_probed_for_few(size):
    """One term outweighs the others: it alone is essential, and they are probed only while a candidate competes."""
    draw = np.random.Generator(np.random.PCG64(0))
    terms = draw.integers(-3, 4, (5000, 32)) * size
    terms[:, 5] = draw.integers(-10_000, 10_000, 5000) * size
    query, work = np.full((1, 32), size), Counter()
    found = topk_search.max_score(query, np.array([-1]), terms, np.arange(5000), 5, work)
    whole = (terms.astype(object) * size).sum(axis=1)
    assert [s for _, _, s in found] == sorted(whole, reverse=True)[:5]
    assert work["postings"] <= 3 * 5000  # of 32 * 5000
    assert work["probes"] < 31 * 500


def test_equal_bounds_leave_all_terms_essential():
    """Without a term below the floor nothing is left out, and nothing is lost."""
    terms = np.array([[0, 1], [1, 0], [1, 1], [0, 0]] * 3)
    found = topk_search.max_score(np.array([[1, 1]]), np.array([2]), terms, np.arange(12), 5)
    assert [(m, s) for _, m, s in found] == [(6, 2), (10, 2), (0, 1), (1, 1), (4, 1)]
