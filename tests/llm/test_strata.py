import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from tallyworks.llm import strata

ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("score", T.StringType())])
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(rows, items, k):
    docs = [(d, Counter(terms(t))) for d, t in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in docs:
            m = 100 - 25 + (25 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                (1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, d is None, d))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def found(spark, frame, room, rows, items, k=20, limit=strata.SEGMENT, clash=False):
    asked = spark.createDataFrame([(i, t, "own") for i, t in items], ITEM)
    got = strata.rank(frame(rows, clash), asked, room, k, limit)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def corpus(seed, n=300):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)] + ["Éa", "éa", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [(i, " ".join(draw.choices(vocabulary, weights, k=draw.choice([1, 3, 10, 10, 10, 40, 400])))) for i in range(n)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(1, 12)))) for i in range(25)]
    return rows, items


@pytest.mark.parametrize("limit", [7, 64])
def test_against_brute_force(spark, frame, room, limit):
    rows, items = corpus(limit)
    assert found(spark, frame, room, rows, items, 6, limit) == brute(rows, items, 6)


def test_copies_ties_and_defined_cases(spark, frame, room):
    rows = [(n, "same words here") for n in range(60)] + [(None, "same words"), (None, "same words"), (7, None), (8, ""), (9, "...")]
    rows += [(100, "W" * 200_000 + " same"), (101, "other, OTHER_other"), (101, "other, OTHER_other"), (102, "and " * 30_000 + "here")]
    items = [(1, "Same HERE same"), (1, "Same HERE same"), (2, None), (3, ""), (4, "absent"), (None, "other"), (1, "words")]
    assert found(spark, frame, room, rows, items, limit=16, clash=True) == brute(rows, items, 20)
    assert found(spark, frame, room, [], items) == [] and found(spark, frame, room, rows, []) == []


def test_queries_in_blocks(spark, frame, room, monkeypatch):
    monkeypatch.setattr(strata, "BLOCK_BYTES", 200)
    rows, items = corpus(3, 80)
    assert found(spark, frame, room, rows, items, 4) == brute(rows, items, 4)


def test_bounds_hold_and_spare_visits(spark, frame, room):
    """No document beats its segment's bound, and with the floors most segments aren't visited."""
    rows, items = corpus(11, 400)
    queries = strata.Queries.of([t for _, t in items])
    counts = room.settle(strata.counted(frame(rows), queries.vocabulary), "counts")
    n_docs, total = counts.count(), counts.groupBy().sum("n").first()[0]
    df = Counter(t for r in counts.collect() for t in r.terms)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[i] + 1))) for i in range(len(queries.vocabulary))])
    weighted = queries.weighted(weights)
    best = {(i, r): s for i, r, _, s in brute(rows, items, 5)}
    floors = np.array([best.get((i, 5), 0) for i, _ in items])
    every = np.arange(len(items))
    visits = possible = 0
    for row in strata.segments(counts, n_docs, total, 16).collect():
        seg = {c: np.array(v) if isinstance(v, list) else v for c, v in row.asDict().items()}
        most = strata.bounds(queries, weighted, seg["m"], seg["terms"], seg["tops"])
        for q, _, score in strata.visit(queries, weighted, seg, every, np.zeros(len(items)), 100):
            assert score <= most[q]
        visits += int(((most > 0) & (most >= floors)).sum())
        possible += int((most > 0).sum())
    assert 0 < visits < possible * 0.7


def test_impacts_are_those_of_the_formula():
    assert strata.impacts(np.array([1, 2, 50]), 100).tolist() == [10**9 // 2200, 2 * 10**9 // 3200, 50 * 10**9 // 51200]
