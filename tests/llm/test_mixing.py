import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from tallyworks.llm import mixing, queries


def brute_targets(sizes, weights=(1, 2, 3)):
    """Share by weight and share excesses again until none is left."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    total, done = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in done]
        left = total - sum(done.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return done | share
        done |= {s: 3 * sizes[s] for s in over}


def brute(rows):
    by_source = defaultdict(list)
    for doc, text, source in rows:
        key = hashlib.md5(f"{'' if doc is None else doc}|{text or ''}".encode()).hexdigest()[:16]
        by_source[source].append((key, doc, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    sizes = {s: sum(x[2] for x in held) for s, held in by_source.items()}
    targets, out = brute_targets(sizes), []
    for source, held in by_source.items():
        words = [x for epoch in range(3) for x in sorted(held, key=lambda x: x[0])]
        left, taken = int(targets[source] + 0.5), [0] * len(words)
        for n, (_, _, size) in enumerate(words):
            taken[n] = min(size, left)
            left -= taken[n]
        for n, (_, doc, size) in enumerate(sorted(held, key=lambda x: x[0])):
            out.append((doc, size, sizes[source], round(targets[source], 6), sum(taken[n::len(held)])))
    return Counter(out)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    made = [(n, " ".join("w" * draw.randint(1, 3) for _ in range(draw.randint(0, 40))), draw.choice(["hot"] * 8 + ["b", "é", None, "Z"]))
            for n in range(300)]
    return made + [(300, None, "b"), (None, "one two", None), (301, "x " * 5000, "tiny"), (302, "", "void"),
                   (5, "same", "rare"), (5, "same", "rare"), (303, "a\x1cb\x0bc d", "b")]


def test_against_brute_force(frame, room, rows):
    found = mixing.plan(frame(rows), room).collect()
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in found) == brute(rows)
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] == sum(p["words"] for p in r["places"]) for r in found)


def test_times_follow_the_schedule(frame, room, rows):
    """By half the training time a source has been asked for its integral up to there."""
    found = mixing.plan(frame([(n, "w " * 10, "abc"[n % 3]) for n in range(3000)]), room).collect()
    targets = {r["target"]: r for r in found}
    for target in targets:
        slope = {0: 0.5, 1: 0.0, 2: -0.5}[sorted(targets).index(target)]
        early = sum(p["words"] for r in found if r["target"] == target for p in r["places"] if p["time"] < 0.5)
        assert early == pytest.approx(target * (0.5 - slope / 4), abs=20)


def test_train_order_and_small_tables(frame, room):
    docs = frame([(n, "w " * (n % 7), "ab"[n % 2]) for n in range(200)], clash=True)
    ordered = mixing.train_order(docs, room)
    planned = mixing.plan(docs, room).collect()
    expected = Counter()
    for r in planned:
        expected[r["doc_id"]] += sum(2 * p["words"] >= r["size"] for p in r["places"])
    assert Counter(r["doc_id"] for r in ordered.collect()) == +expected
    assert ordered.columns == docs.columns and ordered.first()["size"] == "own"
    assert mixing.plan(frame([]), room).count() == 0
    assert mixing.plan(frame([(None, None)]), room).first()["taken"] == 0


def test_a_source_of_one_long_document_stays(frame, room):
    docs = frame([(0, "w " * 1000, "a"), *[(n, "w " * 50, "b") for n in range(1, 11)]])
    planned = {r["doc_id"]: r for r in mixing.plan(docs, room, weights=(1, 9, 1)).collect()}
    assert 0 < planned[0]["taken"] * 2 < planned[0]["size"]
    assert [r["doc_id"] for r in mixing.train_order(docs, room, weights=(1, 9, 1)).collect()].count(0) == 1


def test_the_query_writes_the_training_order(frame, room, rows):
    """The sequence holds every place of every document by time, and the query's rows are made from it."""
    docs = frame(rows)
    planned = mixing.plan(docs, room).collect()
    ordered = [r.place for r in mixing.sequence(docs, room).collect()]
    times = [p.time for p in ordered if p is not None]
    assert times == sorted(times) and all(p is None for p in ordered[len(times):])
    assert Counter(tuple(p) for p in ordered if p) == Counter(tuple(p) for r in planned for p in r.places)
    assert ordered.count(None) == sum(not r.places for r in planned)
    found = mixing.summed_up(mixing.sequence(docs, room)).collect()
    assert Counter(tuple(r) for r in found) == Counter(
        (r.doc_id, r["size"], r.source_size, r.target, r.taken, len(r.places), min((p.time for p in r.places), default=None))
        for r in planned)


def test_op9_sorts_its_places_by_time(spark, monkeypatch):
    """The registered query goes through the whole sequence, not the plan alone."""
    seen, whole = [], mixing.sequence
    monkeypatch.setattr(mixing, "sequence", lambda *a, **k: seen.append(whole(*a, **k)) or seen[-1])
    found = queries.op9_mixing(spark, "/root/testdata/sf0.001")
    assert seen[0].where("place is not null").count() == found.agg({"n_epochs": "sum"}).first()[0] > found.count()
