import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyworks.llm import links, ngram_join

UPPER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    words = [w for w in re.split(r"[ \t-\r]+", (text or "").translate(UPPER)) if w]
    return frozenset([tuple(words)] if 0 < len(words) < 5 else [tuple(words[i:i + 5]) for i in range(len(words) - 4)])


def brute_links(rows, threshold=0.8):
    """{doc_id: (class_id, n_links)} over all pairs; ids are different."""
    sets = {doc: shingles(text) for doc, text in rows}
    parent, count = {d: d for d in sets}, defaultdict(int)

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[i + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and shared >= threshold * (len(sets[a]) + len(sets[b]) - shared) - 1e-9:
                count[a] += 1
                count[b] += 1
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return {d: (top(d), count[d]) for d in sets}


def near_copies(n, seed=0, groups=12):
    draw = random.Random(seed)
    bases = [[str(draw.randint(0, 10**6)) for _ in range(draw.choice([3, 5, 6, 8, 12, 40, 150]))] for _ in range(groups)]
    rows = []
    for doc in range(n):
        words = list(draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 1, 2])):
            words[draw.choice([0, len(words) - 1, draw.randrange(len(words))])] = f"edit{draw.randint(0, 5)}"
        rows.append((doc, draw.choice([" ", "\n", "  "]).join(words)))
    return rows


def result(docs, room):
    return {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.join(docs, room).collect()}


def test_against_all_pairs(frame, room):
    rows = near_copies(300) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "word"), (1004, "WORD"), (1005, "w " * 20_000)]
    assert result(frame(rows, clash=True), room) == brute_links(rows)


def test_groups_beyond_one_block(frame, room, monkeypatch):
    monkeypatch.setattr(links, "BLOCK", 10)
    draw = random.Random(8)
    base = [f"w{n}" for n in range(120)]
    rows = []
    for doc in range(150):
        words = base[:draw.randint(80, 120)] + [f"x{draw.randint(0, 40)}" for _ in range(draw.randint(0, 4))]
        words[draw.randrange(70)] = f"e{draw.randint(0, 3)}"
        rows.append((doc, " ".join(words)))
    assert result(frame(rows), room) == brute_links(rows)


def test_repeated_rows_and_null_ids(frame, room):
    text = "one two three four five six seven"
    rows = [(None, text), (None, text), (3, text), (3, text), (4, "another text of quite other words here"), (4, None)]
    found = Counter((r["doc_id"], r["class_id"], r["copy_id"], r["n_links"]) for r in ngram_join.join(frame(rows), room).collect())
    assert found == {(None, 3, 3, 3): 2, (3, 3, 3, 3): 2, (4, 4, 4, 0): 2}
    assert ngram_join.join(frame([]), room).count() == 0
    assert ngram_join.join(frame([(None, text), (None, text)]), room).first()["class_id"] is None


@settings(max_examples=8, deadline=None)
@given(edges=st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components(spark, tmp_path_factory, edges):
    from tallyworks.workspace import Workspace

    room = Workspace(spark, str(tmp_path_factory.mktemp("c")))
    frame = spark.createDataFrame([(a, b) for a, b in edges], "a int, b int")
    found = {r["node"]: r["root"] for r in links.components(frame, room).collect()}
    parent = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(parent[a], parent[b])
            changed |= parent[a] != low or parent[b] != low
            parent[a] = parent[b] = low
    assert found == {x: r for x, r in parent.items() if any(x in e and e[0] != e[1] for e in edges)}


@pytest.mark.parametrize("columns", [3, 8192])
def test_intersections(monkeypatch, columns):
    import numpy as np

    monkeypatch.setattr(links, "COLUMNS", columns)
    draw = random.Random(1)
    sets = [np.unique(np.array([draw.randint(0, 40) for _ in range(draw.randint(1, 30))], np.uint64)) for _ in range(25)]
    found = links.intersections(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert found[i, j] == len(set(a) & set(b))


def test_a_repeated_id_does_not_meet_all_its_texts(frame, room, monkeypatch):
    fetched, sets = [], ngram_join._shingle_sets
    monkeypatch.setattr(ngram_join, "_shingle_sets", lambda rows: fetched.append(rows.count()) or sets(rows))
    base = [f"w{n}" for n in range(100)]
    rows = [(doc, " ".join([*base, f"end{n}"])) for doc in (None, 7) for n in range(20 * (doc or 0), 20 * (doc or 0) + 40)]
    found = ngram_join.join(frame(rows), room).collect()
    assert {(r["class_id"], r["n_links"]) for r in found} == {(7, len(rows) - 1)} and len(found) == len(rows)
    assert fetched == [len(rows)]
