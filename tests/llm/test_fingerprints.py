import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyworks.llm import fingerprints
from tallyworks.llm.queries import QUERIES
from tallyworks.llm.shingles import blocks
from tests.llm.test_ngram_join import brute_links, shingles


def brute(rows):
    def content(row):
        return hashlib.md5(f"{'' if row[0] is None else row[0]}|{row[1] or ''}".encode()).hexdigest()

    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), content(r)))
    out = Counter()
    for n, (doc, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = (fingerprints.signatures(pa.array([t]), fingerprints.Permutations(fingerprints.PERMUTATIONS, 2))[0]
                   for t in (text, edited, after))
        out[doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(),
            round(float((a == b).mean()), 9), round(float((a == c).mean()), 9)] += 1
    return out


def found(docs, room):
    return Counter((*r[:5], round(r[5], 9), round(r[6], 9)) for r in fingerprints.follow(docs, room).collect())


def test_against_brute_force(frame, room):
    draw = random.Random(1)
    rows = [(draw.randint(-50, 10**12), " ".join(draw.choice("abcdé日") for _ in range(draw.randint(0, 60)))) for _ in range(300)]
    rows += [(None, None), (None, "x y z"), (None, ""), (7, "same words here"), (7, "same words here"), (7, "other"), (8, "long " * 30_000)]
    assert found(frame(rows, clash=True), room) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, "lone text of some words in a row")], [(1, None)], [(None, "a"), (None, "a")]])
def test_small_tables(frame, room, rows):
    assert found(frame(rows), room) == brute(rows)


def test_likeness_estimates_similarity():
    words = [f"w{n}" for n in range(400)]
    one, two = " ".join(words), " ".join(words[:300] + [f"v{n}" for n in range(100)])
    signs = fingerprints.signatures(pa.array([one, two]), fingerprints.Permutations(fingerprints.PERMUTATIONS, 2))
    a, b = shingles(one), shingles(two)
    assert abs((signs[0] == signs[1]).mean() - len(a & b) / len(a | b)) < 0.12


def test_shingles_are_those_of_the_words():
    draw = random.Random(3)
    texts = [" ".join(draw.choice(["a", "B", "é", "\t", "\n\n", "ab"]) for _ in range(draw.randint(0, 30))) for _ in range(200)]
    sets = []
    for flat, number in blocks(pa.array(texts)):
        sets += [frozenset(x.tolist()) for x in np.split(flat, np.cumsum(number)[:-1])]
    plain = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for i in range(0, 200, 3):
        for j in range(200):
            assert len(sets[i] & sets[j]) == len(plain[i] & plain[j])


def test_bands_find_verified_near_duplicates(frame, room):
    draw = random.Random(6)
    rows = []
    for n in range(30):
        words = [f"{draw.randint(0, 10**6)}" for _ in range(120)]
        rows.append((3 * n, " ".join(words)))
        rows.append((3 * n + 1, " ".join(words[:-1] + ["end"])))
        rows.append((3 * n + 2, " ".join(words[:60])))
    result = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in fingerprints.near_duplicates(frame(rows), room).collect()}
    assert result == brute_links(rows)


def test_query_holds_both_halves(spark, frame, tmp_path):
    draw = random.Random(8)
    rows = []
    for n in range(40):
        words = [f"{draw.randint(0, 10**6)}" for _ in range(120)]
        rows += [(4 * n, " ".join(words)), (4 * n + 1, " ".join([*words[:-1], "end"])), (4 * n + 2, " ".join(words[:60])),
                 (4 * n + 3, "  ".join(words))]
    rows += [(1000, None), (1001, ""), (1002, "one word"), (1003, "One Word")]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    result = QUERIES["op5_fingerprints"](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in result} == brute_links(rows)
    copies = {d: min(e for e, other in rows if d == e or shingles(other) and shingles(other) == shingles(text)) for d, text in rows}
    assert {r["doc_id"]: r["copy_id"] for r in result} == copies
    assert Counter((*r[:5], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in result) == brute(rows)


def test_repeated_and_null_ids_keep_their_rows(frame, room):
    text = " ".join(str(n) for n in range(50))
    rows = [(None, text), (None, text), (5, text), (5, text + " more"), (6, None), (6, None), (None, None)]
    result = Counter((r["doc_id"], r["class_id"], r["copy_id"], r["n_links"])
                     for r in fingerprints.compare(frame(rows), room).collect())
    assert result == {(None, 5, 5, 3): 2, (5, 5, 5, 3): 2, (6, 6, 6, 0): 2, (None, None, None, 0): 1}
