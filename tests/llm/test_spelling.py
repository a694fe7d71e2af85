import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyworks.llm import spelling

ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(rows):
    words = counted(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words} if len(words) < 1500 else {
        w: edits(w) & set(words) - {w} for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), None if form[w] is None else words[form[w]]))
    return sorted(out)


def edits(w):
    cut = [(w[:i], w[i:]) for i in range(len(w) + 1)]
    return {a + b[1:] for a, b in cut if b} | {a + c + b[1:] for a, b in cut if b for c in ALPHABET} | {
        a + c + b for a, b in cut for c in ALPHABET}


def found(frame, room, rows, clash=False):
    got = spelling.variants(frame(rows, clash), room)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, got.collect()))


def test_against_brute_force(frame, room):
    draw = random.Random(4)
    base = ["".join(draw.choice("abcéß") for _ in range(draw.randint(4, 7))) for _ in range(120)]
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "Straße", "STRASSE", "straßen"]
    weights = [1 / (i + 1) for i in range(len(base))]
    rows = [(n, " ".join(draw.choices(base, weights, k=120)) + ", x1y×÷") for n in range(60)]
    assert found(frame, room, rows) == brute(rows)


def test_chains_of_forms_reach_their_last_word(frame, room):
    """Each word one letter from the next and at least twice as rare: a chain of eight steps."""
    chain = ["aaaaaaaaa"[:i] + "bbbbbbbbb"[i:] for i in range(9)]
    rows = [(i, " ".join([w] * (3 * 3 ** min(i, 5) if i < 6 else 3 * 243 * 3 ** (i - 5)))) for i, w in enumerate(chain)]
    want = brute(rows)
    assert found(frame, room, rows) == want
    assert {r[2] for r in want if r[1] is not None} == {chain[-1]}


def test_defined_cases(frame, room):
    rows = [(None, "words words"), (None, "words words"), (1, None), (2, ""), (3, "word wordy wordy wordy"), (3, "a " * 50_000),
            (4, "0words_wordy-WORDS")]
    assert found(frame, room, rows, clash=True) == brute(rows)
    assert found(frame, room, []) == []


def test_a_group_is_bounded_by_the_alphabet(spark):
    """All words that differ in one place share one prefix range, and each letter is there once."""
    words = spark.createDataFrame([("abc" + c + "de", 3 + i) for i, c in enumerate(ALPHABET)] + [("abcde", 9)],
                                  "word string, n long")
    largest = spelling.rotations(words).groupBy("rotation").count().agg(F.max("count")).first()[0]
    assert largest == len(ALPHABET) + 1
    near = {r.word: r.n_near for r in spelling.neighbours(words).collect()}
    # beside c, letters are in one run: "abccde" still meets "abcde" once
    assert near["abcde"] == len(ALPHABET) and set(near.values()) == {len(ALPHABET)}


@pytest.mark.parametrize("name", ["sf0.001"])
def test_given_table(spark, room, name):
    docs = spark.read.parquet(f"/root/testdata/{name}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(map(tuple, spelling.variants(docs, room).collect()))
    assert got and got == brute(rows)
