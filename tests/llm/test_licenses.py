import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyworks.llm import licenses

TEXTS = [
    "Under the MIT License. Then under-the-mit   license!", "Apache License, Version 2.0 applies; cc by-nc", "under the mit",
    "", None, "license", "cc by nc " * 40, "x" * 200_000 + " under the mit license", "Licensed under the Apache License, Version 2.0",
    "Unter K mit the MIT lİcense under THE mit license", "the mit license version 2 under the mit license version 2 0",
    "released under the terms of the GNU General Public License", "gnu general public license", "cc by cc by nc nc",
    "Permission to use, copy, modify, and/or distribute this software for any purpose", "to deal in free and unencumbered software",
    "under the terms of the GNU Lesser General Public License; GNU General Public License", "license version apache 2",
    "ünder the mit license, ßunder the mit license",
]


def brute(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels, base, score = [], set(), set(), 0.0
    for t in licenses.TEMPLATES:
        key, whole = t.key_words, t.all_words
        for i in range(len(words) - len(key) + 1):
            if words[i:i + len(key)] == key:
                labels.add(t.label)
                if t.base:
                    places.append(i)
                    base.add(t.label)
                start = i - t.key_at
                same = sum(0 <= start + k < len(words) and words[start + k] == w for k, w in enumerate(whole))
                score = max(score, same / len(whole))
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


def test_against_brute_force(frame):
    rows = [(n, t) for n, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, TEXTS[1])]
    found = licenses.scan(frame(rows)).select("doc_id", "text", *licenses.MADE).collect()
    assert Counter((r[0], r[1], *r[2:8], round(r[8], 9)) for r in found) == Counter(
        (i, t, *brute(t)[:6], round(brute(t)[6], 9)) for i, t in rows)


def test_words_rank_by_the_documents_that_hold_them(frame):
    texts = ["mit license license", "the mit license", "mit", "the license", None, "version"]
    words = frame(list(enumerate(texts))).select(licenses.words_of(F.coalesce("text", F.lit(""))).alias("_words"))
    counts = licenses.document_counts(words, licenses.TEMPLATES[:2])
    assert counts == {"2": 0, "apache": 0, "license": 3, "mit": 3, "the": 2, "under": 0, "version": 1}
    assert licenses.ranked_words(counts) == ["2", "apache", "under", "version", "the", "license", "mit"]


def test_repeated_and_single_key_words(frame):
    """Key phrases of one word, with a repeated word, and inside each other."""
    own = [licenses.base("one", "alpha"), licenses.base("twice", "beta alpha beta"),
           licenses.Template("wide", "x beta beta alpha beta y", "beta alpha")]
    text = "alpha beta alpha beta alpha beta beta alpha beta y"
    row = licenses.scan(frame([(1, text)]), own).first()
    assert (row["n_base"], row["first_word"], row["last_word"]) == (4 + 3, 0, 7)
    assert (row["base_labels"], row["labels"], row["score"]) == ("one,twice", "one,twice,wide", 1.0)


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_small_tables_and_clashing_columns(frame, rows):
    docs = frame(rows, clash=True)
    found = licenses.scan(docs)
    assert found.count() == len(rows)
    assert sorted(found.columns) == sorted(set(docs.columns) | set(licenses.MADE))
    assert all(r["key"] == "own" for r in found.collect())
