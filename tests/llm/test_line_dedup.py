import random

from pyspark.sql import functions as F

from tallyworks.llm import line_dedup


def brute(rows):
    """(doc_id, text) in order of doc_id, nulls last; equal rows once."""
    seen, out = set(), {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        lines = text.split("\n") if text is not None else []
        gone = set()
        for s in range(len(lines) - 2):
            window = tuple(lines[s:s + 3])
            if not "".join(window).strip(" "):
                continue
            if window in seen:
                gone |= {s, s + 1, s + 2}
            seen.add(window)
        out[doc, text] = "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text
    return out


def check(frame, rows):
    docs = frame(rows)
    cleaned = line_dedup.dedup(docs.withColumn("was", F.col("text"))).collect()
    expected = brute(rows)
    assert len(cleaned) == len(rows)
    for r in cleaned:
        assert r["text"] == expected[r["doc_id"], r["was"]]
        lines = (r["was"] or "").split("\n")
        assert r["n_lines"] == (0 if r["was"] is None else len(lines))
        kept = 0 if r["text"] is None else len(r["text"].split("\n"))
        if r["text"]:
            assert r["n_removed"] == r["n_lines"] - kept


def test_random_documents(frame):
    draw = random.Random(5)
    rows = [(n, "\n".join(draw.choice(["a", "b", "", " ", "a b", "é"]) for _ in range(draw.randint(0, 12)))) for n in range(120)]
    check(frame, rows)


def test_defined_cases(frame):
    long = "\n".join(f"line {n % 700}" for n in range(3000))
    rows = [(1, "x\ny\nz"), (2, "x\ny\nz\nw"), (2, "x\ny\nz\nw"), (3, "x\ny"), (4, None), (5, ""), (None, "x\ny\nz\nw\nv"),
            (6, "\n\n\n\n"), (7, "\n\n\n\n"), (8, "x\ny\nz\nw"), (9, long), (10, long)]
    check(frame, rows)


def test_empty_and_clashing(frame):
    assert line_dedup.dedup(frame([])).count() == 0
    found = line_dedup.dedup(frame([(1, "a\nb\nc"), (2, "a\nb\nc")], clash=True)).orderBy("doc_id").collect()
    assert [(r["text"], r["n_removed"], r["key"]) for r in found] == [("a\nb\nc", 0, "own"), ("", 3, "own")]
