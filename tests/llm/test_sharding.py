import hashlib
from collections import Counter, defaultdict

import pytest

from tallyworks.llm import sharding


def brute(rows, limit):
    """Split buckets one bit at a time."""
    items = []
    for doc, text in rows:
        digest = hashlib.md5(f"{'' if doc is None else doc}|{text or ''}".encode()).hexdigest()[:15]
        items.append((f"{int(digest, 16):060b}", doc, len((text or "").encode())))
    shards, out = [("", items)], {}
    while shards:
        bits, held = shards.pop()
        if sum(x[2] for x in held) <= limit or len(bits) == 60:
            out[bits] = held
            continue
        parts = defaultdict(list)
        for x in held:
            parts[x[0][:len(bits) + 1]].append(x)
        shards += parts.items()
    return out


@pytest.mark.parametrize("limit", [10**9, 5000, 400])
def test_against_splitting_bit_by_bit(frame, room, limit):
    rows = [(n, "w" * (n * 37 % 300)) for n in range(400)] + [(None, None), (None, "x"), (7, "w" * 259), (500, "")]
    found = sharding.assign(frame(rows), room, limit).collect()
    expected = Counter()
    for bits, held in brute(rows, limit).items():
        total, name = sum(x[2] for x in held), f"{len(bits)}-{int(bits or '0', 2)}"
        for _, doc, size in held:
            expected[doc, size, name, total if len(bits) < 60 else None] += 1
    assert len(found) == len(rows)
    assert Counter((r["doc_id"], r["n_bytes"], r["shard"].rpartition("-")[0],
                    r["shard_bytes"] if r["depth"] < 60 else None) for r in found) == expected


def test_rows_that_share_all_bits_fill_parts(frame, room):
    rows = [(1, "same text")] * 1000 + [(2, "z" * 5000)] + [(n, "other") for n in range(3, 60)]
    found = sharding.assign(frame(rows), room, 100).collect()
    assert len(found) == len(rows)
    shards = defaultdict(list)
    for r in found:
        shards[r["shard"]].append(r)
    for held in shards.values():
        total = sum(r["n_bytes"] for r in held)
        assert {r["shard_bytes"] for r in held} == {total}
        assert total <= 100 or len(held) == 1
    assert sum(r["doc_id"] == 1 for held in shards.values() for r in held[:1]) == -(-1000 // 11)


def test_empty_and_clashing(frame, room, spark, tmp_path):
    assert sharding.assign(frame([]), room).count() == 0
    docs = frame([(1, "a"), (None, None)], clash=True)
    found = sharding.assign(docs, room)
    assert found.count() == 2 and found.first()["key"] == "own" and found.first()["depth"] == 0
    sharding.write_shards(frame([(n, "text" * n) for n in range(50)]), str(tmp_path / "out"), room, 400)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50
