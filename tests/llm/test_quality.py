import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyworks.llm import quality


def corpus(n, seed=0):
    draw = random.Random(seed)
    words = ["".join(draw.choice("etaoinshrdlu") for _ in range(draw.randint(1, 9))) for _ in range(400)]
    rows, labels = [], []
    for doc in range(n):
        said = [draw.choice(words) for _ in range(draw.randint(5, 200))]
        good = draw.random() < 0.7
        if not good:
            kind = draw.randint(0, 3)
            said = [[w.upper() + "!!" for w in said], [w + "###" for w in said], [said[0]] * len(said), [w + " |" for w in said]][kind]
        rows.append((doc, " ".join(said) + "."))
        labels.append((doc, int(good)))
    return rows, labels


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_held_out_accuracy(spark, frame, room):
    rows, labels = corpus(900)
    rows += [(None, None), (900, ""), (5, rows[5][1])]
    found = quality.classify(frame(rows, clash=True), labels_of(spark, labels), room).collect()
    assert len(found) == len(rows)
    truth, right = dict(labels), []
    for r in found:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) and r["key"] == "own"
        if r["held_out"] and r["doc_id"] in truth:
            right.append(r["predicted"] == truth[r["doc_id"]])
    assert len(right) > 150 and np.mean(right) > 0.97


def plain_statistics(text):
    data = text.encode()
    words, size = data.lower().split(), len(data)
    n, lines = max(len(words), 1), data.count(b"\n") + 1
    counts = [sum(data.count(c.encode()) for c in members) for members in quality._CLASSES]
    shares = [c / max(size, 1) for c in [*counts, size - sum(counts)]]
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [math.log1p(size), math.log1p(len(words)), size / n / 10, len(set(words)) / n, len(set(words)) / math.sqrt(n) / 10,
            again / n, math.log1p(n / lines), *shares, *[math.sqrt(shares[k]) for k in (6, 7, 8)],
            shares[0] / max(shares[0] + shares[1], 1e-9)]


def brute_scores(rows, labels):
    """Statistics text by text, one dense system, every training row left out in turn, isotonic means by their formula."""
    out = {d for d, _ in labels if zlib.crc32(str(d).encode()) % 4 == 2}
    x = np.array([plain_statistics(t or "") for _, t in rows])
    at = {d: i for i, (d, _) in enumerate(rows)}
    train, y = zip(*[(at[d], q) for d, q in labels if d not in out and d in at], strict=True)
    learnt, y = x[list(train)], np.array(y, float)
    mean, scale = learnt.mean(0), learnt.std(0) + 1e-6
    draw = np.random.Generator(np.random.PCG64(7))
    directions = draw.normal(0, 1 / quality.WIDTH, (x.shape[1], quality.FEATURES - 1))
    phases = draw.uniform(0, 2 * np.pi, quality.FEATURES - 1)

    def waves(x):
        made = np.cos(np.clip((x - mean) / scale, -6, 6) @ directions + phases) * math.sqrt(2 / (quality.FEATURES - 1))
        return np.concatenate([made, np.ones((len(x), 1))], axis=1)

    z = waves(learnt)
    ridge = quality.RIDGE * len(y) / quality.FEATURES + 1e-2
    gram = z.T @ z + ridge * np.eye(z.shape[1])
    weights = np.linalg.solve(gram, z.T @ y)
    alone = []
    for one, truth in zip(z, y, strict=True):
        leverage = one @ np.linalg.solve(gram, one)
        if leverage < 0.99:
            alone.append(one @ np.linalg.solve(gram - np.outer(one, one), z.T @ y - one * truth))
        else:
            alone.append((one @ weights - 0.99 * truth) / 0.01)
    place = np.clip(((np.array(alone) + 0.5) / 2 * quality.BINS).astype(int), 0, quality.BINS - 1)
    used = sorted(set(place.tolist()))
    ones = [y[place == b].sum() for b in used]
    many = [(place == b).sum() for b in used]
    level = [max(min(sum(ones[a:b + 1]) / sum(many[a:b + 1]) for b in range(i, len(used))) for a in range(i + 1))
             for i in range(len(used))]
    middle = [(b + 0.5) / quality.BINS * 2 - 0.5 for b in used]
    return dict(zip([d for d, _ in rows], np.clip(np.interp(waves(x) @ weights, middle, level), 0, 1), strict=True))


def test_against_brute_force(spark, frame, room):
    rows, labels = corpus(220, 5)
    rows += [(1000, None), (1001, "x" * 300_000), (1002, "Ünd so weiter\n\n")]
    found = {r["doc_id"]: r["score"] for r in quality.classify(frame(rows), labels_of(spark, labels), room).collect()}
    assert found == pytest.approx(brute_scores(rows, labels), abs=1e-6)


def test_labels_of_held_out_rows_are_not_read(spark, frame, room):
    rows, labels = corpus(300, 1)
    other = [(d, 1 - q if zlib.crc32(str(d).encode()) % 4 == 2 else q) for d, q in labels]
    one, two = ({r["doc_id"]: r["score"] for r in quality.classify(frame(rows), labels_of(spark, x), room).collect()}
                for x in (labels, other))
    assert one == pytest.approx(two)


@pytest.mark.parametrize("labels", [[], [(0, 1)], [(0, None), (1, 7)]])
def test_without_both_kinds(spark, frame, room, labels):
    found = quality.classify(frame([(0, "a"), (1, None)]), labels_of(spark, labels), room).collect()
    assert {r["score"] for r in found} == {1.0 if labels == [(0, 1)] else 0.5}
    assert quality.classify(frame([]), labels_of(spark, labels), room).count() == 0


def test_statistics_don_t_depend_on_the_batch():
    texts = [t for _, t in corpus(40, 2)[0]] + ["", "é ß 日本", "x" * 3_000_000, "\n\n", "a a a b"]
    together = quality.statistics(pa.array(texts))
    alone = np.concatenate([quality.statistics(pa.array([t])) for t in texts])
    assert np.allclose(together, alone) and np.isfinite(together).all()


def test_pooling_is_monotone_and_least_squares():
    draw = np.random.Generator(np.random.PCG64(1))
    for _ in range(50):
        v, w = draw.random(12), draw.integers(1, 5, 12).astype(float)
        fitted = quality.pooled(v, w)
        assert (np.diff(fitted) >= -1e-12).all() and np.isclose((fitted * w).sum(), (v * w).sum())
        # the max-min formula of isotonic regression
        mean = lambda a, b: np.average(v[a:b + 1], weights=w[a:b + 1])
        best = [max(min(mean(a, b) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        assert np.allclose(fitted, best)


def test_elimination_inverts():
    draw = np.random.Generator(np.random.PCG64(2))
    half = draw.normal(size=(30, 30))
    matrix = half @ half.T + np.eye(30)
    assert np.allclose(quality.inverse_of(matrix) @ matrix, np.eye(30), atol=1e-6)
