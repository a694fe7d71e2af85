"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each text gives a few statistics of its bytes, words and lines. FEATURES random cosines of the
standardised statistics approximate a Gaussian kernel. Partitions of the training rows sum their parts of the
normal equations, and the driver solves the small system. Scores of training rows are taken as if
each row had been left out (from its leverage), summed into bins of all training rows, and pooled to a monotone curve that
turns scores into probabilities.

Training rows are labelled rows outside the held-out quarter, at most about TRAIN_ROWS of them, chosen by hash.
Nothing but the text enters a score.

Defined cases: a null text is scored as an empty one; a null id is not held out and has no label;
labels other than 0 and 1 are left out; an id labelled twice counts twice; without a training row of both kinds the score
is the mean label, or 0.5 without any. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import whole_text
from tallyworks.llm.shingles import text_blocks, word_hashes
from tallyworks.workspace import Workspace

#: Labelled rows that training reads at most, about.
TRAIN_ROWS = 200_000
FEATURES, WIDTH, RIDGE, BINS = 512, 4.0, 1e-3, 512
CUT = 0.7
#: Partitions that sum normal equations; each sends one FEATURES x FEATURES matrix.
SUMS = 8
FOLDS, HELD = 4, 2

_CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\r", "\n", ".,;:?'\"()-",
            "|", "!", "#$%&*", "@/<>[]{}=+_\\^`~")
STATISTICS = 8 + len(_CLASSES) + 4


def held_out(docs: DataFrame) -> Column:
    return F.coalesce(F.pmod(F.crc32(docs["doc_id"].cast("string")), F.lit(FOLDS)) == HELD, F.lit(False))


def _of_text(totals: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Differences of running totals between the ends of texts."""
    return np.diff(totals[np.concatenate([[0], ends])], axis=0)


def _statistics(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(texts, STATISTICS), shares mostly, so that length says little."""
    kind = np.full(256, len(_CLASSES), np.uint8)
    for k, members in enumerate(_CLASSES):
        kind[[ord(c) for c in members]] = k
    size = np.diff(ends, prepend=0).astype(float)
    some = np.maximum(size, 1)
    kinds = kind[data]
    shares = np.stack([_of_text(np.concatenate([[0], np.cumsum(kinds == k)]), ends) for k in range(len(_CLASSES) + 1)], 1) / some[:, None]
    words, counts = word_hashes(data, ends)
    last = np.cumsum(counts)
    text_of = np.repeat(np.arange(len(counts)), counts)
    n = np.maximum(counts, 1)
    again = np.zeros(len(words) + 1)
    if len(words) > 1:
        again[2:] = np.cumsum((words[1:] == words[:-1]) & (text_of[1:] == text_of[:-1]))
        again[1] = 0
    order = np.lexsort((words, text_of))
    fresh = np.ones(len(words), bool)
    if len(words) > 1:
        fresh[1:] = (words[order][1:] != words[order][:-1]) | (text_of[order][1:] != text_of[order][:-1])
    different = np.bincount(text_of[order][fresh], minlength=len(counts)) if len(words) else np.zeros(len(counts))
    lines = shares[:, 4] * size + 1
    letters = shares[:, 0] + shares[:, 1]
    return np.column_stack([
        np.log1p(size), np.log1p(counts), size / n / 10, different / n, different / np.sqrt(n) / 10,
        _of_text(again, last) / n, np.log1p(n / lines), shares, np.sqrt(shares[:, [6, 7, 8]]),
        shares[:, 0] / np.maximum(letters, 1e-9)])


def statistics(texts: pa.StringArray) -> np.ndarray:
    found = [_statistics(*block) for block in text_blocks(texts)]
    return np.concatenate(found) if found else np.zeros((0, STATISTICS))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    curve: tuple[np.ndarray, np.ndarray]

    def kernel(self, x: np.ndarray) -> np.ndarray:
        return kernel_features(x, self.mean, self.scale)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.kernel(x) @ self.weights
        at, level = self.curve
        return np.clip(np.interp(raw, at, level), 0, 1)


def kernel_features(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    draw = np.random.Generator(np.random.PCG64(7))
    directions = draw.normal(0, 1 / WIDTH, (STATISTICS, FEATURES - 1))
    phases = draw.uniform(0, 2 * np.pi, FEATURES - 1)
    z = np.clip((x - mean) / scale, -6, 6)
    waves = np.cos(z @ directions + phases) * np.sqrt(2 / (FEATURES - 1))
    return np.column_stack([waves, np.ones(len(x))])


def pooled(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The monotone means nearest to the values: neighbours out of order are pooled."""
    stack: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        stack.append([v, w, 1])
        while len(stack) > 1 and stack[-2][0] >= stack[-1][0]:
            v2, w2, n2 = stack.pop()
            v1, w1, n1 = stack.pop()
            stack.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in stack]) if stack else np.zeros(0)


def inverse_of(matrix: np.ndarray) -> np.ndarray:
    """Of a positive definite matrix, by elimination.

    The driver stays out of BLAS: a thread pool made before the JVM is started can hang there.
    """
    n = len(matrix)
    both = np.concatenate([matrix, np.eye(n)], axis=1)
    for k in range(n):
        both[k] /= both[k, k]
        column = both[:, k].copy()
        column[k] = 0
        both -= column[:, None] * both[k]
    return both[:, n:]


def _training_rows(docs: DataFrame, labels: DataFrame, space: Workspace) -> DataFrame:
    """(x, y): statistics and label; the texts' statistics are narrow before they meet the labels."""
    known = labels.filter(F.col("quality").isin(0, 1)).filter(~held_out(labels)).select(
        F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("y"))
    n = known.count()
    if n > TRAIN_ROWS:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * TRAIN_ROWS / n))
    learnt = docs.filter(~held_out(docs)).select("doc_id", whole_text(docs).alias("whole"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), STATISTICS).cast(pa.list_(pa.float64()))],
                names=["doc_id", "x"])

    x = learnt.mapInArrow(work, "doc_id long, x array<double>")
    return space.settle(x.join(known, F.col("doc_id") == F.col("id")).select("x", "y"), "training")


def _sums(rows: DataFrame, made: object) -> list[np.ndarray]:
    """``made(x, y)`` of batches, summed in each of SUMS partitions and then here: a few matrices of fixed size."""
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(0).flatten()).reshape(batch.num_rows, -1)
                part = made(x, np.array(batch.column(1)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    return [np.frombuffer(r["part"]) for r in rows.select("x", "y").coalesce(SUMS).mapInArrow(work, "part binary").collect()]


def fit(docs: DataFrame, labels: DataFrame, space: Workspace) -> Model:
    rows = _training_rows(docs, labels, space)
    first = sum(_sums(rows, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(0), (x * x).sum(0)])))
    flat = np.zeros(STATISTICS), np.ones(STATISTICS)
    if isinstance(first, int) or not 0 < first[1] < first[0]:
        rate = 0.5 if isinstance(first, int) else first[1] / first[0]
        return Model(*flat, np.zeros(FEATURES), (np.zeros(1), np.full(1, rate)))
    n, mean = first[0], first[2:2 + STATISTICS] / first[0]
    scale = np.sqrt(np.maximum(first[2 + STATISTICS:] / n - mean * mean, 0)) + 1e-6

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = kernel_features(x, mean, scale)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    second = sum(_sums(rows, normal))
    gram = second[:-FEATURES].reshape(FEATURES, FEATURES) + RIDGE * n / FEATURES * np.eye(FEATURES) + np.eye(FEATURES) * 1e-2
    inverse = inverse_of(gram)
    weights = (inverse * second[-FEATURES:]).sum(1)

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = kernel_features(x, mean, scale)
        raw, leverage = z @ weights, np.minimum(((z @ inverse) * z).sum(1), 0.99)
        left_out = (raw - leverage * y) / (1 - leverage)
        at = np.clip(((left_out + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS).astype(float), np.bincount(at, y, BINS)])

    bins = sum(_sums(rows, binned))
    count, ones = bins[:BINS], bins[BINS:]
    used = np.flatnonzero(count)
    middle = (used + 0.5) / BINS * 2 - 0.5
    return Model(mean, scale, weights, (middle, pooled(ones[used] / count[used], count[used])))


def apply(docs: DataFrame, model: Model) -> DataFrame:
    """The frame with held_out, score and predicted."""
    new = ("held_out", "score", "predicted")
    others = [c for c in docs.columns if c not in new]
    sent = docs.select(*[docs[c] for c in others], held_out(docs).alias("held_out"), whole_text(docs).alias("_whole"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(statistics(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(score), pa.array((score >= CUT).astype(np.int32))], names=[*others, *new])

    return sent.mapInArrow(work, sent.drop("_whole").schema.add("score", "double").add("predicted", "integer"))


def classify(docs: DataFrame, labels: DataFrame, space: Workspace) -> DataFrame:
    return apply(docs, fit(docs, labels, space))
