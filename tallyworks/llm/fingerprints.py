"""MinHash fingerprints of documents, of half-edited documents, and near duplicates by signature bands.

A fingerprint is PERMUTATIONS minima of universal hash functions over a text's word shingles, 16 bits of
each as hex. The likeness of two fingerprints is the share of equal minima, an estimate of the Jaccard
similarity.

Documents follow each other by descending doc_id, nulls last, rows of one id by content key; the last is followed by
the first. To hand each document the next one's text, rows are dealt to ranges of that order, and
each range gets a copy of the row that follows it. Range borders come from a sample of keys, a bounded number for each
partition.

Defined cases: a null text is empty; an empty text has the fingerprint of no shingles, like only to
itself; a lone document follows itself; rows that repeat doc_id and text follow one another.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import ngram_join
from tallyworks.llm.common import content_key, whole_text
from tallyworks.llm.shingles import Permutations, blocks, mixed
from tallyworks.workspace import Workspace

PERMUTATIONS = 128
#: Bands by which near duplicates meet: 32 of 4 minima miss a pair of similarity 0.8 once in 2 * 10**7.
BANDS = 32
THRESHOLD = 0.8
#: Keys in the sample for each range.
SAMPLED = 50

#: Bytes of a fingerprint in one band.
BAND_BYTES = PERMUTATIONS // BANDS * 2

FOLLOWS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _nodes(texts: pa.StringArray, functions: Permutations) -> tuple[np.ndarray, list[bytes | None], list[int]]:
    """The texts' signatures, nodes and numbers of different shingles."""
    signs, nodes, sizes = [np.zeros((0, PERMUTATIONS), np.uint16)], [], []
    for shingles, number in blocks(texts):
        signs.append((functions.minima(shingles, number) & 0xFFFF).astype(np.uint16))
        for x in np.split(shingles, np.cumsum(number)[:-1]):
            node, own = ngram_join.node_of(x) if len(x) else (None, x)
            nodes.append(node)
            sizes.append(len(own))
    return np.concatenate(signs), nodes, sizes


def signatures(texts: pa.StringArray, functions: Permutations) -> np.ndarray:
    """(texts, PERMUTATIONS) of the lower 16 of 32 bits of each minimum; all ones for a text without shingles."""
    found = [functions.minima(*block) for block in blocks(texts)]
    if not found:
        return np.zeros((0, PERMUTATIONS), np.uint16)
    return (np.concatenate(found) & 0xFFFF).astype(np.uint16)


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def _ranges(docs: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """The rows with their order (``unnamed``, ``descending``, ``key``) and range ``part``."""
    ordered = docs.select(
        "doc_id", whole_text(docs).alias("text"), docs["doc_id"].isNull().alias("unnamed"),
        F.coalesce(-docs["doc_id"], F.lit(0)).cast("long").alias("descending"), content_key(docs).alias("key"))
    every = max(1, docs.count() // (SAMPLED * parts))
    picked = ordered.filter(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).select("unnamed", "descending", "key")
    sample = sorted(tuple(r) for r in picked.collect())
    borders = sorted({sample[k * len(sample) // parts] for k in range(1, parts)} if sample else set())

    @F.pandas_udf(T.IntegerType())
    def part_of(unnamed: pd.Series, descending: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(borders, k) for k in zip(unnamed, descending, key, strict=True)], dtype="int32")

    return ordered.withColumn("part", part_of("unnamed", "descending", "key")), len(borders) + 1


def _with_next(docs: DataFrame, space: Workspace) -> DataFrame:
    """Rows in order by range; behind those of a range a row marked ``lent``, the one that follows."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, ranges = _ranges(docs, parts)
    order = F.struct("unnamed", "descending", "key")
    firsts = rows.groupBy("part").agg(F.min(order).alias("first"))
    by_part = Window.orderBy("part")  # one row for each range
    start = F.min(F.struct("part", "first")).over(Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)).getField("first")
    lent_to = space.settle(firsts.select(
        F.col("part").alias("to"), F.coalesce(F.lead("first").over(by_part), start).alias("first")).select("to", "first.*"),
        "firsts")
    lent = (rows.drop("part").join(lent_to, ["unnamed", "descending", "key"]).groupBy("to").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "text", "unnamed", "descending", "key")])
        .withColumnRenamed("to", "part").withColumn("lent", F.lit(True)))
    all_rows = rows.withColumn("lent", F.lit(False)).unionByName(lent)
    return (all_rows.repartitionById(ranges, F.col("part"))
            .sortWithinPartitions("part", "lent", "unnamed", "descending", "key").select("doc_id", "lent", "text", F.unhex("key").alias("key")))


def _followed(docs: DataFrame, space: Workspace) -> DataFrame:
    """The columns FOLLOWS, with fingerprints as bytes, ``_node`` and ``_size`` of the text's shingle set, and the content's ``_key``."""
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
              "near_edited double, near_next double, _node binary, _size integer, _key binary")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = Permutations(PERMUTATIONS, 2)
        held: tuple | None = None  # a document whose next one isn't known yet: (id, text, signature, node, size, key)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, lent, texts, keys = (batch.column(k).to_pylist() for k in range(4))
            signs, nodes, sizes = _nodes(batch.column(2), functions)
            own, nexts, next_signs = [], [], []
            for i, text in enumerate(texts):
                if held is not None:
                    own.append(held)
                    nexts.append(text)
                    next_signs.append(signs[i])
                held = None if lent[i] else (ids[i], text, signs[i], nodes[i], sizes[i], keys[i])
            if not own:
                continue
            changed = [edited(x[1], following) for x, following in zip(own, nexts, strict=True)]
            a, b = np.stack([x[2] for x in own]), np.stack(next_signs)
            c = signatures(pa.array(changed, pa.large_string()), functions)
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in own], pa.int64()), pa.array([len(x[1]) for x in own], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed]),
                pa.array([x.tobytes() for x in a]), pa.array([x.tobytes() for x in c]),
                pa.array(likeness(a, c)), pa.array(likeness(a, b)),
                pa.array([x[3] for x in own], pa.binary()), pa.array([x[4] for x in own], pa.int32()),
                pa.array([x[5] for x in own], pa.binary())], names=[*FOLLOWS, "_node", "_size", "_key"])

    return _with_next(docs, space).mapInArrow(work, schema)


def _shown(rows: DataFrame, *others: str) -> DataFrame:
    prints = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return rows.withColumns(prints).select(*FOLLOWS, *others)


def follow(docs: DataFrame, space: Workspace) -> DataFrame:
    """One row per document with its fingerprint, its edited text's, and their likeness (columns FOLLOWS)."""
    return _shown(_followed(docs, space))


def compare(docs: DataFrame, space: Workspace, threshold: float = THRESHOLD) -> DataFrame:
    """``follow`` with the near duplicates of each document: class_id, copy_id and n_links as in ``near_duplicates``.

    The rows are written once with their fingerprints; bands are cut from these, so that texts are signed once and
    read again only for nodes that share a band. Bands of 16-bit minima match wherever those of ``band_keys`` do.
    """
    rows = space.settle(_followed(docs, space), "followed")
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("fingerprint", k * BAND_BYTES + 1, BAND_BYTES)) for k in range(BANDS)])
    return _shown(ngram_join.linked(docs, rows.withColumn("_keys", keys), space, threshold), "class_id", "copy_id", "n_links")


def near_duplicates(docs: DataFrame, space: Workspace, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, copy_id, n_links): nodes that share a band of their signatures are verified exactly."""
    return ngram_join.groups(docs.select("doc_id", "text"), space, threshold, band_keys).select(
        "doc_id", "class_id", "copy_id", "n_links")


def band_keys(shingles: np.ndarray, number: np.ndarray, sizes: np.ndarray, threshold: float) -> list[np.ndarray]:
    found = Permutations(PERMUTATIONS, 2).minima(shingles, number).astype(np.uint64).reshape(len(number), BANDS, -1)
    keys = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))[None, :]
    for k in range(found.shape[2]):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + found[:, :, k] + np.uint64(1))
    return list(keys.view(np.int64))
