"""N-gram Jaccard join by an LSH forest of MinHash signatures with exact verification.

Documents with equal shingle sets form a node. A forest of sorted prefix tries (``forest.py``) holds the nodes'
signatures; matched prefixes are shortened by what the tries show until the target recall. Nodes that match form
candidate groups, and within these every link is verified on the whole shingle sets.

Result: one row per document with class_id (the least doc_id of the documents that links connect),
copy_id (the least doc_id with an equal shingle set) and n_links (other documents with similarity
THRESHOLD or more, copies included). Defined cases: a document without words, or with a null text, links to nothing;
null ids are left out of the least ids, and a class of null ids only has a null class_id; rows that repeat each other
are copies; extra columns are dropped, or kept by ``groups`` unless named like a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import forest, links
from tallyworks.llm.common import content_key, packed, unpacked, whole_text
from tallyworks.llm.shingles import blocks
from tallyworks.workspace import Workspace

THRESHOLD = 0.8
#: From (shingles, number of each text's, set sizes, threshold): each text's keys under which it can be met.
KeysOf = Callable[[np.ndarray, np.ndarray, np.ndarray, float], list]
#: Parts of the bitmap that texts pass before they are shuffled, 4 KB each.
BUCKETS = 512


def node_of(shingles: np.ndarray) -> tuple[bytes, np.ndarray]:
    own = np.unique(shingles)
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest(), own


def signed(docs: DataFrame, threshold: float = THRESHOLD, keys_of: KeysOf | None = None) -> DataFrame:
    """doc_id, all columns but the text as ``_row``, ``_key`` of the content, ``_node``, ``_size`` and ``_keys`` (without
    ``keys_of`` the paths of the forest); no node without words."""
    kind, key = (T.BinaryType(), pa.binary()) if keys_of is None else (T.LongType(), pa.int64())
    keys_of = keys_of or forest.paths
    others = ["doc_id", "_row", "_key"]
    sent = docs.select("doc_id", packed(docs.drop("text")), F.unhex(content_key(docs)).alias("_key"),
                       whole_text(docs).alias("_whole"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, keys = [], [], []
            for shingles, number in blocks(batch.column(batch.num_columns - 1)):
                made = [node_of(x) if len(x) else (None, x) for x in np.split(shingles, np.cumsum(number)[:-1])]
                size = np.array([len(own) for _, own in made])
                found = keys_of(shingles, number, size, threshold)
                nodes += [n for n, _ in made]
                sizes += size.tolist()
                keys += [k if n else None for k, n in zip(found, size, strict=True)]
            arrays = [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(key))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*others, "_node", "_size", "_keys"])

    schema = sent.drop("_whole").schema
    schema = schema.add("_node", "binary").add("_size", "integer").add("_keys", T.ArrayType(kind))
    return sent.mapInArrow(work, schema)


def _shingle_sets(rows: DataFrame) -> DataFrame:
    """(node, shingles) in place of the texts of (text, node, ...), where the text has that node."""
    others = [c for c in rows.columns if c != "text"]
    sent = rows.select(*others, whole_text(rows).alias("_whole"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, at = batch.column(others.index("node")).to_pylist(), 0
            sets = []
            for shingles, number in blocks(batch.column(batch.num_columns - 1)):
                for x in np.split(shingles, np.cumsum(number)[:-1]):
                    node, own = node_of(x) if len(x) else (None, x)
                    sets.append(own.tobytes() if node == wanted[at] else None)
                    at += 1
            kept = pa.array([s is not None for s in sets], pa.bool_())
            out = pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sets, pa.binary())], names=[*others, "shingles"])
            yield out.filter(kept)

    return sent.mapInArrow(work, sent.drop("_whole").schema.add("shingles", "binary"))


def nodes_of(rows: DataFrame, *more: Column) -> DataFrame:
    """(node, size, copies, doc_id, key, copy_id) and ``more`` aggregates: copies are counted where they are read, then by
    node. ``key`` is that of one row with doc_id."""
    return rows.filter(F.col("_node").isNotNull()).groupBy(F.col("_node").alias("node")).agg(
        F.first("_size").alias("size"), F.count("*").alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("_key").alias("key"))).alias("of"),
        F.min("doc_id").alias("copy_id"), *more).select("*", "of.doc_id", "of.key").drop("of")


def edges_of_keys(rows: DataFrame, space: Workspace) -> DataFrame:
    """(a, b) from each node to the least one with a key in common."""
    spread = rows.filter(F.col("_node").isNotNull()).select(F.col("_node").alias("node"), F.explode("_keys").alias("key"))
    met = spread.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least != most")
    met = space.settle(met.select("key", "least"), "matches")
    # sort-merged at every size, as on a cluster: none of these sides has a bound
    edges = spread.join(met.hint("merge"), "key").filter("node != least")
    return edges.select(F.col("node").alias("a"), F.col("least").alias("b"))


def candidates(edges: DataFrame, nodes: DataFrame, space: Workspace) -> DataFrame:
    """(node, size, copies, doc_id, key, grp) of the nodes that ``edges`` (a, b) connect."""
    groups = space.settle(links.components(edges, space).withColumnRenamed("root", "grp"), "groups")
    held = nodes.join(groups.hint("merge"), "node")
    return space.settle(held.select("node", "grp", "size", "copies", "doc_id", "key"), "candidates")


def _passing(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of (key, ...) whose key may be among ``wanted``: all that are, and of the others few. A bitmap of fixed
    size goes to every task, so that most texts that no candidate needs are not shuffled."""
    def at(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(BUCKETS << 15)) + 1

    bits = wanted.select(at("key").alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    placed = docs.withColumn("place", F.bitmap_bit_position(at("key"))).withColumn("bucket", F.bitmap_bucket_number(at("key")))
    met = placed.join(F.broadcast(bits), "bucket")
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.shiftright("place", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (F.col("place") % 8 + 1).cast("int"))
    return met.filter(byte.bitwiseAND(bit) != 0).select(*docs.columns)


def groups(docs: DataFrame, space: Workspace, threshold: float = THRESHOLD, keys_of: KeysOf | None = None) -> DataFrame:
    """The frame without text, with _node, class_id, copy_id, n_links and _group (the class's key)."""
    others = unpacked(docs.drop("text"), "_node", "class_id", "copy_id", "n_links", "_group")
    rows = space.settle(signed(docs, threshold, keys_of), "signed")
    return linked(docs, rows, space, threshold, keys_of is None).select(*others, "_node", "class_id", "copy_id", "n_links", "_group")


def linked(docs: DataFrame, rows: DataFrame, space: Workspace, threshold: float = THRESHOLD,
           in_forest: bool = False) -> DataFrame:
    """``rows`` (doc_id, _key, _node, _size, _keys and others) of ``docs`` with class_id, copy_id, n_links and _group.

    ``_keys`` are the paths of the forest, or else keys under which equal ones meet."""
    if in_forest:
        nodes = space.settle(nodes_of(rows, F.first("_keys").alias("paths")), "nodes")
        edges = forest.edges(nodes.select("node", "size", "paths"), space, threshold)
    else:
        nodes = space.settle(nodes_of(rows), "nodes")
        edges = edges_of_keys(rows, space)
    found = candidates(edges, nodes, space)
    plan = links.block_plan(found.select("node", "size", "grp"), threshold, space)
    # a node's text is that of its row with the least id and key; only rows that repeat both bring it again
    wanted = found.select("node", "copies", F.col("doc_id").alias("of"), "key")
    named = docs.select(F.col("doc_id").alias("id"), F.unhex(content_key(docs)).alias("key"), F.col("text"))
    texts = _passing(named, wanted).alias("t").join(
        wanted.alias("w").hint("merge"), (F.col("t.key") == F.col("w.key")) & F.col("id").eqNullSafe(F.col("of")))
    sets = _shingle_sets(texts.select("text", "node", "copies")).groupBy("node").agg(
        F.first("copies").alias("copies"), F.first("shingles").alias("shingles"))
    checked = space.settle(links.verified(sets.join(plan, "node"), threshold), "verified")
    counted = checked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = links.components(checked.select(F.col("node").alias("a"), F.col("root").alias("b")), space)
    known = (nodes.join(counted, "node", "left").join(roots, "node", "left")
             .filter((F.col("copies") > 1) | F.col("links").isNotNull())
             .select("node", "copies", "copy_id", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("root", "node").alias("root")))
    known = space.settle(known, "known")
    least = known.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    known = space.settle(known.join(least, "root"), "classes")
    return rows.join(known.hint("merge"), F.col("_node") == F.col("node"), "left").select(
        *[rows[c] for c in rows.columns],
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).alias("n_links"),
        F.coalesce("root", "_node").alias("_group"))


def join(docs: DataFrame, space: Workspace, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id, copy_id, n_links."""
    return groups(docs.select("doc_id", "text"), space, threshold).select("doc_id", "class_id", "copy_id", "n_links")
