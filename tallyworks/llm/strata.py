"""Ranked lexical search over a length-stratified index.

Documents of one normaliser ``m`` form a stratum. A stratum is stored as segments of bounded size; in a segment the
postings of a term are runs of documents of equal ``tf``. Since ``m`` is fixed there, the impact of a run is computed once
for its ``tf``, not for each posting. The greatest tf of each term bounds what any document of the
segment can score, and these bounds order the visits: each query first visits the segment of the highest
bound, whose scores give a floor under its k-th best score, and then only those segments that can reach
the floor. What it finds there is merged. No bound or floor drops a document that belongs to the result.

Queries are the distinct texts of the items, in blocks of bounded size: a block's terms and floors are all that is sent
to the tasks. Documents are dealt by range of (m, a frozen row number), so equal texts and
equal lengths spread over tasks.

Defined cases: a null or empty text has no terms, so it isn't counted in N and never returned; an item
without terms or matches returns nothing; rows of items that repeat are each answered; rows of documents
that repeat are each ranked; equal scores go by ascending doc_id, null last. Other columns are not read.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.common import whole_text
from tallyworks.workspace import Workspace

K = 20
#: Documents of a segment and bytes of query texts in a block.
SEGMENT, BLOCK_BYTES = 8192, 8 << 20

_UPPER, _LOWER = string.ascii_uppercase.encode(), string.ascii_lowercase.encode()
_KEPT = set(string.ascii_letters.encode()) | set(string.digits.encode()) | set(range(128, 256))
#: Lower-cases A-Z and turns every byte outside terms to a space; bytes beyond ASCII belong to terms.
_FOLD = bytes(b if b in _KEPT else 32 for b in range(256)).translate(bytes.maketrans(_UPPER, _LOWER))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


@dataclass
class Queries:
    """A block of query texts: terms by number, and for each query the terms it holds and how often."""

    vocabulary: dict[bytes, int]
    starts: np.ndarray
    terms: np.ndarray
    repeats: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Queries:
        vocabulary, starts, terms, repeats = {}, [0], [], []
        for text in texts:
            held = Counter(terms_of(text.encode()))
            terms += [vocabulary.setdefault(t, len(vocabulary)) for t in held]
            repeats += held.values()
            starts.append(len(terms))
        return cls(vocabulary, np.array(starts), np.array(terms, np.int64), np.array(repeats, np.int64))

    def weighted(self, weights: np.ndarray) -> np.ndarray:
        """Weight times repeats for each entry of ``terms``."""
        return weights[self.terms] * self.repeats


ROWS = "doc_id long, n long, terms array<int>, tfs array<int>, at long"


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), and the numbers and counts of the vocabulary's terms, for texts that have terms."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.__contains__
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = terms_of(text)
                held = Counter(filter(known, words))
                sizes.append(len(words))
                terms.append([vocabulary[t] for t in held])
                tfs.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int32())), batch.column("at")], ["doc_id", "n", "terms", "tfs", "at"])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"),
                         F.monotonically_increasing_id().alias("at"))
    return narrow.mapInArrow(count, ROWS).filter("n > 0")


SEGMENTS = ("m long, docs array<long>, named array<boolean>, terms array<int>, tops array<int>, tfs array<int>, "
            "runs array<int>, places array<int>, counts array<int>")


def segments(rows: DataFrame, n_docs: int, n_terms: int, limit: int = SEGMENT) -> DataFrame:
    """The index: a row for each segment of a stratum.

    ``terms``, ``tops`` and ``counts`` name its terms, their greatest tf and how many runs each has. ``tfs`` and ``runs``
    are the runs, one for each term and tf with its number of documents; ``places`` are the documents of all
    runs, as places in ``docs``.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segment(m: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            one = pa.Table.from_batches(parts).combine_chunks()
            sizes = np.diff(one.column("terms").combine_chunks().offsets.to_numpy())
            terms = one.column("terms").combine_chunks().flatten().to_numpy()
            tfs = one.column("tfs").combine_chunks().flatten().to_numpy()
            places = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            order = np.lexsort((places, tfs, terms))
            terms, tfs, places = terms[order], tfs[order], places[order]
            new_term = np.flatnonzero(np.diff(terms, prepend=-1))
            new_run = np.flatnonzero((np.diff(terms, prepend=-1) != 0) | (np.diff(tfs, prepend=-1) != 0))
            runs = np.diff(np.append(new_run, len(terms)))
            tops = tfs[np.append(new_term, len(terms))[1:] - 1]
            run_terms = terms[new_run]
            firsts = np.flatnonzero(np.diff(run_terms, prepend=-1))
            counts = np.diff(np.append(firsts, len(run_terms)))
            ids = one.column("doc_id").combine_chunks()
            lists = [ids.fill_null(0), ids.is_valid(), pa.array(run_terms[firsts], pa.int32()), pa.array(tops, pa.int32()),
                     pa.array(tfs[new_run], pa.int32()), pa.array(runs, pa.int32()), pa.array(places, pa.int32()),
                     pa.array(counts, pa.int32())]
            return pa.RecordBatch.from_arrays(
                [pa.array([m], pa.int64()), *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]],
                ["m", "docs", "named", "terms", "tops", "tfs", "runs", "places", "counts"])

        held, rows_held, current = [], 0, None
        for batch in batches:
            ms = batch.column("m").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ms)) + 1), len(ms)] if len(ms) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                while a < b:
                    if current is not None and (ms[a] != current or rows_held == limit):
                        yield segment(current, held)
                        held, rows_held = [], 0
                    current = int(ms[a])
                    take = min(b - a, limit - rows_held)
                    held.append(batch.slice(a, take))
                    rows_held, a = rows_held + take, a + take
        if held:
            yield segment(current, held)

    # widened: 25 * n * N may pass 64 bits before it is divided
    m = F.expr(f"75 + (25 * cast(n as decimal(20,0)) * {n_docs}) div {n_terms}")
    dealt = rows.filter(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs", "at")
    dealt = dealt.repartitionByRange("m", "at").sortWithinPartitions("m", "at")
    made = dealt.select("doc_id", "m", "terms", "tfs").mapInArrow(build, SEGMENTS)
    return made.withColumns({"segment": F.monotonically_increasing_id(), "held": F.size("docs")})


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of the index, lists as numpy arrays."""
    for batch in batches:
        for i in range(batch.num_rows):
            cells = {name: batch.column(name)[i] for name in batch.schema.names}
            yield {name: x.values.to_numpy(zero_copy_only=False) if isinstance(x, pa.ListScalar) else x.as_py()
                   for name, x in cells.items()}


def impacts(tfs: np.ndarray, m: int) -> np.ndarray:
    tfs = tfs.astype(np.int64)
    return (1_000_000_000 * tfs) // (1000 * tfs + 12 * m)


def bounds(queries: Queries, weighted: np.ndarray, m: int, terms: np.ndarray, tops: np.ndarray) -> np.ndarray:
    """For each query the most that a document of the segment can score."""
    most = np.zeros(len(queries.vocabulary), np.int64)
    most[terms] = impacts(tops, m)
    each = np.append(weighted * most[queries.terms], 0)
    sums = np.add.reduceat(each, queries.starts[:-1]) if len(queries.starts) > 1 else np.zeros(0, np.int64)
    return np.where(np.diff(queries.starts) > 0, sums, 0)


def visit(queries: Queries, weighted: np.ndarray, seg: dict, wanted: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple]:
    """(query, doc_id, score) of the segment's k best documents for each wanted query, at its floor or above."""
    runs, places = seg["runs"], seg["places"]
    each = np.repeat(impacts(seg["tfs"], seg["m"]), runs)
    run_ends = np.cumsum(runs)
    ends = run_ends[np.cumsum(seg["counts"]) - 1]
    begins = np.append(0, ends[:-1])
    where = {int(t): i for i, t in enumerate(seg["terms"])}
    ids, named = seg["docs"], seg["named"]
    for q in wanted:
        scores = np.zeros(len(ids), np.int64)
        for e in range(queries.starts[q], queries.starts[q + 1]):
            i = where.get(int(queries.terms[e]))
            if i is not None:
                # a document stands once in the runs of a term
                scores[places[begins[i]:ends[i]]] += weighted[e] * each[begins[i]:ends[i]]
        hit = np.flatnonzero(scores >= max(int(floors[q]), 1))
        if len(hit) > k:
            least = np.partition(scores[hit], len(hit) - k)[len(hit) - k]
            hit = hit[scores[hit] >= least]
        best = hit[np.lexsort((ids[hit], ~named[hit], -scores[hit]))[:k]]
        for d in best:
            yield int(q), int(ids[d]) if named[d] else None, int(scores[d])


FOUND = "query int, doc_id long, score long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, texts: list[str], space: Workspace, k: int = K, limit: int = SEGMENT) -> DataFrame:
    """query (its place in ``texts``), rank, doc_id, score for one block of distinct query texts."""
    queries = Queries.of(texts)
    rows = space.settle(counted(docs, queries.vocabulary), "counts")
    total = rows.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    empty = docs.sparkSession.createDataFrame([], f"{FOUND}, rank int")
    if not total.docs or not len(queries.terms):
        return empty
    # one row for each term of the block: no more than the block's own terms
    held = {r.term: r.df for r in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df")).collect()}
    weights = np.array([math.floor(1000 * math.log((2 * total.docs + 2) / (2 * held.get(i, 0) + 1)))
                        for i in range(len(queries.vocabulary))], np.int64)
    weighted = queries.weighted(weights)
    index = space.settle(segments(rows, total.docs, total.terms, limit), "segments")

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The segment of a task's share that each query had best visit first: k documents and the highest bound."""
        best = np.full((2, len(texts)), -1, np.int64)
        for seg in rows_of(batches):
            most = bounds(queries, weighted, seg["m"], seg["terms"], seg["tops"])
            better = (most > best[0]) & (seg["held"] >= k) & (most > 0)
            best[0][better], best[1][better] = most[better], seg["segment"]
        some = np.flatnonzero(best[0] > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(best[0][some]), pa.array(best[1][some])], ["query", "bound", "segment"])

    tops = index.select("segment", "held", "m", "terms", "tops").mapInArrow(bounded, "query int, bound long, segment long")
    first = tops.groupBy("query").agg(F.max(F.struct("bound", "segment")).getField("segment").alias("segment"))
    plan = first.groupBy("segment").agg(F.collect_list("query").alias("wanted"))
    none = np.zeros(len(texts), np.int64)

    def visited(floors: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for seg in rows_of(batches):
                wanted = seg.get("wanted")
                if wanted is None:
                    most = bounds(queries, weighted, seg["m"], seg["terms"], seg["tops"])
                    wanted = np.flatnonzero((most > 0) & (most >= floors))
                found = list(visit(queries, weighted, seg, wanted, floors, k))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))],
                    ["query", "doc_id", "score"])
        return run

    opening = index.join(plan, "segment").mapInArrow(visited(none), FOUND)
    # one number for each query of the block
    floor = _ranked(opening, k).groupBy("query").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    floors = none.copy()
    for r in floor.filter(F.col("n") >= k).collect():
        floors[r["query"]] = r["floor"]
    return _ranked(index.mapInArrow(visited(floors), FOUND), k)


def rank(docs: DataFrame, items: DataFrame, space: Workspace, k: int = K, limit: int = SEGMENT) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents that score highest for each item."""
    spark = docs.sparkSession
    asked = space.settle(items.select(
        items["item_id"], whole_text(items).alias("said"), F.sha2(whole_text(items), 256).alias("query_key")), "items")
    distinct = space.settle(asked.groupBy("query_key").agg(F.first("said").alias("said")), "queries")
    size = distinct.agg(F.sum(F.octet_length("said"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    out = None
    for block in range(blocks):
        picked = distinct.filter(F.pmod(F.xxhash64("query_key"), F.lit(blocks)) == block).orderBy("query_key").collect()
        if not picked:
            continue
        found = search(docs, [r.said for r in picked], space, k, limit)
        keys = spark.createDataFrame([(i, r.query_key) for i, r in enumerate(picked)], "query int, query_key string")
        found = space.settle(found.join(keys, "query").select("query_key", "rank", "doc_id", "score"), "found")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "query_key string, rank int, doc_id long, score long")
    return asked.join(out, "query_key").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
