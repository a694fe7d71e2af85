"""Exact top-k search by integer inner product: MaxScore over dense vectors, shard by shard.

A vector's components are terms: a query's terms are its components, a term's postings hold the candidates'
components of that place. Within a shard each term's postings have a least and a greatest value. What a posting adds
above the term's least contribution is its impact; the greatest impact bounds the term. A query's terms are ordered by
that bound. Terms whose bounds together stay below the floor (the k-th best score so far) are non-essential: no
candidate can enter by them alone. Candidates are visited in blocks of DOCS; the essential postings of a block are
traversed, and the other terms are probed, PROBED at a time from the highest bound, only for candidates whose score and
remaining bound reach the floor. The floor rises from block to block, so the essential set shrinks. Ties at the floor
stay competitive. Shards are merged by rank.

Queries meet candidates in blocks: each shard row holds up to SHARD vectors and each query block is sent to
every shard. What leaves a task is k rows for each query and shard.

Defined cases: a vector that is null, empty or holds a null or non-finite component, also one that ceases to be finite
when scaled, takes no part; vectors of
different lengths share no score and meet only those of their own length; a query sees fewer than k rows if there are fewer candidates;
a repeated vec_id is a query and a candidate for each of its rows, except that no row of an id is a candidate of
that id; a null vec_id is no query, and its rank among ties is last. Scores are exact at every size of component and
ranked so; one beyond 64 bits is shown as the end of the range of ``long``.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.workspace import Workspace

K, EVERY, SCALE = 5, 50, 256
#: Candidates of a shard and queries of a block.
SHARD, QUERIES = 4096, 4096
#: Candidates visited between two floors, and terms probed at once.
DOCS, PROBED = 1024, 16
#: Stands for a null vec_id inside a task.
UNNAMED = -(2**62)
LEAST, MOST = -(2**63), 2**63 - 1


def quantized(vectors: DataFrame) -> DataFrame:
    """(vec_id, width, terms): floor(SCALE * x) of each component, an integer held by a double, of the vectors that
    take part."""
    def scaled(x: Column) -> Column:
        return x.cast("double") * SCALE

    def floored(x: Column) -> Column:
        # from 2 ** 53 on every double is an integer, and floor() would end at 2 ** 63
        return F.when(F.abs(scaled(x)) < 2**53, F.floor(scaled(x)).cast("double")).otherwise(scaled(x))

    sound = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(scaled(x)) == float("inf")))
    return vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("width"),
        F.transform("embedding", floored).alias("terms"))


def exact(*numbers: np.ndarray) -> list[np.ndarray]:
    """Both arrays in the fastest type that holds every score and bound of theirs exactly."""
    bound = numbers[0].shape[1]
    for some in numbers:
        bound *= max(int(abs(some).max(initial=0)), 1)
    if bound < 2**50:
        return [some.astype(np.float64) for some in numbers]
    if bound < 2**60:
        return [some.astype(np.int64) for some in numbers]
    return [np.frompyfunc(int, 1, 1)(some) for some in numbers]


def max_score(queries: np.ndarray, query_ids: np.ndarray, terms: np.ndarray, ids: np.ndarray, k: int,
              work: Counter | None = None) -> list[tuple[int, int, int]]:
    """(query number, candidate number, score) of each query's k best candidates of the shard, ties to the smaller id.

    ``ids`` ascend, so that of equal scores the first is the one to keep. ``work`` counts the postings traversed and
    the probes.
    """
    work = Counter() if work is None else work
    queries, terms = exact(queries, terms)
    low, high = terms.min(axis=0), terms.max(axis=0)
    columns = np.ascontiguousarray(terms.T)
    out = []
    for n, query in enumerate(queries):
        least, most = np.minimum(query * low, query * high), np.maximum(query * low, query * high)
        order = np.argsort(least - most, kind="stable")  # highest bound first
        query, least, bounds = query[order], least[order], (most - least)[order]
        # scores are counted from the sum of the least contributions
        rest = np.concatenate([np.cumsum(bounds[::-1])[::-1], [0]])
        other = ids != query_ids[n]
        others = np.flatnonzero(other)
        floor = 0
        if len(others) > k:
            # the k-th best of some candidates' whole scores is a floor for the k-th best of all
            first = others[np.argpartition(columns[order[0], others] * query[0], len(others) - k)[-k:]]
            floor = (terms[first][:, order] @ query - least.sum()).min()
        best: list[tuple] = []
        for at in range(0, len(ids), DOCS):
            # the bounds from here on stay below the floor: non-essential
            essential = min(int((rest >= floor).sum()), len(order))
            scores = query[:essential] @ columns[:, at:at + DOCS][order[:essential]] - least[:essential].sum()
            work["postings"] += essential * len(scores)
            mine = other[at:at + DOCS]
            alive, scores = np.flatnonzero(mine) + at, scores[mine]
            done = essential
            while len(alive):
                competing = scores + rest[done] >= floor
                alive, scores = alive[competing], scores[competing]
                if done == len(order):
                    break
                some = slice(done, min(done + PROBED, len(order)))
                scores = scores + query[some] @ columns[order[some, None], alive] - least[some].sum()
                work["probes"] += len(query[some]) * len(alive)
                done = some.stop
            best = sorted([*best, *zip((-scores).tolist(), alive.tolist(), strict=True)])[:k]
            if len(best) == k:
                floor = max(floor, -best[-1][0])
        base = int(least.sum())
        out += [(n, candidate, base - int(score)) for score, candidate in best]
    return out


def beyond(score: int) -> str | None:
    """Orders, as text, the scores that both ends of ``long`` stand for; null in between."""
    if LEAST < score < MOST:
        return None
    digits = str(abs(score))
    if score > 0:
        return f"{len(digits):04d}{digits}"
    return f"{9999 - len(digits):04d}" + "".join(str(9 - int(d)) for d in digits)


def _search(k: int) -> object:
    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            ids = right["vec_id"].astype("Int64")
            order = np.lexsort((ids.fillna(0).astype("int64"), ids.isna()))
            right = right.iloc[order]
            terms = np.array(right["terms"].tolist(), np.float64)
            names = right["vec_id"].astype("Int64").fillna(UNNAMED).to_numpy(np.int64)
            own, copies = left["vec_id"].to_numpy(np.int64), left["copy"].to_numpy()
            for n, m, score in max_score(np.array(left["terms"].tolist(), np.float64), own, terms, names, k):
                found.append((own[n], copies[n], None if names[m] == UNNAMED else names[m],
                              min(max(score, LEAST), MOST), beyond(score)))
        out = pd.DataFrame(found, columns=["query_id", "copy", "vec_id", "score", "beyond"])
        return out.astype({"query_id": "int64", "copy": "int64", "vec_id": "Int64", "score": "int64"})

    return search


def top_k(vectors: DataFrame, space: Workspace, k: int = K, every: int = EVERY, per_shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other vectors of each vector whose id is divisible by ``every``."""
    rows = space.settle(quantized(vectors).withColumn("copy", F.monotonically_increasing_id()), "vectors")
    asked = rows.filter(F.col("vec_id") % every == 0)
    shards, blocks = max(1, -(-rows.count() // per_shard)), max(1, -(-asked.count() // QUERIES))
    # each block of queries goes to every shard, and each shard to every block
    dealt = rows.select("*", F.pmod(F.xxhash64("vec_id", "copy"), F.lit(shards)).cast("int").alias("shard"),
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    sent = asked.select("*", F.pmod(F.xxhash64("copy"), F.lit(blocks)).cast("int").alias("block"),
                        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    found = sent.groupBy("width", "shard", "block").cogroup(dealt.groupBy("width", "shard", "block")).applyInPandas(
        _search(k), "query_id long, copy long, vec_id long, score long, beyond string")
    best = Window.partitionBy("query_id", "copy").orderBy(
        F.desc("score"), F.desc_nulls_last("beyond"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
