"""From raw documents to token ids: quality, line dedup, near duplicates, mixture, encoding.

Each stage takes what the one before kept, with the columns of ``documents``; the last one returns ids.
All stages treat a null text as empty, keep null ids and take repeated rows as their operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import bpe, line_dedup, mixing, ngram_join, quality
from tallyworks.llm.common import content_key, small_batches, table
from tallyworks.workspace import Workspace

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it learns from the labels of those in ``docs``."""
    small_batches(spark)
    judged = quality.classify(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), Workspace(spark))
    return judged.filter(F.col("predicted") == 1).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of repeated three-line windows; a document that loses all its lines goes."""
    small_batches(spark)
    cleaned = line_dedup.dedup(docs.select(*COLUMNS))
    kept = cleaned.filter((F.col("n_removed") == 0) | (F.trim("text") != ""))
    size = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return kept.withColumn("n_chars", size).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of least doc_id, of equal ids that of least content key.

    Documents without words link to nothing and stay. Rows that repeat doc_id and text are copies.
    """
    small_batches(spark)
    space = Workspace(spark)
    docs = docs.select(*COLUMNS)
    named = docs.select("doc_id", "text", content_key(docs).alias("content"))
    grouped = ngram_join.groups(named, space)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "content")
    own = F.coalesce("_group", F.concat(F.lit("without words").cast("binary"), F.col("content").cast("binary")))
    first = grouped.groupBy(own.alias("group")).agg(F.min(order).alias("kept")).select(
        F.col("kept.doc_id").alias("id"), F.col("kept.content").alias("content")).distinct()
    first = space.settle(first, "kept")
    kept = docs.withColumn("_content", content_key(docs)).join(
        first, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("_content") == F.col("content")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_content"]).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mixture reads at least half of them."""
    return mixing.train_order(docs.select(*COLUMNS), Workspace(spark))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens, ids (packed) and the digest of the bytes decoded from them."""
    small_batches(spark)
    coded = bpe.encode(docs.select(*COLUMNS), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram jaccard join", keep_one_of_near_copies),
    ("mixing sources", mix),
    ("byte-level bpe", encode),
]

#: The classifier and the encoder have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = space.settle(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
