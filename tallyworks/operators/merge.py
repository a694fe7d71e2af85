"""Dimension upsert, key resolution and which facts a load replaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.numbering import dense_numbers
from tallyworks.workspace import Workspace


def last_key(df: DataFrame, key: str) -> int:
    return df.agg(F.coalesce(F.max(key), F.lit(0)).alias("k")).first()["k"]


def upsert_dim(
    existing: DataFrame,
    incoming: DataFrame,
    id_column: str,
    key_column: str,
    space: Workspace,
    now: Column | None = None,
) -> DataFrame:
    """Merge a dimension: matched rows take every incoming attribute, nulls too, and keep their
    key; unmatched existing rows stay; new ids get the next keys in id order. Nothing is deleted.
    """
    attributes = [c for c in incoming.columns if c != id_column]
    stamp = F.current_timestamp() if now is None else now
    old = existing.withColumnsRenamed({c: f"_old_{c}" for c in attributes})
    arriving = F.col("_arriving")
    merged = old.join(incoming.withColumn("_arriving", F.lit(True)), id_column, "full_outer")
    merged = merged.select(
        key_column,
        id_column,
        *[F.when(arriving, F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in attributes],
        F.when(arriving, stamp).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    merged = space.settle(merged, f"{id_column}-merged")
    fresh = merged.where(F.col(key_column).isNull()).drop(key_column)
    numbered = dense_numbers(
        fresh, space, key_column, order=id_column, start=last_key(existing, key_column) + 1
    )
    return merged.where(F.col(key_column).isNotNull()).unionByName(numbered)


def resolve_keys(facts: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Swap natural for surrogate keys. An id without a key fails the job: it is never dropped
    and never becomes null. The dimensions broadcast by their size or sort-merge; a customer
    on a third of the facts is then split at run time."""
    def strict(key: str, natural: str) -> Column:
        message = F.concat(
            F.lit("row "), F.col("row_num").cast("string"), F.lit(f": {natural} "),
            F.col(natural), F.lit(" has no surrogate key"),
        )
        return F.coalesce(key, F.raise_error(message).cast("bigint")).alias(key)

    kept = [c for c in facts.columns if c not in ("customer_id", "product_id")]
    return (
        facts.join(customers.select("customer_id", "customer_key"), "customer_id", "left")
        .join(products.select("product_id", "product_key"), "product_id", "left")
        .select(
            *kept,
            strict("customer_key", "customer_id"),
            strict("product_key", "product_id"),
        )
    )


def last_file_wins(facts: DataFrame, files: DataFrame, space: Workspace) -> DataFrame:
    """Keep one fact per order id when several files of a load hold it: that of the last name.

    ``files`` has one row per file, with its place ``file_no`` by name. Collisions are found on two narrow columns
    and joined back.
    """
    ranked = files.select("source_file", F.col("file_no").alias("_file_no"))
    placed = facts.join(ranked, "source_file")
    clashes = (
        placed.groupBy("order_id")
        .agg(F.max("_file_no").alias("_winner"), F.min("_file_no").alias("_low"))
        .where("_winner > _low")
        .select("order_id", "_winner")
    )
    clashes = space.settle(clashes, "clashes")
    return (
        placed.join(clashes, "order_id", "left")
        .where("_winner is null or _winner = _file_no")
        .drop("_winner", "_file_no")
    )


def doomed_orders(staged: DataFrame, load: DataFrame, files: DataFrame) -> DataFrame:
    """Order ids whose facts a load replaces: those staged earlier for its files, and its own."""
    earlier = staged.join(files.select("source_file"), "source_file", "left_semi")
    return earlier.select("order_id").union(load.select("order_id")).distinct()
