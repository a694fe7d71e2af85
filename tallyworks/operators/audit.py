"""Table constraints as counted violations: columns ``table_name, constraint_name, violations``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.schemas import NULLABLE, TABLES


def value_checks(name: str) -> dict[str, Column]:
    """Conditions every row of the table must meet."""
    if name not in ("stg_sales", "fact_sales"):
        return {}
    return {
        "quantity > 0": F.col("quantity") > 0,
        "unit_price > 0": F.col("unit_price") > 0,
        "0 <= discount_rate < 1": (F.col("discount_rate") >= 0) & (F.col("discount_rate") < 1),
    }


UNIQUE = {
    "fact_sales": ("order_id",),
    "dim_customers": ("customer_id",),
    "dim_products": ("product_id",),
    "etl_run_log": ("run_id",),
}


def row_violations(df: DataFrame, name: str) -> DataFrame:
    """NOT NULL and value checks of one table, all in one pass over it."""
    required = [
        column for column in TABLES[name]
        if column in df.columns and column not in NULLABLE[name]
    ]
    broken = {f"{c} not null": F.col(c).isNull() for c in required}
    broken |= {label: ~holds for label, holds in value_checks(name).items()}
    counted = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(broken.values())])
    rows = F.array(
        *[
            F.struct(F.lit(label).alias("constraint_name"), F.col(f"c{i}").alias("violations"))
            for i, label in enumerate(broken)
        ]
    )
    return counted.select(F.lit(name).alias("table_name"), F.inline(rows))


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values of a unique column that occur more than once, with how often."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique_violations(df: DataFrame, name: str, column: str) -> DataFrame:
    return repeated_values(df, column).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("table_name"),
        F.lit(f"{column} unique").alias("constraint_name"),
        "violations",
    )


def orphan_counts(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows per key that the dimension lacks. Facts are counted by key before the join, so
    a key on a third of the rows is one row there."""
    counted = facts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(dim.select(key), key, "left_anti")


def foreign_key_violations(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    total = F.coalesce(F.sum("n"), F.lit(0)).alias("violations")
    return orphan_counts(facts, dim, key).agg(total).select(
        F.lit("fact_sales").alias("table_name"),
        F.lit(f"{key} references dimension").alias("constraint_name"),
        "violations",
    )


def constraint_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Every constraint of the given tables. ``gross = discount + net`` is deliberately none of
    them: each measure is rounded on its own."""
    parts = []
    for name, df in tables.items():
        parts.append(row_violations(df, name))
        parts += [unique_violations(df, name, c) for c in UNIQUE.get(name, ()) if c in df.columns]
    facts = tables.get("fact_sales")
    if facts is not None:
        for dim, key in (("dim_customers", "customer_key"), ("dim_products", "product_key")):
            if dim in tables:
                parts.append(foreign_key_violations(facts, tables[dim], key))
    return reduce(DataFrame.unionByName, parts)
