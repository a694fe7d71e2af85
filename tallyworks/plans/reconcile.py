"""Checks that show why the numbers can be believed."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.money import exact_discount, exact_gross, exact_net
from tallyworks.operators.audit import orphan_counts
from tallyworks.workspace import Workspace


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("source_file")).limit(1)


def _per_run(table: DataFrame, name: str) -> DataFrame:
    return table.groupBy("run_id").agg(F.count(F.lit(1)).alias(name))


def _zero(column: str) -> Column:
    return F.coalesce(column, F.lit(0))


def row_conservation(
    runs: DataFrame, staged: DataFrame, facts: DataFrame, rejects: DataFrame
) -> DataFrame:
    """Check 1, for each given run: every extracted row is staged or rejected, and every staged
    row is a fact. Each table is counted by run once; pass ``latest_run(log)`` for one run."""
    counted = (
        runs.select("run_id", "source_file", "rows_extracted")
        .join(_per_run(staged, "staged"), "run_id", "left")
        .join(_per_run(facts, "facts"), "run_id", "left")
        .join(_per_run(rejects, "rejected"), "run_id", "left")
        .withColumns({c: _zero(c) for c in ("staged", "facts", "rejected")})
    )
    return counted.select(
        "source_file", "rows_extracted", "staged", "facts", "rejected",
        (F.col("rows_extracted") == F.col("staged") + F.col("rejected"))
        .alias("conservation_holds"),
        (F.col("staged") == F.col("facts")).alias("staged_equals_facts"),
    )


def _in_place(facts: DataFrame, staged: DataFrame) -> DataFrame:
    """Facts beside the staging rows of their order and run. The order id alone is the join's key, as tables
    are bucketed by it; an equality of run ids would become a second key, for which both sides were shuffled."""
    staged = staged.withColumnsRenamed({"order_id": "_order", "run_id": "_run"})
    same_run = F.col("run_id").between(F.col("_run"), F.col("_run"))
    return facts.join(staged, (F.col("order_id") == F.col("_order")) & same_run).drop("_order", "_run")


def recomputed_measures(facts: DataFrame, staged: DataFrame) -> DataFrame:
    """Check 2: the stored measures against the same formulas over the staged inputs."""
    inputs = staged.select("order_id", "run_id", "quantity", "unit_price", "discount_rate")
    stored = facts.select("order_id", "run_id", "gross_sales", "discount_amount", "net_sales")
    args = (F.col("quantity"), F.col("unit_price"), F.col("discount_rate"))
    gross = F.round(exact_gross(*args[:2]), 2)
    discount = F.round(exact_discount(*args), 2)
    net = F.round(exact_net(*args), 2)
    differs = (
        (F.col("gross_sales") != gross)
        | (F.col("discount_amount") != discount)
        | (F.col("net_sales") != net)
    )
    totals = _in_place(stored, inputs).agg(
        F.count(F.lit(1)).alias("rows_compared"),
        F.count_if(differs).alias("mismatched_rows"),
        F.sum("net_sales").alias("stored_net"),
        F.sum(net.cast("decimal(14,2)")).alias("recomputed_net"),
        F.round(F.sum(exact_net(*args).cast("decimal(28,14)")), 2).alias("exact_then_rounded"),
    )
    return totals.withColumn(
        "control_total_matches", F.col("stored_net") == F.col("recomputed_net")
    )


def orphans(facts: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Check 3: fact rows whose key no dimension row has."""
    lost_customers = orphan_counts(facts, customers, "customer_key").select(
        F.col("n").alias("c"), F.lit(0).alias("p")
    )
    lost_products = orphan_counts(facts, products, "product_key").select(
        F.lit(0).alias("c"), F.col("n").alias("p")
    )
    return lost_customers.unionByName(lost_products).agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("orphan_customers"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("orphan_products"),
    )


def both_or_neither(runs: DataFrame, staged: DataFrame, rejects: DataFrame) -> DataFrame:
    """Check 4, for each given run: rows both staged and rejected, and rows that are neither.

    The rejected side is not limited to the run, and is counted per line before the join, so a
    line that repeats adds its pairs without producing them.
    """
    line = ["source_file", "row_num"]
    # a line rejected once or more, with how often, meets each of its staged rows: one row for each of these
    often = rejects.groupBy(*line).agg(F.count(F.lit(1)).alias("r"))
    pairs = staged.select("run_id", *line).join(often, line).groupBy("run_id").agg(F.sum("r").alias("in_both"))
    counted = (
        runs.select("run_id", "source_file", "rows_extracted")
        .join(pairs, "run_id", "left")
        .join(_per_run(staged, "staged"), "run_id", "left")
        .join(_per_run(rejects, "rejected"), "run_id", "left")
    )
    return counted.select(
        "source_file",
        _zero("in_both").alias("in_both"),
        (F.col("rows_extracted") - _zero("staged") - _zero("rejected")).alias("in_neither"),
    )


def missing_lines(extracted: DataFrame, staged: DataFrame, rejects: DataFrame) -> DataFrame:
    """The extracted lines that are neither staged nor rejected: file and line."""
    # numbers first: a sort compares its first key by far the fastest, and file names hardly differ
    line = ["row_num", "source_file"]
    found = staged.select(*line).unionByName(rejects.select(*line))
    return extracted.select(*line).join(found, line, "left_anti").select("source_file", "row_num")


def additivity_gap(facts: DataFrame, expected: Decimal | str) -> DataFrame:
    """Check 5: the gap that separate rounding leaves, against the value predicted for the data."""
    unequal = F.col("gross_sales") != F.col("discount_amount") + F.col("net_sales")
    totals = facts.agg(
        F.sum("gross_sales").alias("gross"),
        F.sum("discount_amount").alias("discount"),
        F.sum("net_sales").alias("net"),
        F.count_if(unequal).alias("half_cent_rows"),
    )
    gap = F.col("gross") - F.col("discount") - F.col("net")
    return totals.withColumn("additivity_gap", gap).withColumn(
        "gap_as_expected", F.col("additivity_gap") == F.lit(Decimal(expected))
    )


def gap_rows(facts: DataFrame, staged: DataFrame) -> DataFrame:
    """The rows behind the gap. Only they reach the join: the filter is on the fact side."""
    measures = ("gross_sales", "discount_amount", "net_sales")
    apart = facts.where("gross_sales <> discount_amount + net_sales").select(
        "order_id", "run_id", "quantity", "unit_price", "discount_rate", *measures
    )
    lines = staged.select("order_id", "run_id", "row_num")
    return (
        _in_place(apart, lines)
        .select(
            "row_num", "quantity", "unit_price", "discount_rate", *measures,
            (F.col("gross_sales") - F.col("discount_amount") - F.col("net_sales"))
            .alias("row_gap"),
        )
        .orderBy("row_num")
    )


def natural_key_facts(facts: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Facts with the surrogate keys swapped back, to lay beside the preview."""
    return (
        facts.join(customers.select("customer_key", "customer_id"), "customer_key")
        .join(products.select("product_key", "product_id"), "product_key")
        .select(
            "customer_id", "product_id", "order_id", "order_date", "quantity", "unit_price",
            "discount_rate", "gross_sales", "discount_amount", "net_sales",
        )
        .orderBy("order_id")
    )


FINGERPRINT_BUCKETS = 4096


def _fingerprints(rows: DataFrame, key: str, columns: list[str], name: str) -> DataFrame:
    """Per bucket of keys: the number of rows and two sums of row hashes, which no order or partitioning changes.

    Sums are wide, so they never wrap, and a row that repeats counts as often as it is there.
    """
    text = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in columns])
    hashes = [F.xxhash64(text), F.xxhash64(F.lit("second"), text)]
    return rows.groupBy(F.pmod(F.xxhash64(key), F.lit(FINGERPRINT_BUCKETS)).alias("bucket")).agg(
        F.struct(F.count(F.lit(1)).alias("n"), *[F.sum(h.cast("decimal(20,0)")).alias(f"h{i}") for i, h in enumerate(hashes)])
        .alias(name))


def differing_rows(left: DataFrame, right: DataFrame, key: str, space: Workspace) -> DataFrame:
    """Rows that the two sides don't hold equally often, with how often each does: ``in_left``, ``in_right``.

    Both sides are compared as multisets by fingerprints, a few thousand small rows; only the rows of buckets that
    differ are brought together. Equal sides cost one aggregation of each.
    """
    columns = left.columns
    right = right.select(*[F.col(c).cast(left.schema[c].dataType).alias(c) for c in columns])
    both = _fingerprints(left, key, columns, "a").join(_fingerprints(right, key, columns, "b"), "bucket", "full_outer")
    apart = space.settle(both.where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket"), "apart")
    bucket = F.pmod(F.xxhash64(key), F.lit(FINGERPRINT_BUCKETS))
    sides = left.withColumns({"in_left": F.lit(1), "in_right": F.lit(0)}).unionByName(
        right.withColumns({"in_left": F.lit(0), "in_right": F.lit(1)}))
    near = sides.withColumn("bucket", bucket).join(apart, "bucket", "left_semi")
    return near.groupBy(*columns).agg(F.sum("in_left").alias("in_left"), F.sum("in_right").alias("in_right")).where(
        "in_left <> in_right")


def preview_differences(preview: DataFrame, facts: DataFrame, customers: DataFrame, products: DataFrame,
                        space: Workspace) -> DataFrame:
    """Check 7: the written preview against the stored facts, their keys swapped back."""
    stored = natural_key_facts(facts, customers, products)
    return differing_rows(stored, preview.select(*stored.columns), "order_id", space).withColumnsRenamed(
        {"in_left": "in_facts", "in_right": "in_preview"})
