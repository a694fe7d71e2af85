"""Sums of the facts of each file, and the reports made from them.

A load replaces the sums of the files whose facts it replaces, from rows it holds anyway, so a report reads a row
for each file and key in place of the facts. Sums are exact decimals, and a file's customers are kept as the
set of their keys, so that a report from sums equals one from all facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.plans.analytics import customer_report, product_report, region_report
from tallyworks.schemas import SUMS


def sums_of(facts: DataFrame) -> dict[str, DataFrame]:
    """For each table of sums its rows for the files of ``facts``."""
    lines = F.count(F.lit(1)).alias("order_lines")
    units, net = F.sum("quantity").alias("units"), F.sum("net_sales").alias("net_sales")
    made = {
        "sums_by_day": facts.groupBy("source_file", "order_date").agg(
            lines, units, F.sum("gross_sales").alias("gross_sales"),
            F.sum("discount_amount").alias("discount_amount"), net),
        "sums_by_product": facts.groupBy("source_file", "product_key").agg(
            units, net, F.sum("discount_rate").alias("rates"), F.count("discount_rate").alias("rated")),
        "sums_by_customer": facts.groupBy("source_file", "customer_key").agg(
            lines, net, F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order")),
    }
    return {name: rows.select(*[F.col(c).cast(t) for c, t in SUMS[name].items()]) for name, rows in made.items()}


def revenue_per_day(by_day: DataFrame) -> DataFrame:
    return by_day.groupBy("order_date").agg(
        F.sum("order_lines").alias("order_lines"),
        F.sum("units").alias("units"),
        F.sum("gross_sales").cast("decimal(24,2)").alias("gross_sales"),
        F.sum("discount_amount").cast("decimal(24,2)").alias("discount_given"),
        F.sum("net_sales").cast("decimal(24,2)").alias("net_revenue"),
    ).orderBy("order_date")


def product_revenue(by_product: DataFrame, products: DataFrame) -> DataFrame:
    per_key = by_product.groupBy("product_key").agg(
        F.sum("units").alias("units_sold"),
        F.sum("net_sales").cast("decimal(24,2)").alias("net_revenue"),
        F.round(F.sum("rates").cast("decimal(20,4)") / F.sum("rated"), 4).alias("avg_discount_rate"),
    )
    return product_report(per_key, products)


def region_revenue(by_customer: DataFrame, customers: DataFrame) -> DataFrame:
    per_key = by_customer.groupBy("customer_key").agg(
        F.sum("order_lines").alias("lines"), F.sum("net_sales").cast("decimal(24,2)").alias("net"))
    return region_report(per_key, customers)


def customer_value(by_customer: DataFrame, customers: DataFrame) -> DataFrame:
    per_key = by_customer.groupBy("customer_key").agg(
        F.sum("order_lines").alias("order_lines"),
        F.sum("net_sales").cast("decimal(24,2)").alias("lifetime_value"),
        F.min("first_order").alias("first_order"),
        F.max("last_order").alias("last_order"),
    )
    return customer_report(per_key, customers)
