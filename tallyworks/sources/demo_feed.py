"""The demonstration feed: every field a function of the line number, for any number of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.schemas import SALES_FIELDS

# The cycles of the feed and the lines whose fields are overridden.
QUANTITIES = (1, 2, 3, 4, 5, 8, 12)
UNIT_PRICES = ("9.99", "12.50", "19.99", "25.00", "34.95", "59.99", "129.99")
DISCOUNT_RATES = ("0.00", "0.05", "0.10", "0.15", "0.20", "0.25")
CUSTOMERS, PRODUCTS, DAYS = 20, 15, 31
REGIONS = ("North", "South", "East", "West")
SEGMENTS = ("Retail", "Wholesale", "Enterprise")
CATEGORIES = ("Hardware", "Accessories", "Peripherals")
OVERRIDES: dict[int, dict[str, str]] = {
    5: {"customer_id": ""},
    9: {"order_id": "ORD-1007"},
    14: {"quantity": "three"},
    18: {"order_date": "15/01/2026"},
    23: {"unit_price": "abc"},
    27: {"discount_rate": "ten percent"},
    32: {"quantity": "0"},
    36: {"quantity": "-3"},
    41: {"unit_price": "0.00"},
    45: {"unit_price": "-19.99"},
    50: {"discount_rate": "-0.10"},
    54: {"discount_rate": "1.50"},
    59: {"discount_rate": "1.00"},
    63: {"customer_id": "C999"},
    68: {"product_id": "P999"},
    72: {"order_date": "2026-09-15"},
    77: {"order_date": "2025-12-28"},
    81: {"quantity": "5000"},
    86: {"unit_price": "$45.00"},
    90: {"unit_price": "1,299.00"},
    95: {"unit_price": "19.999"},
    99: {"order_date": ""},
    104: {"unit_price": ""},
    108: {"order_id": "ORD-X", "quantity": "-2"},
    113: {"customer_id": "C999", "product_id": "P999"},
    117: {"quantity": "0", "unit_price": "0.00", "discount_rate": "1.00"},
    122: {"order_id": "1001"},
    160: {"order_id": "1005"},
    130: {"customer_id": " C007 "},
    141: {"product_id": " p012 "},
}


def _cycle(values: tuple, k: Column) -> Column:
    texts = F.array(*[F.lit(str(v)) for v in values])
    return F.get(texts, F.pmod(k, F.lit(len(values))).cast("int"))


def _padded(prefix: str, number: Column, digits: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), digits, "0"))


def demo_rows(
    spark: SparkSession, lines: int = 200, source_file: str = "sales_2026_01.csv"
) -> DataFrame:
    """Raw rows of the feed; the overrides fall on its first two hundred lines."""
    k = F.col("row_num") - 2
    place = {
        "order_id": (k + 1000).cast("string"),
        "order_date": _padded("2026-01-", F.pmod(k, F.lit(DAYS)) + 1, 2),
        "customer_id": _padded("C", F.pmod(k, F.lit(CUSTOMERS)) + 1, 3),
        "product_id": _padded("P", F.pmod(k, F.lit(PRODUCTS)) + 1, 3),
        "quantity": _cycle(QUANTITIES, k),
        "unit_price": _cycle(UNIT_PRICES, k),
        "discount_rate": _cycle(DISCOUNT_RATES, k),
    }

    def value(field: str) -> Column:
        column = place[field]
        for row, fields in OVERRIDES.items():
            if field in fields:
                column = F.when(F.col("row_num") == row, F.lit(fields[field])).otherwise(column)
        return column.alias(field)

    rows = spark.range(2, lines + 2).withColumnRenamed("id", "row_num")
    return rows.select(
        F.lit(source_file).alias("source_file"), "row_num", *[value(f) for f in SALES_FIELDS]
    )


def demo_customers(spark: SparkSession) -> DataFrame:
    k = F.col("id")
    return spark.range(CUSTOMERS).select(
        _padded("C", k + 1, 3).alias("customer_id"),
        F.concat(F.lit("Customer "), (k + 1).cast("string")).alias("customer_name"),
        _cycle(REGIONS, k).alias("region"),
        _cycle(SEGMENTS, k).alias("segment"),
        F.lit(None).cast("date").alias("signup_date"),
    )


def demo_products(spark: SparkSession) -> DataFrame:
    k = F.col("id")
    return spark.range(PRODUCTS).select(
        _padded("P", k + 1, 3).alias("product_id"),
        F.concat(F.lit("Product "), (k + 1).cast("string")).alias("product_name"),
        _cycle(CATEGORIES, k).alias("category"),
        F.lit("25.00").cast("decimal(12,2)").alias("list_price"),
    )
