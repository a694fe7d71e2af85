"""Exact measures of a sales line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.schemas import MONEY


def exact_gross(quantity: Column, unit_price: Column) -> Column:
    return quantity.try_cast("decimal(10,0)") * unit_price.try_cast("decimal(12,2)")


def exact_discount(quantity: Column, unit_price: Column, rate: Column) -> Column:
    # decimal(23,2) by decimal(13,12) stays within 38 digits, so the product is exact
    return exact_gross(quantity, unit_price) * rate.try_cast("decimal(13,12)")


def exact_net(quantity: Column, unit_price: Column, rate: Column) -> Column:
    return exact_gross(quantity, unit_price) - exact_discount(quantity, unit_price, rate)


def cents(amount: Column) -> Column:
    """Round half up to two places; null where the amount does not fit the column."""
    return amount.try_cast(MONEY)


def with_measures(df: DataFrame, rate: str = "discount_rate") -> DataFrame:
    """Add gross, discount and net, each rounded once from its own exact value."""
    quantity, price, discount = F.col("quantity"), F.col("unit_price"), F.col(rate)
    return df.withColumns(
        {
            "gross_sales": cents(exact_gross(quantity, price)),
            "discount_amount": cents(exact_discount(quantity, price, discount)),
            "net_sales": cents(exact_net(quantity, price, discount)),
        }
    )
