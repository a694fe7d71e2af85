"""The order tables read as sales data: dimensions, fact lines, and a raw feed with planted faults.

A line's number is its place in the stored table, as a line number is a place in a file.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions.money import with_measures
from tallyworks.operators.numbering import block_offsets
from tallyworks.schemas import SALES_FIELDS
from tallyworks.workspace import Workspace

TODAY = dt.date(2026, 8, 17)
ID_DIGITS = 12
# The text planted in a field of the raw feed, by the remainder of the part key.
PLANT_CYCLE = 97
PLANTED = {
    "order_id": {2: ""},
    "order_date": {3: "15/01/2026", 4: "2199-01-01", 5: "1990-02-03", 24: ""},
    "customer_id": {6: "", 7: "C999999999"},
    "product_id": {9: "P999999999"},
    "quantity": {1: "-2", 10: "three", 11: "0", 12: "5000", 13: "-2"},
    "unit_price": {14: "abc", 16: "1,299.00", 17: "19.999", 18: "0.00", 19: "NaN"},
    "discount_rate": {20: "ten percent", 21: "1.00", 22: "1.50", 23: "-0.10", 25: "1.0000000000001"},
}
BAD_ORDER, LOOSE_CUSTOMER, DOLLAR_PRICE = 1, 8, 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """Deal out the rows of a scan that has fewer splits than there are cores, as one small file
    has. A large table has many splits and is left as it lies."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def coded(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), ID_DIGITS, "0"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension; its key is the table's own."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    placed = nation.join(region, nation.n_regionkey == region.r_regionkey)
    people = table(spark, sf_dir, "customer")
    return people.join(placed, people.c_nationkey == placed.n_nationkey).select(
        coded("C", "c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("segment"),
        F.lit(None).cast("date").alias("signup_date"),
        F.col("c_custkey").alias("customer_key"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        coded("P", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("list_price"),
        F.col("p_partkey").alias("product_key"),
    )


_LINE = (
    "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag",
)


def numbered_lines(spark: SparkSession, sf_dir: str, space: Workspace) -> DataFrame:
    """Lineitem with ``row_num``, the place of the row in the table, counted from 2.

    The reader knows each row's place in its file; only the row counts of the files are put in
    order, and no row is shuffled.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        *_LINE,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_index"),
    )
    counts = lines.groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
    # written first: one small row per file is then joined by its true size
    files = space.settle(block_offsets(counts, "_file").select("_file", "offset"), "file-offsets")
    placed = spread(lines).join(files, "_file")
    return placed.select(*_LINE, (F.col("offset") + F.col("_index") + 2).alias("row_num"))


def _joined(lines: DataFrame, spark: SparkSession, sf_dir: str, orders: bool) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"),
    )
    # a line of an unknown part or order stays, without what they would tell
    lines = lines.join(part, "l_partkey", "left")
    if orders:
        heads = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("o_custkey"),
            F.col("o_orderdate").cast("date").alias("order_date"),
        )
        # a cast prints the date faster than a format does
        day = F.col("order_date").cast("string")
        month = F.coalesce(F.concat(F.substring(day, 1, 4), F.lit("_"), F.substring(day, 6, 2)), F.lit("unknown"))
        lines = lines.join(heads, "l_orderkey", "left").withColumn(
            "source_file", F.concat(F.lit("sales_"), month, F.lit(".csv"))
        )
    return lines


ORDER_ID = "l_orderkey * 10 + l_linenumber"


def fact_lines(spark: SparkSession, sf_dir: str, orders: bool = True) -> DataFrame:
    """Every line as a measured fact. ``orders=False`` leaves out the order's own columns, and
    with them the join that would bring them."""
    lines = _joined(spread(table(spark, sf_dir, "lineitem")), spark, sf_dir, orders)
    head = ["order_date", F.col("o_custkey").alias("customer_key"), "source_file"] if orders else []
    return with_measures(
        lines.select(
            F.expr(ORDER_ID).alias("order_id"),
            *head,
            F.col("l_partkey").alias("product_key"),
            F.col("l_quantity").cast("int").alias("quantity"),
            "unit_price",
            F.col("l_discount").cast("decimal(5,4)").alias("discount_rate"),
        )
    )


def raw_feed(spark: SparkSession, sf_dir: str, space: Workspace) -> DataFrame:
    """The lines as raw text rows, with faults planted by part key."""
    lines = _joined(numbered_lines(spark, sf_dir, space), spark, sf_dir, orders=True)
    lines = lines.withColumn("_fault", F.pmod("l_partkey", F.lit(PLANT_CYCLE)))
    remainder = F.col("_fault")
    number = F.expr(ORDER_ID).cast("string")
    price = F.col("unit_price").cast("string")
    clean = {
        "order_id": F.when(remainder == BAD_ORDER, F.concat(F.lit("ORD-"), number))
        .otherwise(number),
        "order_date": F.col("order_date").cast("string"),
        "customer_id": F.when(
            remainder == LOOSE_CUSTOMER,
            F.concat(F.lit(" "), F.lower(coded("C", "o_custkey")), F.lit(" ")),
        ).otherwise(coded("C", "o_custkey")),
        "product_id": coded("P", "l_partkey"),
        "quantity": F.col("l_quantity").cast("int").cast("string"),
        "unit_price": F.when(remainder == DOLLAR_PRICE, F.concat(F.lit("$"), price))
        .otherwise(price),
        "discount_rate": F.col("l_discount").cast("decimal(4,2)").cast("string"),
    }

    def planted(field: str) -> Column:
        # a lookup makes far less code than a chain of cases
        texts = F.create_map(*[F.lit(v) for pair in PLANTED[field].items() for v in pair])
        return F.coalesce(F.try_element_at(texts, remainder.cast("int")), clean[field], F.lit("")).alias(field)

    return lines.select(
        "source_file", "row_num", *[planted(f) for f in SALES_FIELDS], "l_returnflag"
    )
