"""The registered queries: every capability run over the order tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions import parsing as P
from tallyworks.operators import judge as J
from tallyworks.operators import merge as M
from tallyworks.operators.audit import constraint_audit, orphan_counts, repeated_values
from tallyworks.plans import analytics as A
from tallyworks.plans import reconcile as R
from tallyworks.plans import summaries as S
from tallyworks.plans.sinks import read_preview, write_preview
from tallyworks.schemas import PREVIEW_COLUMNS, SALES_FIELDS, TABLES, ddl
from tallyworks.sources import order_tables as O
from tallyworks.sources import reference_json as REF
from tallyworks.plans.warehouse import Warehouse, buckets_for, new_load_id
from tallyworks.sources.sales_text import read_sales
from tallyworks.streaming.daily import follow, load_batch
from tallyworks.workspace import Workspace, own_shuffles

Query = Callable[[SparkSession, str], DataFrame]


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def as_long(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


# --- the feed, judged -------------------------------------------------------------------


@dataclass
class Load:
    """A judged load of the feed and what a warehouse would hold of it. ``judging`` holds the judged rows where they are
    written, and ``feeding`` the raw ones."""

    space: Workspace
    feed: DataFrame
    judged: DataFrame
    judging: Workspace
    feeding: Workspace

    @property
    def valid(self) -> DataFrame:
        return J.accepted(self.judged).withColumn("run_id", F.col("source_file"))

    @property
    def rejects(self) -> DataFrame:
        return J.rejected(self.judged, O.TODAY).withColumn("run_id", F.col("source_file"))


def judged_load(
    spark: SparkSession, sf_dir: str, settle: bool = False, keep_feed: bool = False
) -> Load:
    """``settle`` where the verdicts, ``keep_feed`` where the raw rows are read more than once:
    they are then written, and each reader takes only the columns it needs."""
    space = Workspace(spark)
    feeding, judging = space.inner(), space.inner()
    feed = O.raw_feed(spark, sf_dir, space)
    if keep_feed:
        feed = feeding.settle(feed, "feed", dictionary=False)
    judge = J.settled_judgement if settle else J.judge
    judged = judge(feed, O.customers(spark, sf_dir), O.products(spark, sf_dir), O.TODAY, judging)
    return Load(space, feed, judged, judging, feeding)


def loaded(load: Load, warehouse: Warehouse, spark: SparkSession, sf_dir: str, last: bool = True) -> str:
    """Put a judged load into a warehouse; returns the load's id. ``last`` where nobody reads its judged rows after that:
    they are dropped on the way."""
    judged = load.judged
    load_id = new_load_id()
    files = judged.groupBy("source_file").agg(F.max("row_num").alias("last_row"))
    loading, texts = load.space.inner(), load.space.inner()
    warehouse.load(
        judged, J.settled_rejects(judged, O.TODAY, texts), files,
        O.customers(spark, sf_dir).drop("customer_key"), O.products(spark, sf_dir).drop("product_key"),
        loading, load_id, passing={"etl_rejected_sales": texts} | ({"stg_sales": load.judging} if last else {}),
    )
    loading.drop()
    return load_id


#: The feed has a file for each month; over small tables one file has few rows.
FEW_BUCKETS = 2


def stored_load(
    spark: SparkSession, sf_dir: str, keep_feed: bool = False, sums: bool = False, keep_judged: bool = False
) -> tuple[Load, Warehouse]:
    """The feed judged and loaded into a new warehouse; ``keep_judged`` where the judged rows are read after that."""
    load = judged_load(spark, sf_dir, settle=True, keep_feed=keep_feed)
    warehouse = Warehouse(spark, load.space.path("warehouse"), buckets_for(load.judged.count(), FEW_BUCKETS), sums)
    loaded(load, warehouse, spark, sf_dir, last=not keep_judged)
    return load, warehouse


# Faults planted in stored tables for the checks to find, by remainders of keys.
UNSTAGED, TWICE, NO_FACT, ALTERED = (103, 11), (101, 7), (107, 13), (97, 5)
NO_CUSTOMER, NO_PRODUCT = (89, 3), (83, 2)


def _planted(column: str, fault: tuple[int, int]) -> Column:
    return F.col(column) % fault[0] == fault[1]


def tampered(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The tables of a warehouse as a faulty load would leave them, still in their buckets."""
    tables = {name: warehouse.read(name) for name in TABLES}
    staged = tables["stg_sales"]
    twice = staged.where(_planted("order_id", TWICE)).select(
        "run_id", "source_file", "row_num", F.lit("MISSING_FIELD").alias("reason_code"),
        F.lit(-1).cast("bigint").alias("rejected_id"), F.lit("{}").alias("raw_payload"),
        F.array(F.lit("MISSING_FIELD")).alias("reason_codes"), F.col("loaded_at").alias("rejected_at"),
    )
    altered = F.when(_planted("order_id", ALTERED), F.col("net_sales") + F.lit("0.01").cast("decimal(14,2)"))
    changed = {
        "stg_sales": staged.where(~_planted("order_id", UNSTAGED)),
        "fact_sales": tables["fact_sales"].where(~_planted("order_id", NO_FACT)).withColumn(
            "net_sales", F.coalesce(altered, F.col("net_sales")).cast("decimal(14,2)")),
        "etl_rejected_sales": tables["etl_rejected_sales"].unionByName(twice, allowMissingColumns=True),
        "dim_customers": tables["dim_customers"].where(~_planted("customer_key", NO_CUSTOMER)),
        "dim_products": tables["dim_products"].where(~_planted("product_key", NO_PRODUCT)),
    }
    return tables | changed


def faulty_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return tampered(stored_load(spark, sf_dir)[1])


# --- Q1 to Q5b --------------------------------------------------------------------------


def q1_revenue_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = A.revenue_per_day(O.fact_lines(spark, sf_dir))
    return as_double(report, "gross_sales", "discount_given", "net_revenue")


def q2_product_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = O.fact_lines(spark, sf_dir, orders=False)
    report = A.product_revenue(facts, O.products(spark, sf_dir))
    return as_double(report, "net_revenue", "avg_discount_rate")


def q3_region_revenue_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = A.region_revenue(O.fact_lines(spark, sf_dir), O.customers(spark, sf_dir))
    return as_double(report, "net_revenue", "pct_of_total")


def q4_customer_ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = A.customer_value(O.fact_lines(spark, sf_dir), O.customers(spark, sf_dir))
    return as_double(report, "lifetime_value")


def q5_rejections_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = A.rejections_by_reason(judged_load(spark, sf_dir).rejects)
    return as_double(report, "pct_of_rejections")


def q5b_rejected_payload_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rejected_payloads(judged_load(spark, sf_dir).rejects)


# --- R1 to R7 ---------------------------------------------------------------------------


def _conservation(spark: SparkSession, sf_dir: str, latest: bool) -> DataFrame:
    t = faulty_tables(spark, sf_dir)
    runs = R.latest_run(t["etl_run_log"]) if latest else t["etl_run_log"]
    return R.row_conservation(runs, t["stg_sales"], t["fact_sales"], t["etl_rejected_sales"])


def r1_row_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conservation(spark, sf_dir, latest=False)


def r1_row_conservation_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conservation(spark, sf_dir, latest=True)


def r2_measure_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = faulty_tables(spark, sf_dir)
    checked = R.recomputed_measures(t["fact_sales"], t["stg_sales"])
    return as_double(checked, "stored_net", "recomputed_net", "exact_then_rounded")


def r3_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = faulty_tables(spark, sf_dir)
    return R.orphans(t["fact_sales"], t["dim_customers"], t["dim_products"])


def _both(spark: SparkSession, sf_dir: str, latest: bool) -> DataFrame:
    t = faulty_tables(spark, sf_dir)
    runs = R.latest_run(t["etl_run_log"]) if latest else t["etl_run_log"]
    found = R.both_or_neither(runs, t["stg_sales"], t["etl_rejected_sales"])
    return as_long(found, "in_both", "in_neither")


def r4_both_neither(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, latest=False)


def r4_both_neither_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, latest=True)


def r4_missing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that are neither staged nor rejected, by file and number."""
    load, warehouse = stored_load(spark, sf_dir, keep_judged=True)
    t = tampered(warehouse)
    return R.missing_lines(load.judged, t["stg_sales"], t["etl_rejected_sales"])


def r5_additivity_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    # -0.03 is the gap predicted for the demonstration file; over these lines it is another
    report = R.additivity_gap(O.fact_lines(spark, sf_dir, orders=False), "-0.03")
    return as_double(report, "gross", "discount", "net", "additivity_gap")


def r6_half_cent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = faulty_tables(spark, sf_dir)
    return as_double(
        R.gap_rows(t["fact_sales"], t["stg_sales"]),
        "unit_price", "discount_rate", "gross_sales", "discount_amount", "net_sales", "row_gap",
    )


def r7_key_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = O.fact_lines(spark, sf_dir)
    report = R.natural_key_facts(facts, O.customers(spark, sf_dir), O.products(spark, sf_dir))
    return as_double(
        report, "unit_price", "discount_rate", "gross_sales", "discount_amount", "net_sales"
    )


def r7_preview_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A preview written as CSV with faults planted in it, against the facts that were loaded."""
    load, warehouse = stored_load(spark, sf_dir, keep_judged=True)
    altered = F.when(_planted("order_id", ALTERED), F.col("net_sales") + F.lit("0.01").cast("decimal(14,2)"))
    shown = load.valid.where(~_planted("order_id", UNSTAGED)).withColumn(
        "net_sales", F.coalesce(altered, F.col("net_sales")))
    twice = shown.where(_planted("order_id", TWICE))
    folder = load.space.path("out")
    write_preview(shown.unionByName(twice), folder)
    found = R.preview_differences(
        read_preview(spark, folder), *[warehouse.read(t) for t in ("fact_sales", "dim_customers", "dim_products")], load.space)
    return as_double(found.select("order_id", "customer_id", "net_sales", "in_facts", "in_preview"), "net_sales")


# --- judgement --------------------------------------------------------------------------


def v_judge_primary_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judged_load(spark, sf_dir).judged
    return judged.select("source_file", "row_num", J.primary_code().alias("reason_code"))


def v_defect_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = judged_load(spark, sf_dir).rejects
    return rejects.select(
        "source_file", "row_num", F.array_join("reason_codes", J.DETAIL_SEPARATOR).alias("codes")
    )


def v_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = F.expr(J.IS_CLEAN)
    return judged_load(spark, sf_dir).judged.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows_extracted"),
        F.count_if(clean).alias("rows_valid"),
        F.count_if(~clean).alias("rows_rejected"),
    )


def v_dedup_first_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving row of every order id."""
    return judged_load(spark, sf_dir).valid.select("source_file", "order_id", "row_num")


def v_unknown_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = judged_load(spark, sf_dir).rejects
    unknown = F.arrays_overlap(
        "reason_codes", F.array(F.lit("UNKNOWN_CUSTOMER"), F.lit("UNKNOWN_PRODUCT"))
    )
    return rejects.where(unknown).select(
        "source_file", "row_num",
        F.get_json_object("raw_payload", "$.customer_id").alias("raw_customer_id"),
        F.get_json_object("raw_payload", "$.product_id").alias("raw_product_id"),
    )


def v_secondary_code_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.code_counts(judged_load(spark, sf_dir).rejects)


def v_rows_with_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row on which the duplicate rule fired, primary or not."""
    rejects = judged_load(spark, sf_dir).rejects
    return J.with_code(rejects, "DUPLICATE_ORDER_ID").select(
        "source_file", "row_num", "reason_code"
    )


# --- cleaning and parsing ---------------------------------------------------------------


def p_key_normalized_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark)
    return J.repaired_keys(O.raw_feed(spark, sf_dir, space))


def p_typed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = J.parsed(O.raw_feed(spark, sf_dir, Workspace(spark)))
    return as_double(
        rows.select(
            "row_num", "order_id", "order_date", "customer_id", "product_id", "quantity",
            "unit_price", "discount_rate",
        ),
        "unit_price", "discount_rate",
    )


def p_decimal_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.raw_feed(spark, sf_dir, Workspace(spark))
    text = P.trimmed(F.col("unit_price"))
    places = F.when(P.is_decimal(text), P.decimal_places(text))
    return rows.groupBy(places.cast("bigint").alias("decimal_places")).agg(
        F.count(F.lit(1)).alias("n")
    )


def p_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = judged_load(spark, sf_dir).valid
    return as_double(
        valid.select(
            "source_file", "row_num", "order_id", "gross_sales", "discount_amount", "net_sales"
        ),
        "gross_sales", "discount_amount", "net_sales",
    )


# --- sources ----------------------------------------------------------------------------


def s_period_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = O.raw_feed(spark, sf_dir, Workspace(spark)).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n")
    )
    return files.select("source_file", P.file_period(F.col("source_file")).alias("period"), "n")


def _csv_line(columns: list[Column]) -> Column:
    return F.concat_ws(
        ",",
        *[
            F.when(F.contains(c, F.lit(",")), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(c)
            for c in columns
        ],
    )


# the writer would otherwise trim values and quote empty ones
AS_IS = {
    "header": True,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _written_feed(spark: SparkSession, feed: DataFrame, space: Workspace) -> str:
    """The feed as sales files, header first in each, one file per task."""
    path = space.path("csv")
    feed.select(*SALES_FIELDS).write.options(**AS_IS).csv(path)
    return path


def _write_headed(rows: DataFrame, line: Column, header: str, folder: str, end: str = "\n") -> None:
    """The lines as text files, one for each task that has any, the header before its first line.

    They lie below a partition value, as the first task would otherwise write a file without a byte where its split
    has no row, and a file without a header is refused.
    """
    first = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) == 0
    headed = F.when(first, F.concat(F.lit(header + end), line)).otherwise(line)
    rows.withColumn("_at", F.monotonically_increasing_id()).select(headed.alias("value"), F.lit("headed").alias("lines")) \
        .write.option("lineSep", end).partitionBy("lines").text(folder)


def s_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as sales files and read back: every field as it was."""
    space = Workspace(spark)
    path = _written_feed(spark, O.raw_feed(spark, sf_dir, space), space)
    rows, _ = read_sales(spark, path, space)
    return rows.select(*SALES_FIELDS)


def s_csv_row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales files whose order id rises by one per line: each line number must follow it."""
    space = Workspace(spark)
    feed = O.raw_feed(spark, sf_dir, space).withColumn(
        "order_id", F.monotonically_increasing_id().cast("string")
    )
    rows, _ = read_sales(spark, _written_feed(spark, feed, space), space)
    number = F.col("order_id").cast("bigint")
    rows = space.settle(rows.select("source_file", "row_num", number.alias("written")), "read")
    first = rows.groupBy("source_file").agg(F.min("written").alias("first_written"))
    # one row per file; its size is known once it is written
    placed = rows.join(space.settle(first, "first"), "source_file")
    late = F.col("row_num") != F.col("written") - F.col("first_written") + 2
    return placed.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(late).alias("misplaced"))


def s_file_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales files in three shapes: sound, a column short, and one value over on every line."""
    space = Workspace(spark)
    feed = space.settle(O.raw_feed(spark, sf_dir, space), "feed")
    path = _written_feed(spark, feed, space)
    short, wide = space.path("short"), space.path("wide")
    feed.select(*SALES_FIELDS[:-1]).write.option("header", True).csv(short)
    line = F.concat(_csv_line([F.col(c) for c in SALES_FIELDS]), F.lit(","))
    _write_headed(feed, line, ",".join(SALES_FIELDS), wide)
    parts = []
    for shape, folder in (("sound", path), ("short", short), ("wide", wide)):
        _, gate = read_sales(spark, folder, space, on_bad_file="skip")
        parts.append(
            gate.select(
                F.lit(shape).alias("shape"),
                F.array_join("missing", ",").alias("missing"),
                F.array_join("unexpected", ",").alias("unexpected"),
                "surplus_line",
                F.col("problem").isNull().alias("sound"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


# The column order of the turned header, and which lines are short or followed by a blank one.
TURNED = ("product_id", "order_id", "unit_price", "customer_id", "order_date", "quantity", "discount_rate")
SHORT_EVERY, BLANK_EVERY = 41, 50


def s_file_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written with a byte order mark, a turned header, CRLF ends, short and blank lines."""
    space = Workspace(spark)
    feed = space.settle(O.raw_feed(spark, sf_dir, space), "feed")
    line = _csv_line([F.col(c) for c in TURNED])
    short = _csv_line([F.col(c) for c in TURNED[:-1]])
    line = F.when(F.col("row_num") % SHORT_EVERY == 0, short).otherwise(line)
    line = F.when(F.col("row_num") % BLANK_EVERY == 0, F.concat(line, F.lit("\r\n"))).otherwise(line)
    folder = space.path("shapes")
    _write_headed(feed, line, "\ufeff" + ",".join(TURNED), folder, end="\r\n")
    rows, _ = read_sales(spark, folder, space)
    return rows.select(*SALES_FIELDS)


CUSTOMERS_PER_ARRAY = 100_000


def s_reference_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of reference files that are sound, hold a second array or text behind their array, or
    prices beyond the column."""
    space = Workspace(spark)
    part = F.expr(f"customer_key div {CUSTOMERS_PER_ARRAY}").alias("part")
    array = F.to_json(F.collect_list(F.struct("customer_id", "customer_name", "region", "segment")))
    arrays = space.settle(O.customers(spark, sf_dir).groupBy(part).agg(array.alias("value")), "arrays")
    value = F.col("value")
    shapes = {
        "sound": value,
        "second array": F.concat(value, F.lit("\n"), value),
        "text behind": F.concat(value, F.lit(" x ]")),
        "second field": F.concat(value, F.lit(',"more":'), value),
    }
    found = []
    for shape, written in shapes.items():
        folder = space.path("json")
        arrays.select("part", written.alias("value")).write.partitionBy("part").text(folder)
        _, faults = REF.build_customers(REF.read_reference(spark, folder, "array", space), space)
        found.append(faults.select(F.lit(shape).alias("shape"), "fault"))
    folder = space.path("json")
    wide = (F.col("list_price").cast("decimal(30,2)") * 10_000_000_000).cast("string")
    O.products(spark, sf_dir).select("product_id", "product_name", "category", wide.alias("list_price")) \
        .write.json(folder)
    _, faults = REF.build_products(REF.read_reference(spark, folder, "lines"), space)
    rows = faults.select(F.lit("wide price").alias("shape"), "fault")
    for more in found:
        rows = rows.unionByName(more)
    return rows.groupBy("shape", "fault").agg(F.count(F.lit(1)).alias("n"))



def s_json_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as files of one JSON array each, read and typed. A file holds a range
    of keys, so its size is bounded however many customers there are."""
    space = Workspace(spark)
    people = O.customers(spark, sf_dir)
    folder = space.path("json")
    people.groupBy(F.expr(f"customer_key div {CUSTOMERS_PER_ARRAY}").alias("part")).agg(
        F.to_json(
            F.collect_list(F.struct("customer_id", "customer_name", "region", "segment"))
        ).alias("value")
    ).write.partitionBy("part").text(folder)
    return _read_customers(spark, folder, "array", space)


SPLIT_BYTES = 64 << 10


@contextmanager
def _splits_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Files read meanwhile are cut into splits of this size."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def s_array_over_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as arrays with nested objects, braces and quotes in strings, each file read in many splits."""
    space = Workspace(spark)
    folder = space.path("json")
    notes = F.struct(F.concat(F.lit('} "],[{ '), "customer_name").alias("said"), F.struct(F.array("customer_key").alias("keys")).alias("deep"))
    one = F.struct("customer_id", "customer_name", "region", "segment", notes.alias("notes"))
    O.customers(spark, sf_dir).groupBy(F.expr(f"customer_key div {CUSTOMERS_PER_ARRAY}").alias("part")).agg(
        F.to_json(F.collect_list(one)).alias("value")).write.partitionBy("part").text(folder)
    with _splits_of(spark, SPLIT_BYTES):
        elements = space.settle(REF.read_reference(spark, folder, "array", space), "elements")
    dim, faults = REF.build_customers(elements, space)
    REF.require_sound(faults)
    said = elements.select(
        F.try_variant_get("element", "$.customer_id", "string").alias("customer_id"),
        F.try_variant_get("element", "$.notes.said", "string").alias("said"),
        F.try_variant_get("element", "$.notes.deep.keys[0]", "bigint").alias("deep_key"))
    return dim.select("customer_id", "customer_name", "region", "segment").join(said, "customer_id")


def s_json_lines_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one object per line: files of any size split."""
    space = Workspace(spark)
    folder = space.path("json")
    O.customers(spark, sf_dir).drop("customer_key").write.json(folder)
    return _read_customers(spark, folder, "lines", space)


def _read_customers(spark: SparkSession, folder: str, layout: str, space: Workspace) -> DataFrame:
    dim, faults = REF.build_customers(REF.read_reference(spark, folder, layout, space), space)
    REF.require_sound(faults)
    return dim.select("customer_id", "customer_name", "region", "segment")


def s_product_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with their list price as a JSON number."""
    space = Workspace(spark)
    folder = space.path("json")
    O.products(spark, sf_dir).drop("product_key").write.json(folder)
    dim, faults = REF.build_products(REF.read_reference(spark, folder, "lines"), space)
    REF.require_sound(faults)
    return as_double(dim, "list_price")


# --- warehouse --------------------------------------------------------------------------

EARLY, LATE = "1996-01-01", "2001-01-01"


def _seen_customers(spark: SparkSession, sf_dir: str, when: str) -> DataFrame:
    orders = O.table(spark, sf_dir, "orders").where(when)
    seen = orders.select(O.coded("C", "o_custkey").alias("customer_id")).distinct()
    return O.customers(spark, sf_dir).join(seen, "customer_id", "left_semi")


def k_dim_upsert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the first year, under old attributes, then those of the last months and all
    who didn't buy in the first year."""
    space = Workspace(spark)
    old = _seen_customers(spark, sf_dir, f"o_orderdate < '{EARLY}'").select(
        "customer_id",
        F.concat(F.lit("was "), "customer_name").alias("customer_name"),
        F.lit("UNKNOWN").alias("region"),
        F.lit("NONE").alias("segment"),
        F.to_date(F.lit("1995-01-01")).alias("signup_date"),
    )
    late = _seen_customers(spark, sf_dir, f"o_orderdate >= '{LATE}'").drop("customer_key")
    others = O.customers(spark, sf_dir).drop("customer_key").join(old, "customer_id", "left_anti")
    new = late.unionByName(others).distinct()
    empty = spark.createDataFrame([], ddl(TABLES["dim_customers"]))
    first = M.upsert_dim(empty, old, "customer_id", "customer_key", space)
    first = space.settle(first, "first-load")
    both = M.upsert_dim(first, new, "customer_id", "customer_key", space)
    return both.drop("updated_at")


def k_dim_upsert_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products sold in the first year at no list price, then the whole list."""
    space = Workspace(spark)
    sold = O.table(spark, sf_dir, "lineitem").where(f"l_shipdate < '{EARLY}'")
    sold = sold.select(O.coded("P", "l_partkey").alias("product_id")).distinct()
    old = O.products(spark, sf_dir).join(sold, "product_id", "left_semi").select(
        "product_id", "product_name", F.lit("UNSORTED").alias("category"),
        F.lit(None).cast("decimal(12,2)").alias("list_price"),
    )
    empty = spark.createDataFrame([], ddl(TABLES["dim_products"]))
    first = M.upsert_dim(empty, old, "product_id", "product_key", space)
    first = space.settle(first, "first-load")
    new = O.products(spark, sf_dir).drop("product_key")
    both = M.upsert_dim(first, new, "product_id", "product_key", space)
    return as_double(both.drop("updated_at"), "list_price")


def k_surrogate_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored facts with the surrogate keys of dimensions numbered in id order."""
    _, warehouse = stored_load(spark, sf_dir)
    return warehouse.read("fact_sales").select(
        "source_file", "order_id", "customer_key", "product_key"
    )


def _per_file(facts: DataFrame, lines: str = "facts", net: str = "net_sales") -> DataFrame:
    return facts.groupBy("source_file").agg(
        F.count(F.lit(1)).alias(lines), F.sum("net_sales").cast("double").alias(net)
    )


def k_reload_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file loaded twice: the facts of the second load stand in for the first."""
    load, warehouse = stored_load(spark, sf_dir, keep_judged=True)
    before = load.space.settle(
        _per_file(warehouse.read("fact_sales"), "facts_before", "net_before"), "before"
    )
    loaded(load, warehouse, spark, sf_dir)
    after = _per_file(warehouse.read("fact_sales"), "facts_after", "net_after")
    return before.join(after, "source_file", "full_outer")


def _judged_again(spark: SparkSession, sf_dir: str, load: Load, feed: DataFrame) -> Load:
    """Another load of the kept feed, which is dropped then."""
    judging = load.space.inner()
    judged = J.settled_judgement(feed, O.customers(spark, sf_dir), O.products(spark, sf_dir), O.TODAY, judging)
    load.feeding.drop()
    return Load(load.space, feed, judged, judging, load.feeding)


def k_reload_stale_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file sent again without its returned lines: their facts must go."""
    load, warehouse = stored_load(spark, sf_dir, keep_feed=True)
    second = _judged_again(spark, sf_dir, load, load.feed.where("l_returnflag <> 'R'"))
    first_runs = load.space.settle(
        warehouse.read("etl_run_log").select("run_id", F.lit(True).alias("_first")), "first-runs"
    )
    loaded(second, warehouse, spark, sf_dir)
    facts = warehouse.read("fact_sales").join(first_runs, "run_id", "left")
    return _per_file(facts).join(
        facts.groupBy("source_file").agg(F.count("_first").alias("stale")), "source_file"
    )


def _returns_loaded(spark: SparkSession, sf_dir: str, sums: bool = False) -> tuple[Warehouse, str]:
    """All lines loaded, then the returned ones sent again under one other file name."""
    load, warehouse = stored_load(spark, sf_dir, keep_feed=True, sums=sums)
    feed = load.feed.where("l_returnflag = 'R'").withColumn("source_file", F.lit("returns.csv"))
    second = _judged_again(spark, sf_dir, load, feed)
    return warehouse, loaded(second, warehouse, spark, sf_dir)


def k_reload_cross_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other file takes the returned lines' facts over, while the staging rows of the first
    files stay."""
    warehouse, _ = _returns_loaded(spark, sf_dir)
    staged = warehouse.read("stg_sales").groupBy("source_file").agg(F.count(F.lit(1)).alias("staged"))
    return _per_file(warehouse.read("fact_sales")).join(staged, "source_file", "full_outer")


def k_sums_after_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 to Q4 after these loads, from the sums that both of them kept up; no fact is read."""
    warehouse, _ = _returns_loaded(spark, sf_dir, sums=True)
    people, goods = warehouse.read("dim_customers"), warehouse.read("dim_products")
    by_day, by_product, by_customer = (warehouse.read(f"sums_by_{key}") for key in ("day", "product", "customer"))

    def shown(report: str, rows: DataFrame, name: str, count: str, amount: str, more: Column) -> DataFrame:
        return rows.select(F.lit(report).alias("report"), F.col(name).cast("string").alias("name"),
                           F.col(count).alias("n"), F.col(amount).cast("double").alias("amount"),
                           more.cast("double").alias("more"))

    return (
        shown("day", S.revenue_per_day(by_day), "order_date", "units", "net_revenue", F.col("discount_given"))
        .unionByName(shown("product", S.product_revenue(by_product, goods), "product_id", "units_sold", "net_revenue",
                           F.col("avg_discount_rate")))
        .unionByName(shown("region", S.region_revenue(by_customer, people), "region", "customers", "net_revenue",
                           F.col("pct_of_total")))
        .unionByName(shown("customer", S.customer_value(by_customer, people), "customer_id", "order_lines", "lifetime_value",
                           F.datediff("last_order", "first_order")))
    )


def k_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second of these loads removed, inserted and updated."""
    warehouse, load_id = _returns_loaded(spark, sf_dir)
    return warehouse.load_report(load_id).drop("load_id")


def k_fact_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    preview = judged_load(spark, sf_dir).valid.select(*PREVIEW_COLUMNS)
    return as_double(
        preview, "unit_price", "discount_rate", "gross_sales", "discount_amount", "net_sales"
    )


def k_rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined rows with their whole reason text and payload."""
    load = judged_load(spark, sf_dir)
    marked = load.space.settle(load.judged.where(f"not ({J.IS_CLEAN})"), "marked")
    rejects = J.settled_rejects(marked, O.TODAY, load.space)
    return rejects.select("source_file", "row_num", "reason_code", "reason_detail", "raw_payload")


def k_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log of a warehouse after every file is loaded twice: a run for each."""
    load, warehouse = stored_load(spark, sf_dir, keep_judged=True)
    loaded(load, warehouse, spark, sf_dir)
    return warehouse.read("etl_run_log").groupBy("source_file", "status").agg(
        F.count_distinct("run_id").alias("runs"),
        *[F.sum(f"rows_{c}").alias(f"rows_{c}") for c in ("extracted", "valid", "rejected", "loaded")],
    )


# --- arriving files ---------------------------------------------------------------------

# Fixed value: the month whose files come again.
RESENT = "sales_%_06.csv"


def _delivered(feed: DataFrame, folder: str) -> None:
    """The feed as one sales file for each source file, its lines in order."""
    dealt = feed.repartition("source_file").sortWithinPartitions("source_file", "row_num")
    with own_shuffles(feed.sparkSession):
        dealt.select(*SALES_FIELDS, "source_file").write.options(**AS_IS).partitionBy("source_file").csv(folder)


def t_arriving_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive on two days, the second day's without returned lines and in place of earlier ones, followed
    by a stream; then the stream again with nothing new, and its last batch once more."""
    space = Workspace(spark)
    feeding = space.inner()
    feed = feeding.settle(O.raw_feed(spark, sf_dir, feeding), "feed", dictionary=False)
    people, goods = space.path("customers"), space.path("products")
    O.customers(spark, sf_dir).drop("customer_key").write.json(people)
    O.products(spark, sf_dir).drop("product_key").write.json(goods)
    inbox, state, root = space.path("inbox"), space.path("state"), space.path("warehouse")
    load = load_batch(spark, people, goods, space.path("out"), root, "daily", lambda: O.TODAY, reference_layout="lines")
    again = feed.where(F.col("source_file").like(RESENT) & (F.col("l_returnflag") != "R"))
    days = feed, space.settle(again, "sent-again", dictionary=False)
    for n, lines in enumerate(days):
        _delivered(lines, f"{inbox}/day{n}")
        feeding.drop()
        follow(spark, inbox, state, load).awaitTermination()
    follow(spark, inbox, state, load).awaitTermination()
    again = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{inbox}/day1")
    load(again.select("path", "modificationTime"), 1)
    warehouse = Warehouse(spark, root)
    staged = warehouse.read("stg_sales").groupBy("source_file").agg(F.count(F.lit(1)).alias("staged"))
    rejects = warehouse.read("etl_rejected_sales").groupBy("source_file").agg(F.count(F.lit(1)).alias("rejected"))
    runs = warehouse.read("etl_run_log").groupBy("source_file").agg(F.count(F.lit(1)).alias("runs"))
    return runs.join(_per_file(warehouse.read("fact_sales")), "source_file", "left").join(
        staged, "source_file", "left").join(rejects, "source_file", "left")


def s_records_over_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales files whose customer field holds line ends, read in many splits: the fields, and each record's last line."""
    space = Workspace(spark)
    feeding = space.inner()
    feed = feeding.settle(O.raw_feed(spark, sf_dir, feeding), "feed", dictionary=False)
    # a bare line end, commas, a doubled quote: half of the records run over two lines, each seventh over three
    broken = F.when(F.col("row_num") % 7 == 0, F.concat(F.lit("\n"), "customer_id", F.lit('\n"", x')))
    broken = broken.when(F.col("row_num") % 2 == 0, F.concat("customer_id", F.lit(",\ny"))).otherwise(F.col("customer_id"))
    cells = [F.concat(F.lit('"'), broken, F.lit('"')) if c == "customer_id" else F.concat(F.lit('"'), c, F.lit('"'))
             for c in SALES_FIELDS]
    lines = feed.select("source_file", "row_num", F.concat_ws(",", *cells).alias("line"))
    header = lines.groupBy("source_file").agg(F.lit(0).cast("bigint").alias("row_num"), F.lit(",".join(SALES_FIELDS)).alias("line"))
    dealt = lines.unionByName(header).repartition("source_file").sortWithinPartitions("source_file", "row_num")
    folder = space.path("lines")
    with own_shuffles(spark):
        dealt.select("source_file", F.col("line").alias("value")).write.partitionBy("source_file").text(folder)
    feeding.drop()
    rows, _ = read_sales(spark, folder, space)
    return rows.select("source_file", F.col("row_num").alias("last_line"), "order_id", "customer_id", "discount_rate")


# --- constraints ------------------------------------------------------------------------


def c_constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraints over the unjudged lines: order ids repeat there, all else holds."""
    tables = {
        "fact_sales": O.fact_lines(spark, sf_dir),
        "dim_customers": O.customers(spark, sf_dir),
        "dim_products": O.products(spark, sf_dir),
    }
    return constraint_audit(tables)


def c_unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_values(O.fact_lines(spark, sf_dir, orders=False), "order_id")


def c_fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows per customer or product id that the dimension lacks."""
    feed = J.parsed(O.raw_feed(spark, sf_dir, Workspace(spark)))
    parts = []
    for key, dim in (("customer_id", O.customers), ("product_id", O.products)):
        lost = orphan_counts(feed.where(F.col(key).isNotNull()), dim(spark, sf_dir), key)
        parts.append(lost.select(F.lit(key).alias("field"), F.col(key).alias("id"), "n"))
    return parts[0].unionByName(parts[1])


def c_stored_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraints of all six stored tables, some dimension rows being gone."""
    return constraint_audit(faulty_tables(spark, sf_dir))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        q1_revenue_per_day, q2_product_revenue, q3_region_revenue_share, q4_customer_ltv,
        q5_rejections_by_reason, q5b_rejected_payload_fields,
        r1_row_conservation, r1_row_conservation_latest, r2_measure_recompute, r3_orphans,
        r4_both_neither, r4_both_neither_latest, r4_missing_lines, r5_additivity_gap, r6_half_cent_rows,
        r7_key_roundtrip, r7_preview_compare,
        v_judge_primary_code, v_defect_codes, v_split_counts, v_dedup_first_accepted,
        v_unknown_fk, v_secondary_code_counts, v_rows_with_code,
        p_key_normalized_audit, p_typed_parse, p_decimal_scale, p_measures,
        s_period_from_filename, s_csv_scan, s_csv_row_numbers, s_file_gate, s_file_shapes, s_reference_shapes, s_json_reference,
        s_array_over_splits, s_json_lines_reference, s_product_reference,
        k_dim_upsert_customers, k_dim_upsert_products, k_surrogate_resolve,
        k_reload_idempotent, k_reload_stale_removed, k_reload_cross_file, k_sums_after_reload, k_load_report, k_fact_preview,
        k_rejected_records, k_run_log, t_arriving_files, s_records_over_lines,
        c_constraint_audit, c_unique_violations, c_fk_violations, c_stored_constraints,
    )
}
