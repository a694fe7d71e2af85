import json
import shutil
from decimal import Decimal

import pytest
from days import TODAY
from pyspark.sql import functions as F

from tallyworks.operators import audit, merge
from tallyworks.plans import analytics as A
from tallyworks.plans import reconcile as R
from tallyworks.plans import summaries as S
from tallyworks.plans import warehouse as WH
from tallyworks.plans.job import run
from tallyworks.plans.sinks import write_preview, write_rejected
from tallyworks.schemas import (
    NULLABLE,
    PREVIEW_COLUMNS,
    REJECTED_COLUMNS,
    SALES_FIELDS,
    TABLES,
    ddl,
)
from tallyworks.sources.demo_feed import demo_customers, demo_products, demo_rows
from tallyworks.sources.sales_text import SchemaMismatch

HEADER = ",".join(SALES_FIELDS)


def csv_text(rows):
    def cell(v):
        return f'"{v}"' if "," in v else v

    return "\n".join([HEADER, *[",".join(cell(r[f]) for f in SALES_FIELDS) for r in rows]]) + "\n"


class Site:
    """A folder of inputs and a warehouse."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        for name, df in (("customers", demo_customers(spark)), ("products", demo_products(spark))):
            rows = [json.loads(v) for v in df.toJSON().collect()]
            (root / f"{name}.json").write_text(json.dumps(rows))
        self.warehouse = WH.Warehouse(spark, str(root / "warehouse"))
        self.loads = 0

    def demo(self):
        return demo_rows(self.spark).orderBy("row_num").collect()

    def load(self, rows, name="sales_2026_01.csv", **options):
        self.loads += 1
        folder = self.root / f"in{self.loads}"
        folder.mkdir()
        files = rows if isinstance(rows, dict) else {name: rows}
        for file, content in files.items():
            (folder / file).write_text(
                content if isinstance(content, str) else csv_text(content)
            )
        options = {"warehouse": self.warehouse.root} | options
        return run(
            self.spark, str(folder), str(self.root / "customers.json"),
            str(self.root / "products.json"), str(self.root / "out"), TODAY, **options,
        ).first()

    def totals(self):
        row = self.warehouse.read("fact_sales").agg(
            F.count(F.lit(1)).alias("n"), F.sum("net_sales").alias("net")
        ).first()
        return row.n, row.net


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


def line(order_id, **changes):
    row = {
        "order_id": str(order_id), "order_date": "2026-01-15", "customer_id": "C001",
        "product_id": "P001", "quantity": "4", "unit_price": "25.00", "discount_rate": "0.10",
    }
    return row | changes


def test_load_twice_and_reconcile(site):
    first = site.load(site.demo())
    assert (first.rows_extracted, first.rows_valid, first.rows_rejected, first.rows_loaded) == (
        200, 172, 28, 172
    )
    assert site.totals() == (172, Decimal("51107.07"))
    keys = {r.customer_id: r.customer_key for r in site.warehouse.read("dim_customers").collect()}
    assert keys == {f"C{i:03d}": i for i in range(1, 21)}

    site.load(site.demo())
    assert site.totals() == (172, Decimal("51107.07"))
    tables = {name: site.warehouse.read(name) for name in TABLES}
    assert {r.customer_id: r.customer_key for r in tables["dim_customers"].collect()} == keys
    assert tables["stg_sales"].count() == 172 and tables["etl_rejected_sales"].count() == 28
    log = tables["etl_run_log"].collect()
    assert len(log) == 2 and {r.status for r in log} == {"SUCCESS"}

    runs = R.latest_run(tables["etl_run_log"])
    check = R.row_conservation(
        runs, tables["stg_sales"], tables["fact_sales"], tables["etl_rejected_sales"]
    ).first()
    assert (check.rows_extracted, check.staged, check.facts, check.rejected) == (200, 172, 172, 28)
    assert check.conservation_holds and check.staged_equals_facts
    both = R.both_or_neither(runs, tables["stg_sales"], tables["etl_rejected_sales"]).first()
    assert (both.in_both, both.in_neither) == (0, 0)
    lost = R.orphans(tables["fact_sales"], tables["dim_customers"], tables["dim_products"]).first()
    assert (lost.orphan_customers, lost.orphan_products) == (0, 0)
    measured = R.recomputed_measures(tables["fact_sales"], tables["stg_sales"]).first()
    assert measured.rows_compared == 172 and measured.mismatched_rows == 0
    assert [r.row_num for r in R.gap_rows(tables["fact_sales"], tables["stg_sales"]).collect()] == [
        34, 76, 118
    ]
    back = R.natural_key_facts(
        tables["fact_sales"], tables["dim_customers"], tables["dim_products"]
    ).first()
    assert (back.order_id, back.customer_id, back.product_id) == (1000, "C001", "P001")
    facts = tables["fact_sales"].select("sales_key").distinct().count()
    assert facts == 172
    payload = tables["etl_rejected_sales"].where(
        F.get_json_object("raw_payload", "$.quantity") == "three"
    )
    assert [r.row_num for r in payload.collect()] == [14]


def test_a_row_gone_from_the_file_leaves_the_facts(site):
    site.load([line(1), line(2), line(3)])
    site.load([line(1), line(2, quantity="0")])
    facts = site.warehouse.read("fact_sales").collect()
    assert [r.order_id for r in facts] == [1]
    assert [r.reason_code for r in site.warehouse.read("etl_rejected_sales").collect()] == [
        "QTY_NOT_POSITIVE"
    ]


def test_a_file_wholly_rejected_leaves_no_facts(site):
    site.load([line(1)])
    site.load([line(1, quantity="0")])
    assert site.totals() == (0, None) and site.warehouse.read("stg_sales").count() == 0
    site.load(HEADER + "\n")
    assert site.warehouse.read("etl_rejected_sales").count() == 0
    assert site.warehouse.read("etl_run_log").count() == 3


def test_another_file_takes_an_order_over(site):
    site.load([line(1), line(2)], "sales_2026_01.csv")
    site.load([line(2, quantity="8"), line(5)], "extra_2026_01.csv")
    facts = {r.order_id: (r.source_file, r.quantity)
             for r in site.warehouse.read("fact_sales").collect()}
    assert facts == {1: ("sales_2026_01.csv", 4), 2: ("extra_2026_01.csv", 8),
                     5: ("extra_2026_01.csv", 4)}
    # the first file's staging row stays, so loading that file again takes the order back …
    assert site.warehouse.read("stg_sales").count() == 4
    site.load([line(1)], "sales_2026_01.csv")
    # … and, where the file no longer holds it, removes the other file's fact
    assert sorted(r.order_id for r in site.warehouse.read("fact_sales").collect()) == [1, 5]


def test_files_of_one_load_that_share_an_order(site):
    result = site.load({"a_2026_01.csv": [line(1), line(2)], "b_2026_01.csv": [line(2, quantity="9")]})
    assert (result.rows_valid, result.rows_loaded) == (3, 2)
    facts = {r.order_id: r.source_file for r in site.warehouse.read("fact_sales").collect()}
    assert facts == {1: "a_2026_01.csv", 2: "b_2026_01.csv"}
    runs = site.warehouse.read("etl_run_log").collect()
    assert {r.source_file: r.rows_loaded for r in runs} == {"a_2026_01.csv": 1, "b_2026_01.csv": 1}
    assert len({r.run_id for r in runs}) == 2


def test_report_of_a_load(site):
    site.load([line(1), line(2)], "sales_2026_01.csv")
    site.load([line(2, quantity="8"), line(5), line(6, quantity="0")], "extra_2026_01.csv", load_id="z")
    report = {r.table_name: (r.removed, r.inserted, r.updated) for r in site.warehouse.load_report("z").collect()}
    assert report == {"dim_customers": (0, 0, 20), "dim_products": (0, 0, 15), "stg_sales": (0, 2, 0),
                      "fact_sales": (1, 2, 0), "etl_rejected_sales": (0, 1, 0)}


def test_a_file_that_loses_all_its_facts_holds_none(site):
    site.load([line(1)], "sales_2026_01.csv")
    site.load([line(1, quantity="8")], "extra_2026_01.csv")
    assert [r.source_file for r in site.warehouse.read("fact_sales").collect()] == ["extra_2026_01.csv"]
    assert site.warehouse.read("stg_sales").count() == 2


def test_a_load_that_runs_again_changes_nothing(site):
    """As after a failure between its writes: the same id, the same rows and keys, one run in the log."""
    site.load([line(1), line(2), line(3, quantity="0")], load_id="a")
    site.load([line(4)], "other_2026_01.csv", load_id="b")
    tables = {n: sorted(str(r) for r in site.warehouse.read(n).drop("loaded_at", "rejected_at", "updated_at", "started_at", "finished_at")
                        .collect()) for n in TABLES}
    site.load([line(4)], "other_2026_01.csv", load_id="b")
    again = {n: sorted(str(r) for r in site.warehouse.read(n).drop("loaded_at", "rejected_at", "updated_at", "started_at", "finished_at")
                       .collect()) for n in TABLES}
    assert again == tables and len(tables["etl_run_log"]) == 2


def test_only_touched_partitions_are_written(site):
    site.load({"a_2026_01.csv": [line(1)], "b_2026_01.csv": [line(2)]})
    folder = site.root / "warehouse" / "fact_sales"

    def outputs(name):
        return {p.name for p in (folder / f"source_file={name}").glob("*.parquet")}

    before = outputs("a_2026_01.csv"), outputs("b_2026_01.csv")
    site.load([line(3)], "b_2026_01.csv")
    assert outputs("a_2026_01.csv") == before[0] and not outputs("b_2026_01.csv") & before[1]


def test_stored_tables_are_opened_as_they_were_made(site):
    site.load([line(1), line(2)])
    # a copy elsewhere is known to no catalog yet
    shutil.copytree(site.warehouse.root, site.root / "copy")
    later = WH.Warehouse(site.spark, str(site.root / "copy"), buckets=5)
    assert later.read("fact_sales").count() == 2 and later.buckets == WH.BUCKETS


def test_facts_meet_staging_without_a_shuffle(site):
    site.load(site.demo())
    facts, staged = site.warehouse.read("fact_sales"), site.warehouse.read("stg_sales")
    old = site.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    site.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for check in (R.recomputed_measures(facts, staged), R.gap_rows(facts, staged)):
            plan = check._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan
            assert "Exchange" not in plan[plan.index("SortMergeJoin"):], plan
    finally:
        site.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_failed_load_is_not_seen(site):
    site.load([line(1)])
    before = site.totals()
    with pytest.raises(WH.ConstraintViolation, match="unit_price not null"):
        site.load([line(1), line(2, unit_price="99999999999.00")])
    assert site.totals() == before
    assert site.warehouse.read("etl_run_log").count() == 1
    with pytest.raises(SchemaMismatch):
        site.load("a,b\n1,2\n")
    assert site.totals() == before


def test_dry_run_touches_no_table(site):
    result = site.load(site.demo(), dry_run=True, warehouse=None)
    assert (result.rows_valid, result.rows_loaded, result.dry_run) == (172, 0, True)
    assert not (site.root / "warehouse").exists()
    preview = site.spark.read.option("header", True).csv(str(site.root / "out/preview_fact_sales"))
    assert tuple(preview.columns) == PREVIEW_COLUMNS and preview.count() == 172
    row = preview.where("order_id = 1000").first()
    assert (row.unit_price, row.discount_rate, row.net_sales) == ("9.99", "0.0000", "9.99")
    [folder] = (site.root / "out").glob("rejected_*")
    assert site.spark.read.option("header", True).csv(str(folder)).count() == 28


def test_sinks_write_a_header_for_no_rows(spark, tmp_path):
    rejects = spark.createDataFrame([], ddl(TABLES["etl_rejected_sales"]))
    path = write_rejected(rejects, str(tmp_path), "one")
    write_rejected(rejects, str(tmp_path), "two")
    text = "".join(p.read_text() for p in (tmp_path / "rejected_one").glob("*.csv"))
    assert text.strip() == ",".join(REJECTED_COLUMNS) and path.endswith("rejected_one")
    assert (tmp_path / "rejected_two").exists()
    facts = spark.createDataFrame([], ", ".join(f"{c} string" for c in PREVIEW_COLUMNS))
    write_preview(facts, str(tmp_path))
    write_preview(facts, str(tmp_path))
    text = "".join(p.read_text() for p in (tmp_path / "preview_fact_sales").glob("*.csv"))
    assert text.strip() == ",".join(PREVIEW_COLUMNS)


def test_upsert_overwrites_with_nulls_and_keeps_keys(spark, space):
    columns = TABLES["dim_customers"]
    now = F.lit("2026-01-01").cast("timestamp")
    later = F.lit("2026-02-01").cast("timestamp")
    incoming = "customer_id string, customer_name string, region string, segment string, signup_date date"
    first = spark.createDataFrame(
        [("B", "Bee", "N", "Retail", None), ("A", "Ay", "N", "Retail", None)], incoming
    )
    empty = spark.createDataFrame([], ddl(columns))
    dim = space.settle(
        merge.upsert_dim(empty, first, "customer_id", "customer_key", space, now), "dim"
    )
    second = spark.createDataFrame(
        [("B", "Bea", "S", None, None), ("0", "Oh", "S", None, None)], incoming
    )
    rows = merge.upsert_dim(dim, second, "customer_id", "customer_key", space, later).collect()
    assert {r.customer_id: (r.customer_key, r.customer_name, r.segment, r.updated_at.month)
            for r in rows} == {
        "A": (1, "Ay", "Retail", 1), "B": (2, "Bea", None, 2), "0": (3, "Oh", None, 2),
    }


def test_an_id_without_a_key_fails(spark):
    facts = spark.createDataFrame([(2, "C1", "P1"), (3, "C9", "P1")],
                                  "row_num bigint, customer_id string, product_id string")
    customers = spark.createDataFrame([("C1", 1)], "customer_id string, customer_key bigint")
    products = spark.createDataFrame([("P1", 1)], "product_id string, product_key bigint")
    with pytest.raises(Exception, match="row 3: customer_id C9 has no surrogate key"):
        merge.resolve_keys(facts, customers, products).collect()


def test_constraints_count_their_violations(spark):
    good = dict(
        sales_key=1, order_id=1, order_date=None, customer_key=1, product_key=1, quantity=1,
        unit_price=Decimal("1.00"), discount_rate=Decimal("0.1"), gross_sales=Decimal("1.00"),
        discount_amount=Decimal("0.18"), net_sales=Decimal("0.83"), run_id="r", loaded_at=None,
        source_file="f",
    )
    bad = [
        good, good | {"quantity": 0}, good | {"unit_price": Decimal(0), "order_id": 2},
        good | {"discount_rate": Decimal(1), "order_id": 3, "customer_key": 9},
        good | {"order_id": 4, "net_sales": None},
    ]
    facts = spark.createDataFrame([tuple(r[c] for c in TABLES["fact_sales"]) for r in bad],
                                  ddl(TABLES["fact_sales"]))
    dim = spark.createDataFrame([(1,)], "customer_key bigint")
    goods = spark.createDataFrame([(1,)], "product_key bigint")
    report = audit.constraint_audit(
        {"fact_sales": facts, "dim_customers": dim, "dim_products": goods}
    )
    found = {r.constraint_name: r.violations for r in report.where("violations > 0").collect()}
    assert found == {
        "order_date not null": 5, "loaded_at not null": 5, "net_sales not null": 1,
        "quantity > 0": 1, "unit_price > 0": 1, "0 <= discount_rate < 1": 1,
        "order_id unique": 1, "customer_key references dimension": 1,
    }
    assert set(NULLABLE) == set(TABLES)


def test_sums_follow_loads(site):
    """Sums of the files that a load touches are replaced, of no other; reports from them equal those from facts."""
    site.warehouse = WH.Warehouse(site.spark, site.warehouse.root, 2, sums=True)
    site.warehouse.ensure_tables()
    site.load({
        "a.csv": csv_text([line(1), line(2, customer_id="C002", quantity="7", discount_rate="0.0333")]),
        "b.csv": csv_text([line(3, product_id="P002"), line(4, order_date="2026-01-17")]),
        "c.csv": csv_text([line(5, customer_id="C003")]),
    })
    first = set(site.warehouse.read("sums_by_customer").inputFiles())
    site.load([line(3, quantity="9"), line(6, customer_id="C003")], name="d.csv")
    second = set(site.warehouse.read("sums_by_customer").inputFiles())
    assert {f.split("source_file=")[1][0] for f in first - second} == {"b"}
    assert {f.split("source_file=")[1][0] for f in second - first} == {"b", "d"}

    again = WH.Warehouse(site.spark, site.warehouse.root)  # the layout is the stored one
    tables = {n: again.read(n) for n in ("fact_sales", "dim_customers", "dim_products", *WH.SUMS)}
    facts, people, goods = tables["fact_sales"], tables["dim_customers"], tables["dim_products"]
    pairs = [
        (A.revenue_per_day(facts), S.revenue_per_day(tables["sums_by_day"])),
        (A.product_revenue(facts, goods), S.product_revenue(tables["sums_by_product"], goods)),
        (A.region_revenue(facts, people), S.region_revenue(tables["sums_by_customer"], people)),
        (A.customer_value(facts, people), S.customer_value(tables["sums_by_customer"], people)),
    ]
    assert (again.buckets, again.sums, facts.count()) == (2, True, 6)
    for whole, kept in pairs:
        assert whole.columns == kept.columns and whole.collect() == kept.collect()
        assert "fact_sales" not in kept._jdf.queryExecution().executedPlan().toString()


def test_buckets_follow_the_rows_of_the_first_load(site, monkeypatch):
    assert WH.buckets_for(0) == WH.buckets_for(WH.BUCKETS * WH.ROWS_PER_BUCKET) == WH.BUCKETS
    assert WH.buckets_for(216_000_000, 2) * WH.ROWS_PER_BUCKET >= 216_000_000
    monkeypatch.setattr(WH, "ROWS_PER_BUCKET", 2)
    site.load([line(n) for n in range(1, 25)])
    opened = WH.Warehouse(site.spark, site.warehouse.root)
    facts, staged = opened.read("fact_sales"), opened.read("stg_sales")
    assert (facts.count(), opened.buckets) == (24, 12)
    # no task of the join in place meets more than its share
    assert R.recomputed_measures(facts, staged).first()["rows_compared"] == 24


def test_order_ids_are_not_brought_together_where_no_other_file_is_stored(site, monkeypatch):
    calls = []
    doomed = merge.doomed_orders
    monkeypatch.setattr(merge, "doomed_orders", lambda *args: calls.append(1) or doomed(*args))
    site.load([line(1), line(2)])
    assert calls == [] and site.totals()[0] == 2
    same, other = (site.spark.createDataFrame([(f,)], "source_file string") for f in ("sales_2026_01.csv", "b.csv"))
    assert site.warehouse._holds_no_other(same) and not site.warehouse._holds_no_other(other)


def test_lines_both_staged_and_rejected_are_counted_without_lists(spark):
    runs = spark.createDataFrame([("a", "f", 5), ("b", "f", 4)], "run_id string, source_file string, rows_extracted bigint")
    at = "run_id string, source_file string, row_num bigint"
    staged = spark.createDataFrame([("a", "f", 2), ("a", "f", 2), ("b", "f", 2), ("b", "f", 3), ("a", "g", 4)], at)
    rejects = spark.createDataFrame([("b", "f", 2), ("b", "f", 2), ("a", "f", 4), ("a", "g", 4)], at)
    both = R.both_or_neither(runs, staged, rejects)
    assert {(r.in_both, r.in_neither) for r in both.collect()} == {(5, 0), (2, 0)}
    assert "collect_list" not in both._jdf.queryExecution().optimizedPlan().toString()


def test_missing_lines_are_looked_up_by_number_first(spark):
    lines = spark.range(2, 8).select(F.lit("f").alias("source_file"), F.col("id").alias("row_num"))
    lines = lines.unionByName(lines.withColumn("source_file", F.lit("g")))
    staged, rejects = lines.where("source_file = 'f' and row_num < 5"), lines.where("source_file = 'g' and row_num > 3")
    missing = R.missing_lines(lines, staged, rejects)
    assert missing.columns == ["source_file", "row_num"]
    assert {tuple(r) for r in missing.collect()} == {("f", 5), ("f", 6), ("f", 7), ("g", 2), ("g", 3)}
    plan = missing._jdf.queryExecution().analyzed().toString()
    assert plan.split("Join LeftAnti, ")[1].startswith("((row_num#")
