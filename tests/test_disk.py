"""What stays on disk: shuffle files and passing tables go when their last reader is done."""

import os
import time

import pyarrow.parquet as pq
import pytest
from days import TODAY
from pyspark.sql import functions as F

from tallyworks.operators import judge as J
from tallyworks.plans import order_queries
from tallyworks.plans.order_queries import stored_load
from tallyworks.schemas import SALES_FIELDS
from tallyworks.sources.demo_feed import demo_customers, demo_products
from tallyworks.workspace import Workspace

SMALL = "/root/testdata/sf0.001"


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    folders = [f.getPath() for f in env.blockManager().diskBlockManager().localDirs()]
    return {f for d in folders for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


def test_a_settled_table_leaves_no_shuffle_files(spark, space):
    before = shuffle_files(spark)
    settled = space.settle(spark.range(100_000).repartition(4).groupBy(F.col("id") % 1000).count(), "counted")
    end = time.time() + 10
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert settled.count() == 1000


def test_rows_from_text_are_compressed(spark, space):
    rows = spark.range(50_000).select(F.format_string("C%012d", "id").alias("text"))
    size = {}
    for dictionary in (False, True):
        path = space.settle(rows, f"rows{dictionary}", dictionary).inputFiles()[0].removeprefix("file:")
        size[dictionary] = sum(f.stat().st_size for f in os.scandir(os.path.dirname(path)))
    assert size[False] < 0.5 * size[True]


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
@pytest.mark.parametrize("kept", [False, True])
def test_a_load_leaves_the_warehouse_alone(spark, kept):
    load, warehouse = stored_load(spark, SMALL, keep_judged=kept)
    left = {name.rsplit("/", 1)[-1].rsplit("-", 1)[0] for name, _, files in os.walk(load.space.root)
            if any(f.endswith(".parquet") for f in files) and "/warehouse" not in name}
    assert left == ({"file-offsets", "judged"} if kept else {"file-offsets"})
    assert warehouse.read("fact_sales").count() > 0
    if kept:
        assert load.judged.count() == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()


def test_a_plain_row_gives_its_raw_text_back(spark, tmp_path):
    """Texts that a typed value is not usually written as come back as they were, and so do usual ones."""
    odd = ["007", "2026-02-30", "c-x", "p#1", "04", "25.5", "0.100"]
    usual = ["8", "2026-01-15", "C404", "P001", "4", "25.00", "0.10"]
    long_rate = ["9", "2026-01-15", "C404", "P001", "4", "25", "0.123456789012"]
    loose = [" 10 ", "2026-01-15", " c404", "P001", "4", "25.00", "0.10"]
    rows = [("sales_2026_01.csv", n, *texts) for n, texts in enumerate((odd, usual, long_rate, loose), 2)]
    raw = spark.createDataFrame(rows, "source_file string, row_num bigint, " + ", ".join(f"{c} string" for c in SALES_FIELDS))
    judged = J.judge(raw, demo_customers(spark), demo_products(spark), TODAY, Workspace(spark, str(tmp_path)))
    found = {r.row_num: list(r.raw) for r in judged.collect()}
    assert found == {r[1]: list(r[2:]) for r in rows}


def test_rows_under_judgement_hold_no_text_twice(spark, tmp_path):
    usual = ("sales_2026_01.csv", 2, "8", "2026-01-15", "C001", "P001", "4", "25.00", "0.10")
    raw = spark.createDataFrame([usual], "source_file string, row_num bigint, " + ", ".join(f"{c} string" for c in SALES_FIELDS))
    space = Workspace(spark, str(tmp_path))
    J.judge(raw, demo_customers(spark), demo_products(spark), TODAY, space)
    [folder] = [d for d in os.listdir(space.root) if d.startswith("rows-")]
    assert spark.read.parquet(f"{space.root}/{folder}").first().raw is None


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
def test_files_of_records_over_lines_leave_no_feed(spark, monkeypatch):
    """The feed goes once its files are written, and landed lines and put together records are compact."""
    made = []
    monkeypatch.setattr(order_queries, "Workspace", lambda spark: made.append(Workspace(spark)) or made[-1])
    assert order_queries.s_records_over_lines(spark, SMALL).count() > 0
    left = [os.path.join(d, f) for d, _, files in os.walk(made[0].root) for f in files if f.endswith(".parquet")]
    assert not [f for f in left if "/feed-" in f]
    for name in ("/lines-", "/pieces-"):
        assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in left
                if name in f and pq.ParquetFile(f).metadata.num_row_groups} == {"ZSTD"}
