"""The registered queries beside their SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from checks.compare import TABLES, rows_of
from tallyworks.plans.order_queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
@pytest.mark.parametrize(
    "name",
    ["q2_product_revenue", "q3_region_revenue_share", "q5_rejections_by_reason",
     "k_rejected_records", "k_dim_upsert_customers", "k_load_report", "k_sums_after_reload", "r2_measure_recompute",
     "c_fk_violations", "s_file_shapes", "s_reference_shapes"],
)
def test_query_matches_its_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    df = E.queries()[name](spark, SMALL)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    relation = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert ours == rows_of(list(relation.columns), relation.fetchall())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
@pytest.mark.parametrize("name", ["s_file_shapes", "s_file_gate"])
def test_written_files_where_the_first_split_has_no_row(spark, name):
    """A stored table's first split can lie before the middle of its row group; its task then has no line to write."""
    small = {"spark.sql.files.maxPartitionBytes": "32k", "spark.sql.files.openCostInBytes": "1k"}
    before = {key: spark.conf.get(key) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        df = E.queries()[name](spark, SMALL)
        ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    duck = duckdb.connect()
    for table in TABLES:
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    relation = duck.sql(E.oracle_sql()[name])
    assert ours == rows_of(list(relation.columns), relation.fetchall())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
def test_entry(spark):
    assert E.entry(spark).count() == 5
