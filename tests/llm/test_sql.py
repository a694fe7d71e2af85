import duckdb
import pytest

from tallyworks.llm.queries import QUERIES
from tallyworks.llm.sql import oracle

FOLDER = "/root/testdata/sf0.001"


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle()))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    ours, theirs = QUERIES[name](spark, FOLDER), duck.sql(oracle()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours.collect(), ours.columns) == plain(theirs.fetchall(), theirs.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(oracle()) - {"op11_spelling_variants"}))
def test_query_returns_every_document(spark, name):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert QUERIES[name](spark, FOLDER).select("doc_id").exceptAll(documents.select("doc_id")).isEmpty()
    assert QUERIES[name](spark, FOLDER).count() == documents.count()
