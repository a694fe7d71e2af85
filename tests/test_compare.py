from pyspark.sql import functions as F

from tallyworks.plans import reconcile as R


def test_multisets_are_compared(spark, space):
    """Order, partitions and column order don't matter; repeats, nulls and altered values do."""
    left = spark.range(500).selectExpr("id AS k", "if(id % 50 = 0, null, id) AS v", "'a' AS t")
    same = left.orderBy(F.desc("k")).repartition(3).select("t", "v", "k")
    assert R.differing_rows(left, same, "k", space).isEmpty()
    more = [(7, 7, "a"), (900, None, "a"), (8, 9, "a")]
    right = left.where("k <> 8").unionByName(spark.createDataFrame(more, left.schema))
    found = R.differing_rows(left, right, "k", space).collect()
    assert {(r.k, r.v, r.in_left, r.in_right) for r in found} == {
        (7, 7, 1, 2), (900, None, 0, 1), (8, 8, 1, 0), (8, 9, 0, 1)}
    assert R.differing_rows(left.limit(0), left.limit(0), "k", space).isEmpty()
