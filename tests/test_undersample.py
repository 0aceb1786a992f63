"""Undersampling keeps the rows of the smallest hash ranks and ranks only the bucket the limit falls in."""

import pytest
from pyspark.sql import functions as F

from revrank.operators.features import hash_rank, undersample_negatives
from revrank.session import cut


@pytest.mark.parametrize("every", [3, 40, 2000, 100000])
def test_kept_rows_are_those_of_the_smallest_ranks(spark, every):
    """More negatives than positives, fewer, and no positive at all."""
    rows = cut(spark.range(20000).select("id", (F.col("id") % every == 1).cast("int").alias("label")).filter(f"id <> 1 OR {every} < 100000"))
    got = undersample_negatives(rows, "label", ["id"], 7)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(label" not in plan and "BroadcastHashJoin" in plan
    positives = rows.filter("label = 1").count()
    best = hash_rank(rows.filter("label = 0"), ["label"], ["id"], 7).filter(F.col("__rank") <= positives)
    want = sorted(r["id"] for r in best.collect()) + sorted(r["id"] for r in rows.filter("label = 1").collect())
    assert sorted(want) == sorted(r["id"] for r in got.collect())
    assert got.columns == rows.columns
