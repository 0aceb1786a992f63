"""The hot-key way must give what the plain window gives."""

import random

import pytest
from pyspark.sql import functions as F

from revrank.operators.features import hash_rank, stratified_folds, undersample_negatives
from revrank.operators.positions import sliding, with_position
from revrank.operators.sequences import prefix_target_samples


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = [(0 if rng.random() < 0.6 else rng.randint(1, 9), rng.randint(0, 50), n) for n in range(900)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "user_idx bigint, item_idx bigint, timestamp bigint").repartition(5)


def as_set(df):
    return sorted(map(repr, df.collect()))


def test_position_hot_equals_plain(skewed):
    plain = with_position(skewed, ["user_idx"], [F.col("timestamp").desc()])
    hot = with_position(skewed, ["user_idx"], [F.col("timestamp").desc()], hot_rows=100)
    assert as_set(plain) == as_set(hot.select(*plain.columns))


def test_global_position_is_a_permutation(skewed):
    got = with_position(skewed, [], ["timestamp"]).orderBy("timestamp").collect()
    assert [r["pos"] for r in got] == list(range(900))


@pytest.mark.parametrize("chunk", [7, 50])
def test_sliding_hot_equals_plain(skewed, chunk):
    def build(w):
        return {"back": F.sum("item_idx").over(w.rowsBetween(-5, -1)), "ahead": F.sum("item_idx").over(w.rowsBetween(1, 3))}

    args = (skewed, ["user_idx"], ["timestamp"], 5, 3, build)
    plain, hot = sliding(*args), sliding(*args, hot_rows=100, chunk=chunk)
    assert as_set(plain) == as_set(hot.select(*plain.columns))


def test_prefix_samples_hot_equals_plain(skewed):
    plain = prefix_target_samples(skewed, 6, ["timestamp"])
    hot = prefix_target_samples(skewed, 6, ["timestamp"], hot_rows=100, chunk=16)
    assert as_set(plain) == as_set(hot.select(*plain.columns))


def test_chunk_shorter_than_window_is_refused(skewed):
    with pytest.raises(ValueError):
        prefix_target_samples(skewed, 20, ["timestamp"], hot_rows=100, chunk=10)


def test_hash_rank_is_exact(skewed):
    rows = skewed.withColumn("label", (F.col("item_idx") % 3 == 0).cast("int"))
    got = hash_rank(rows, ["label"], ["timestamp"], 7).groupBy("label").agg(
        F.count("*").alias("n"), F.max("__rank").alias("m"), F.count_distinct("__rank").alias("d")
    ).collect()
    assert all(r["n"] == r["m"] == r["d"] for r in got)


def test_undersample_and_folds(skewed):
    rows = skewed.withColumn("label", (F.col("item_idx") % 5 == 0).cast("int"))
    pos = rows.filter("label = 1").count()
    counts = dict(undersample_negatives(rows, "label", ["timestamp"]).groupBy("label").count().collect())
    assert counts == {0: pos, 1: pos}
    folds = stratified_folds(rows, "label", ["timestamp"], 5).groupBy("label", "fold").count().collect()
    for lab in (0, 1):
        sizes = [r["count"] for r in folds if r["label"] == lab]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
