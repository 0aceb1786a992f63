"""Negatives, streams over several files, metrics by hand, schema repair."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from revrank.operators import evaluate, sampling
from revrank.operators.aggregates import (
    distinct_counts,
    histogram,
    joined_distinct_counts,
    joined_high_cardinality,
    joined_numeric_columns,
)
from revrank.operators.features import align_columns, fit_scaler, one_hot
from revrank.operators.joins import enrich_interactions
from revrank.operators.ngram import ngram_counts
from revrank.operators.ranking import top_k
from revrank.operators.sequences import last_n_history
from revrank.sources import schema, tables
from revrank.streaming import incremental
from tests.conftest import FOLDER


def test_negatives_are_unseen_even_when_nearly_all_is_seen(spark):
    seen = [(0, i) for i in range(50) if i != 37] + [(1, 3), (1, 4)]
    edges = spark.createDataFrame(seen, "user_idx bigint, item_idx bigint")
    items = spark.createDataFrame([(i,) for i in range(50)], "item_idx bigint")
    got = sampling.negative_sample_unseen(edges, ["user_idx", "item_idx"], edges, sampling.numbered_items(items)).collect()
    assert len(got) == len(seen)
    assert all((r["user_idx"], r["neg_idx"]) not in set(seen) for r in got)
    assert {r["neg_idx"] for r in got if r["user_idx"] == 0} == {37}


def test_users_who_saw_everything_have_no_negative(spark):
    edges = spark.createDataFrame([(0, 0), (0, 1), (1, 0)], "user_idx bigint, item_idx bigint")
    slots = sampling.numbered_items(edges)
    got = sampling.negative_sample_bipartite(edges, slots).collect()
    assert [(r["user_idx"], r["item_idx"]) for r in got] == [(1, 1)]


def test_dropout_share_and_repeatability(spark):
    edges = spark.range(4000).select(F.col("id").alias("user_idx"), (F.col("id") % 7).alias("item_idx"))
    kept = sampling.edge_dropout(edges, 0.25, 1)
    assert abs(kept.count() / 4000 - 0.75) < 0.03
    assert kept.exceptAll(sampling.edge_dropout(edges.repartition(3), 0.25, 1)).isEmpty()
    assert sampling.edge_dropout(edges, 0.0, 1).count() == 4000


@pytest.fixture(scope="module")
def slices(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("slices")
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    for n in range(3):
        events.filter(F.col("event_id") % 3 == n).coalesce(1).write.parquet(str(folder / f"part{n}"))
    for n in range(3):
        for f in (folder / f"part{n}").glob("*.parquet"):
            (folder / f"events-{n}.parquet").write_bytes(f.read_bytes())
    return folder


def test_streamed_history_equals_batch(spark, slices, tmp_path):
    stream = tables.events_as_log(incremental.event_stream(spark, str(slices)))
    got = incremental.stream_user_history(stream, 20, tables.EVENT_ORDER, str(tmp_path / "out"), str(tmp_path / "state"))
    want = last_n_history(tables.event_log(spark, FOLDER), 20, tables.EVENT_ORDER).drop("recency")
    # Only the newest place table and the one before it stay.
    assert sorted(f.name for f in (tmp_path / "out" / "places").glob("v=*")) == ["v=1", "v=2"]
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


LOG = "user_idx bigint, item_idx bigint, timestamp bigint"


def _slice_files(spark, folder, slices):
    for n, rows in enumerate(slices):
        spark.createDataFrame(rows, LOG).coalesce(1).write.parquet(str(folder / f"part{n}"))
        (found,) = (folder / f"part{n}").glob("*.parquet")
        target = folder / f"events-{n}.parquet"
        target.write_bytes(found.read_bytes())
        os.utime(target, (1_700_000_000 + n, 1_700_000_000 + n))


def test_a_slice_of_one_user_rewrites_one_bucket(spark, tmp_path):
    first = [(u, u % 5, t) for u in range(40) for t in range(4)]
    slices = [first, [(3, 9, 7), (3, 8, 0)], [(3, 7, 9)], [(4, 1, 9)]]
    _slice_files(spark, tmp_path, slices)
    out, state = tmp_path / "out", str(tmp_path / "state")
    stream = incremental.event_stream(spark, str(tmp_path))
    got = incremental.stream_user_history(stream, 3, ["timestamp", "item_idx"], str(out), state, buckets=8)
    want = last_n_history(spark.createDataFrame(sum(slices, []), LOG), 3, ["timestamp", "item_idx"]).drop("recency")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    buckets = {n: {f.name for f in (out / "rows" / f"v={n}").glob("bucket=*")} for n in range(4)}
    assert [len(buckets[n]) for n in (1, 2, 3)] == [0, 1, 1]  # the bucket of batch 1 was replaced and is deleted
    # Batch 0's bucket of user 3 went with batch 1; that of user 4 stays while batch 2 may be the start of a re-run.
    assert buckets[0] & buckets[2] == set() and len(buckets[0]) == 7
    again = incremental.BucketedHistory(spark, str(out), 3, ["timestamp", "item_idx"], stream.schema, 8)
    again.merge(spark.createDataFrame(slices[3], LOG), 3)
    assert sorted(map(tuple, again.rows(3).collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("fold_every", [2, 16])
def test_streamed_ngram_counts_equal_one_fit(spark, tmp_path, fold_every):
    rng = random.Random(fold_every)
    rows = [(rng.choice([0, 0, 0, 1, 2, None]), rng.randint(0, 3), t) for t in range(60)]
    rng.shuffle(rows)  # late rows come, and windows leave the 8 newest rows again
    slices = [rows[:25], rows[25:26], rows[26:40], rows[40:55], rows[55:]]
    _slice_files(spark, tmp_path, slices)
    stream = incremental.event_stream(spark, str(tmp_path))
    out = tmp_path / "out"
    got = incremental.stream_ngram_counts(
        stream, 2, ["timestamp"], str(out), str(tmp_path / "state"), max_len=8, buckets=4, fold_every=fold_every
    )
    want = ngram_counts(spark.createDataFrame(rows, LOG), 2, ["timestamp"], 8)
    assert sorted((tuple(r["ctx"]), r["item_idx"], r["c"]) for r in got.collect()) == sorted(
        (tuple(r["ctx"]), r["item_idx"], r["c"]) for r in want.collect()
    )
    kept = sorted(f.name for f in (out / "counts").glob("v=*"))
    assert kept == (["v=1", "v=2", "v=3", "v=4"] if fold_every == 2 else [f"v={n}" for n in range(5)])


def test_streamed_popularity_equals_batch_and_resumes(spark, slices, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        stream = tables.events_as_log(incremental.event_stream(spark, str(slices)))
        got = dict(incremental.stream_item_popularity(stream, out, state).collect())
    want = dict(tables.event_log(spark, FOLDER).groupBy("item_idx").agg(F.sum("relevance")).collect())
    assert got == want


def test_metrics_by_hand(spark):
    recs = spark.createDataFrame([(0, 7, 1), (0, 8, 2), (1, 7, 1), (1, 9, 2)], "user_idx bigint, item_idx bigint, rank int")
    test = spark.createDataFrame([(0, 8, 1.0), (0, 5, 1.0), (1, 6, 1.0), (2, 7, 0.0)], "user_idx bigint, item_idx bigint, relevance double")
    items = spark.createDataFrame([(i, float(i)) for i in range(10)], "item_idx bigint, price double")
    got = evaluate.ranking_metrics(recs, test, items, 2).first()
    third = 1 / math.log2(3)
    assert got["precision_at_k"] == pytest.approx(0.25)
    assert got["mrr"] == pytest.approx(0.25)
    assert got["hit_rate"] == pytest.approx(0.5)
    assert got["ndcg_at_k"] == pytest.approx(third / (1 + third) / 2)
    assert got["revenue"] == pytest.approx(8.0)
    assert got["discounted_revenue"] == pytest.approx(8 * third)
    held = evaluate.dcg_revenue(recs, test, items).first()[0]
    assert held == pytest.approx(8 * third / 4)


def test_dcg_geometric_by_hand(spark):
    recs = spark.createDataFrame([(0, 1, 2.0), (0, 2, 1.0), (1, 1, 4.0)], "user_idx bigint, rank int, relevance double")
    assert evaluate.dcg_geometric(recs).first()[0] == pytest.approx(((2 + 0.85) + 4) / 2)


def test_auc_with_ties(spark):
    rows = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.2), (0, 0.1)], "label int, score double")
    assert evaluate.roc_auc(rows).first()[0] == pytest.approx(0.625)


def test_histogram_of_a_constant(spark):
    one = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert [tuple(r) for r in histogram(one, "x", 5).collect()] == [(0, 2)]


def test_unknown_level_is_all_zeros_and_columns_align(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    hot = one_hot(df, {"c": ["a", "b"]})
    assert sorted(map(tuple, hot.collect())) == [(0, 0), (0, 0), (1, 0)]
    assert align_columns(hot, ["c_b", "c_q", "c_a"]).columns == ["c_b", "c_q", "c_a"]


def test_scaler_uses_population_deviation_and_guards_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaler = fit_scaler(df, ["a", "b"])
    assert scaler.std == {"a": 1.0, "b": 1.0}
    assert sorted(r["a"] for r in scaler.transform(df).collect()) == [-1.0, 1.0]


def test_schema_repair(spark, mini):
    log, _, items = mini
    bare = log.select("user_idx", "item_idx")
    assert schema.with_default_columns(bare).first()["price"] == 1.0
    assert schema.with_default_columns(log) is log
    assert schema.price_from_items(log, items) is log
    assert schema.price_from_items(bare, None).first()["price"] == 1.0
    typed = schema.as_recommendations(top_k(log, 2))
    assert [t for _, t in typed.dtypes] == ["bigint", "bigint", "float", "int"]
    assert schema.attribute_columns(spark.createDataFrame([(1, 2)], "user_attr_1 int, x int"), "user_attr_") == ["user_attr_1"]


def test_distinct_counts_of_the_join_without_the_join(spark):
    log = spark.createDataFrame(
        [(0, 0, 1.0), (0, 1, 0.0), (1, 1, -0.0), (7, 0, 5.0), (1, 9, 6.0)], "user_idx bigint, item_idx bigint, relevance double"
    )
    users = spark.createDataFrame(
        [(0, "a", 1), (1, "a", None), (2, "z", 3)], "user_idx bigint, segment string, user_attr_0 int"
    )
    items = spark.createDataFrame(
        [(0, None, 2.0), (1, None, float("nan")), (1, None, 4.0), (5, "q", 9.0)], "item_idx bigint, category string, price double"
    )
    wide = enrich_interactions(log, users, items)
    want = {c: wide.agg(F.count_distinct(c)).first()[0] for c in wide.columns}
    assert want["relevance"] == 2 and want["category"] == 0 and want["price"] == 3
    got = joined_distinct_counts(log, users, items, wide.columns)
    assert dict(got.collect()) == want
    assert dict(distinct_counts(wide, wide.columns).collect()) == want
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    none = joined_distinct_counts(log.limit(0), users, items, wide.columns)
    assert dict(none.collect()) == dict.fromkeys(want, 0)
    assert {r["column"] for r in joined_numeric_columns(log, users, items, 2).collect()} == {"price"}
    assert [r["column"] for r in joined_high_cardinality(log, users, items, 1).collect()] == ["segment"]
