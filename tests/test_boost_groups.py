"""Boosting on users packed into rows: the same gradients and trees as by joins, and no shuffle a round."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revrank.operators.lambdas import lambda_gradients, list_gradients
from revrank.plans.trees import LambdaRankRecommender
from revrank.session import cut


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(3)
    users = [(u, "ab"[u % 2], float(rng.normal())) for u in range(30)]
    items = [(i, "xy"[i % 2], float(5 + i % 7), float(rng.normal())) for i in range(40)]
    log = []
    for u in range(30):
        for i in rng.choice(40, 1 + u % 39, replace=False):
            log.append((u, int(i), float(rng.random() < (0.9 if u % 2 == i % 2 else 0.1)), int(rng.integers(0, 1000))))
    return (
        cut(spark.createDataFrame(log, "user_idx bigint, item_idx bigint, relevance double, timestamp bigint")),
        cut(spark.createDataFrame(users, "user_idx bigint, segment string, user_attr_0 double")),
        cut(spark.createDataFrame(items, "item_idx bigint, category string, price double, item_attr_0 double")),
    )


def test_list_gradients_equal_the_joins(spark):
    """Ties, users of one row, of one label, and of more rows than the truncation."""
    rows = [(f"{n:04d}", (n * n) % 13, int(n % 5 == 0 and (n * n) % 13 != 4), float((n * 7919) % 11)) for n in range(400)]
    rows.append(("9999", 77, 1, 0.5))
    flat = cut(spark.createDataFrame(rows, "row_id string, user_idx bigint, label int, score double"))
    listed = flat.groupBy("user_idx").agg(F.sort_array(F.collect_list(F.struct("row_id", "label", "score"))).alias("r"))
    told = listed.withColumn("g", list_gradients(F.col("r.label"), F.col("r.score"), truncation=8))
    told = told.withColumn("ids", F.col("r.row_id")).select(F.inline(F.arrays_zip("ids", "g")))
    got = {r["ids"]: (r["lambda"], r["hessian"]) for r in told.select("ids", "g.lambda", "g.hessian").collect()}
    want = {r["row_id"]: (r["lambda"], r["hessian"]) for r in lambda_gradients(flat, "row_id", truncation=8).collect()}
    assert got.keys() == want.keys() and any(v[1] > 0 for v in want.values())
    assert np.allclose([got[n] for n in sorted(got)], [want[n] for n in sorted(want)], rtol=1e-12, atol=1e-15)


def test_rounds_shuffle_nothing(tables):
    model = LambdaRankRecommender(max_depth=2, min_data_in_leaf=3)
    groups = model._training_groups(*tables)
    tree = model._grow_written(model._first(groups), tables[0].sparkSession, 1.4, len(model.user_cols + model.item_cols),
                               model._draw_features(len(model.user_cols + model.item_cols), 1))
    drawn = model._round(*model._train_groups(groups), [tree], 0.1, 2)
    assert groups[1] is None and not drawn.isEmpty()
    assert "Exchange" not in drawn._jdf.queryExecution().executedPlan().toString()


def test_large_users_give_the_same_trees(tables, monkeypatch):
    """Users kept as rows, all packed, and folded scores: three ways to the same values."""
    found = []
    for most, fold in ((1000, 20), (10, 20), (10, 2)):
        monkeypatch.setattr(LambdaRankRecommender, "GROUP_ROWS", most)
        monkeypatch.setattr(LambdaRankRecommender, "ROUNDS_PER_CUT", fold)
        model = LambdaRankRecommender(num_boost_round=4, learning_rate=0.2, max_depth=2, min_data_in_leaf=3).fit(*tables)
        # Splits that part the rows alike are equally good, so leaves may come in another order.
        found.append(np.sort(np.concatenate([t.value for t in model.trees])))
        results = model.auto_tune(*tables, price_pows=(1.1, 1.5), alphas=(0.8,), learning_rates=(0.1,))
        found[-1] = np.append(found[-1], [r[3] for r in results])
    assert np.allclose(found[0], found[1]) and np.allclose(found[0], found[2])
