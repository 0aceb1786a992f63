"""Fitted models: right scores for all pairs, planted signals found, same seed same result."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from revrank.operators.features import level_table, sparse_parts, written_vectors
from revrank.operators.lambdas import lambda_gradients, newton_leaves
from revrank.plans.baselines import PopularityRecommender, RandomRecommender
from revrank.plans.linear import LogisticRecommender, SVMRecommender
from revrank.plans.sequence_models import SequenceAttentionRecommender, SequencePoolRecommender
from revrank.plans.trees import LambdaRankRecommender, RandomForestRecommender, trees_of
from revrank.session import cut


@pytest.fixture(scope="module")
def planted(spark):
    """Users of segment a buy category x, the others category y."""
    rng = np.random.default_rng(0)
    users = [(u, "ab"[u % 2], float(rng.normal()), float(rng.normal())) for u in range(40)]
    items = [(i, "xy"[i % 2], float(5 + i % 7), float(rng.normal())) for i in range(30)]
    log = []
    for u in range(40):
        for i in rng.choice(30, 12, replace=False):
            match = (u % 2) == (i % 2)
            log.append((u, int(i), float(rng.random() < (0.9 if match else 0.1)), int(rng.integers(0, 1000))))
    return (
        cut(spark.createDataFrame(log, "user_idx bigint, item_idx bigint, relevance double, timestamp bigint")),
        cut(spark.createDataFrame(users, "user_idx bigint, segment string, user_attr_0 double, user_attr_1 double")),
        cut(spark.createDataFrame(items, "item_idx bigint, category string, price double, item_attr_0 double")),
    )


def test_tree_description_gives_the_models_predictions(spark, planted):
    log, users, items = planted
    model = RandomForestRecommender(n_estimators=8, max_depth=5, min_samples_leaf=1)
    data = cut(model.training_rows(log, users, items))
    forest = model._forest().fit(data)
    names = model.user_cols + model.item_cols
    trees = trees_of(forest, len(names))
    assert len(trees) == 8
    rows = forest.transform(data).select("features", "prediction").collect()
    x = np.array([r["features"].toArray() for r in rows])
    nu = len(model.user_cols)
    total = sum(
        ((t.reach(x[:, :nu], list(range(nu))) * t.reach(x[:, nu:], list(range(nu, len(names))))) * t.value).sum(axis=1)
        for t in trees
    )
    assert np.allclose(total / 8, [r["prediction"] for r in rows])


def test_forest_scores_equal_scoring_every_pair(spark, planted):
    log, users, items = planted
    model = RandomForestRecommender(n_estimators=6, max_depth=4).fit(log, users, items)
    recs = model.predict(log, 5, users, items).collect()
    one, two = model._sides(users, items)
    u = {r["user_idx"]: [float(r[c]) for c in model.user_cols] for r in one.collect()}
    i = {r["item_idx"]: ([float(r[c]) for c in model.item_cols], r["price"]) for r in two.collect()}
    seen = {(r["user_idx"], r["item_idx"]) for r in log.collect()}

    def walk(node, x):
        while not isinstance(node, float):
            node = node[2] if x[node[0]] <= node[1] else node[3]
        return node

    for user in list(u)[:6]:
        s = {
            item: sum(walk(t.root, u[user] + f) for t in model.trees) / len(model.trees) * price
            for item, (f, price) in i.items() if (user, item) not in seen
        }
        best = sorted(s.values(), reverse=True)[:5]
        mine = sorted((r["relevance"] for r in recs if r["user_idx"] == user), reverse=True)
        assert mine == pytest.approx(best)


def test_forest_grid_finds_the_signal(planted):
    model = RandomForestRecommender(grid={"max_depth": [4], "min_samples_leaf": [2], "n_estimators": [10]}, folds=2)
    _, scores = model.grid_search(cut(model.training_rows(*planted)))
    assert len(scores) == 1 and scores[0][1] > 0.6


@pytest.mark.parametrize("penalty", ["l1", "l2"])
def test_logistic(planted, penalty):
    log, users, items = planted
    model = LogisticRecommender(penalty=penalty, max_iter=20, cv=3).fit(log, users, items)
    recs = model.predict(log, 4, users, items)
    assert set(recs.columns) == {"user_idx", "item_idx", "relevance", "price", "rank"}
    assert recs.count() == 40 * 4
    folds = model.cross_validate(log, users, items).collect()
    assert len(folds) == 3 and all(0 <= r["accuracy"] <= 1 for r in folds)


def test_svm_leaves_seen_out(planted):
    log, users, items = planted
    recs = SVMRecommender(max_iter=10).fit(log, users, items).predict(log, 4, users, items)
    assert recs.join(log, ["user_idx", "item_idx"], "left_semi").count() == 0


def test_lambda_gradients_hot_equals_plain_and_sum_to_zero(spark):
    rows = spark.createDataFrame(
        [(n, n % 3, int(n % 4 == 0), float((n * 7919) % 101)) for n in range(120)],
        "row_id bigint, user_idx bigint, label int, score double",
    )
    plain = lambda_gradients(rows, "row_id", truncation=8).orderBy("row_id").collect()
    hot = lambda_gradients(rows, "row_id", truncation=8, hot_rows=10).orderBy("row_id").collect()
    assert np.allclose([r["lambda"] for r in plain], [r["lambda"] for r in hot])
    assert abs(sum(r["lambda"] for r in plain)) < 1e-9
    assert all(r["hessian"] >= 0 for r in plain)


def test_lambda_rank_raises_ndcg(planted):
    log, users, items = planted
    model = LambdaRankRecommender(num_boost_round=5, learning_rate=0.3, max_depth=3, min_data_in_leaf=3, holdout=0.2)
    rows = model.training_rows(log, users, items)
    names = model.user_cols + model.item_cols
    before = model.ndcg(rows, [], names, 0.3)
    trees = model._boost(rows, 1.4, 0.3)
    assert model.ndcg(rows, trees, names, 0.3) > before
    model.trees = trees
    assert model.predict(log, 5, users, items).count() == 200


def test_lambda_rank_folds_scores_and_stops_early(planted, monkeypatch):
    monkeypatch.setattr(LambdaRankRecommender, "ROUNDS_PER_CUT", 2)
    kw = dict(learning_rate=0.2, max_depth=2, min_data_in_leaf=3)
    a = LambdaRankRecommender(num_boost_round=3, **kw).fit(*planted)
    monkeypatch.setattr(LambdaRankRecommender, "ROUNDS_PER_CUT", 50)
    b = LambdaRankRecommender(num_boost_round=3, **kw).fit(*planted)
    assert np.allclose(np.concatenate([t.value for t in a.trees]), np.concatenate([t.value for t in b.trees]))
    short = LambdaRankRecommender(num_boost_round=6, early_stopping_rounds=1, **kw).fit(*planted)
    assert 1 <= len(short.trees) <= 6


def test_newton_leaves_by_hand(spark):
    rows = spark.createDataFrame(
        [(0, 2.0, 1.0, 3.0), (0, -1.0, 0.5, 2.0), (1, 4.0, 2.0, 1.0), (2, 1.0, 0.0, 1.0)],
        "leaf int, lambda double, hessian double, w double",
    )
    assert dict(newton_leaves(rows, "leaf", 5.0).collect()) == pytest.approx({0: 4 / 9, 1: 4 / 7, 2: 1 / 5})
    assert dict(newton_leaves(rows, "leaf").collect())[2] == 0.0


def test_boosted_leaves_are_newton_steps_of_the_drawn_rows(planted):
    log, users, items = planted
    model = LambdaRankRecommender(max_depth=3, min_data_in_leaf=3, lambda_l2=2.0, feature_fraction=0.5)
    rows = model.training_rows(log, users, items)
    names = model.user_cols + model.item_cols
    grads = lambda_gradients(rows.select("row_id", "user_idx", "label", F.lit(0.0).alias("score")), "row_id")
    data = cut(rows.join(grads.drop("user_idx"), "row_id").filter("hessian > 1e-12")
               .select(*names, "lambda", "hessian", F.col("price").alias("w")))
    drawn = model._draw_features(len(names), 1)
    assert len(drawn) == round(len(names) / 2)
    assert any(model._draw_features(len(names), n) != drawn for n in range(2, 6))
    tree = model._grow(data, names, drawn)
    # Only drawn features are split on.
    others = [c for c in range(len(names)) if c not in drawn]
    assert np.isinf(tree.low[:, others]).all() and np.isinf(tree.high[:, others]).all()
    table = data.toPandas()
    reach = tree.reach(table[names].to_numpy(float), list(range(len(names)))).astype(bool)
    assert (reach.sum(axis=1) == 1).all() and len(tree.value) > 1
    for n, value in enumerate(tree.value):
        part = table[reach[:, n]]
        assert value == pytest.approx((part.w * part["lambda"]).sum() / ((part.w * part.hessian).sum() + 2.0))
    assert model._grow(data.limit(0), names, drawn) is None


def test_stored_scores_equal_one_sum_of_all_trees(planted, monkeypatch):
    monkeypatch.setattr(LambdaRankRecommender, "ROUNDS_PER_CUT", 2)
    model = LambdaRankRecommender(num_boost_round=5, learning_rate=0.2, max_depth=2, min_data_in_leaf=3)
    rows = model.training_rows(*planted)
    names = model.user_cols + model.item_cols
    trees = model._boost(rows, 1.4, 0.2)
    assert len(trees) == 5
    table = model._stored_scores(rows, trees, names, 0.2).toPandas()
    want = np.zeros(len(table))
    for t in trees:
        want += 0.2 * (t.reach(table[names].to_numpy(float), list(range(len(names)))) @ t.value)
    assert np.allclose(table["__base"], want)


@pytest.mark.parametrize("make", [
    lambda: SequencePoolRecommender(embed_dim=4, lr=0.1, epochs=4, max_seq_len=6),
    lambda: SequenceAttentionRecommender(dim=4, lr=0.1, epochs=4, max_len=6),
])
def test_sequence_loss_falls_and_is_repeatable(planted, make):
    log, users, items = planted
    model = make().fit(log, users, items)
    assert model.losses[-1] < model.losses[0]
    again = make().fit(log, users, items)
    assert np.allclose(model.losses, again.losses)
    recs = model.predict(log, 4, users, items)
    assert recs.join(log, ["user_idx", "item_idx"], "left_semi").count() == 0
    assert recs.groupBy("user_idx").count().agg(F.max("count")).first()[0] <= 4


@pytest.mark.parametrize("make", [
    lambda: SequencePoolRecommender(embed_dim=3, max_seq_len=5),
    lambda: SequencePoolRecommender(embed_dim=3, max_seq_len=4, chunk=5),
    lambda: SequenceAttentionRecommender(dim=3, max_len=5),
    lambda: SequenceAttentionRecommender(dim=3, max_len=4, chunk=5),
])
def test_sequence_gradient_by_differences(spark, planted, make):
    """Every component of the vectors of an item that is asked, answers, is wanted and is not wanted."""
    log, _, items = planted
    model = make()
    model._pack(log, items, ["negs", "weights"] if isinstance(model, SequenceAttentionRecommender) else [])
    emb = cut(model._vectors(model._start()))
    exact = {r["node"]: r for r in model._gradient(emb).collect()}
    assert len(exact) == 30
    eps = 1e-5
    for node, j in ((0, 0), (7, 2), (29, 1)):
        losses = []
        for sign in (1, -1):
            shift = F.when(F.col("node") == node, sign * eps).otherwise(0.0)
            losses.append(model._gradient(emb.withColumn(f"e{j}", F.col(f"e{j}") + shift)).agg(F.sum("loss")).first()[0])
        assert (losses[0] - losses[1]) / (2 * eps) == pytest.approx(exact[node][f"e{j}"], rel=1e-5, abs=1e-9)


@pytest.mark.parametrize("kind", [SequencePoolRecommender, SequenceAttentionRecommender])
def test_chunks_of_a_hot_user_give_the_same_gradient(spark, planted, kind):
    """One user holds a third of the log; cut into chunks of six rows nothing changes."""
    log, _, items = planted
    hot = log.withColumn("user_idx", F.when(F.col("user_idx") % 3 == 0, 0).otherwise(F.col("user_idx")))
    hot = cut(hot.withColumn("timestamp", F.xxhash64("user_idx", "item_idx", "timestamp") % 100_000))
    found = []
    for chunk in (2048, 6):
        model = kind(3, chunk=chunk) if kind is SequencePoolRecommender else kind(dim=3, chunk=chunk)
        model.max_len, model.time = 5, ["timestamp", "item_idx"]
        model._pack(hot, items, ["negs", "weights"] if kind is SequenceAttentionRecommender else [])
        assert model.chunks.agg(F.max(F.size("items"))).first()[0] <= chunk + 5
        rows = model._gradient(cut(model._vectors(model._start()))).orderBy("node").collect()
        found.append(np.array([[r["e0"], r["e1"], r["e2"], r["loss"]] for r in rows]))
        found[-1][:, 3] = found[-1][:, 3].sum()
    assert np.allclose(*found)


@pytest.mark.parametrize("make", [
    lambda: SequencePoolRecommender(embed_dim=4, lr=0.1, epochs=2, max_seq_len=6),
    lambda: SequenceAttentionRecommender(dim=4, lr=0.1, epochs=2, max_len=6),
])
def test_every_offered_item_has_a_vector(spark, planted, make):
    """Items without log rows, known at fit or only at predict, are offered like all others."""
    log, users, items = planted
    few = cut(log.filter("item_idx < 9"))
    later = spark.createDataFrame([(100 + i, 3.0) for i in range(4)], "item_idx bigint, price double")
    offered = items.select("item_idx", "price").unionByName(later)
    model = make().fit(few, users, items)
    assert model.state.count() == 30
    recs = model.predict(few, 40, users, offered)
    seen = few.groupBy("user_idx").agg(F.count_distinct("item_idx").alias("n"))
    wrong = recs.groupBy("user_idx").count().join(seen, "user_idx", "left").filter("count <> 34 - coalesce(n, 0)")
    assert recs.select("user_idx").distinct().count() == 40 and wrong.isEmpty()


def test_popularity_and_random(planted):
    log, users, items = planted
    pop = PopularityRecommender().fit(log).predict(log, 3, users, items)
    assert pop.count() == 120
    a = RandomRecommender(seed=1).predict(log, 3, users, items).collect()
    b = RandomRecommender(seed=1).predict(log, 3, users, items).collect()
    c = RandomRecommender(seed=2).predict(log, 3, users, items).collect()
    assert sorted(a) == sorted(b) != sorted(c)


def test_forest_probability_is_that_of_a_classifier_leaf(spark):
    """A regression tree on 0/1 labels puts the weighted share of positives in its leaves."""
    df = spark.createDataFrame([(0.0, 1.0, 2.0), (0.0, 0.0, 1.0), (1.0, 0.0, 1.0), (1.0, 0.0, 3.0)], "x double, label double, w double")
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = RandomForestRegressor(numTrees=1, maxDepth=1, weightCol="w", bootstrap=False, subsamplingRate=1.0).fit(data)
    assert sorted(trees_of(model, 1)[0].value) == pytest.approx([0.0, 2 / 3])


@pytest.fixture(scope="module")
def many_levels(spark):
    """6,000 users with 5,000 segments (ten of them null), items of two categories; 'hot' segments buy x."""
    users = [(u, None if u >= 5000 and u % 100 == 1 else f"s{u % 5000:04d}", u % 7 / 7.0) for u in range(6000)]
    items = [(i, "xy"[i % 2], float(5 + i % 7), float(i % 3)) for i in range(12)]
    log = [
        (u, i, float((u % 5000 < 2500) == (i % 2 == 0)), u % 97)
        for u in range(6000) for i in (u % 12, (u + 5) % 12)
    ]
    return (
        cut(spark.createDataFrame(log, "user_idx bigint, item_idx bigint, relevance double, timestamp bigint")),
        cut(spark.createDataFrame(users, "user_idx bigint, segment string, user_attr_0 double")),
        cut(spark.createDataFrame(items, "item_idx bigint, category string, price double, item_attr_0 double")),
    )


def test_level_table_numbers_every_value(many_levels):
    _, users, _ = many_levels
    rows = level_table(users, ["segment"]).collect()
    assert sorted(r["level"] for r in rows) == list(range(5000))
    ordered = [r["value"] for r in sorted(rows, key=lambda r: r["level"])]
    assert ordered == sorted(ordered) and None not in ordered
    assert level_table(users, []).count() == 0
    assert level_table(users.limit(0), ["segment"]).count() == 0


def test_written_vectors_equal_one_hot_by_hand(spark):
    df = spark.createDataFrame(
        [(1, "b", "q", 2.0), (2, None, "q", None), (3, "a", None, 0.5), (3, "a", None, 0.5)],
        "id int, one string, two string, x double",
    )
    levels = cut(level_table(df, ["one", "two"]))
    parts = sparse_parts(df, "id", [F.col("x")], ["one", "two"], levels, 0, "p")
    made = written_vectors(parts, ["p"], 1 + levels.count())
    got = sorted((r["id"], list(r["features"].toArray())) for r in made.collect())
    # Places: x, one=a, one=b, two=q.
    assert got == [
        (1, [2.0, 0.0, 1.0, 1.0]), (2, [0.0, 0.0, 0.0, 1.0]), (3, [0.5, 1.0, 0.0, 0.0]), (3, [0.5, 1.0, 0.0, 0.0]),
    ]


@pytest.mark.parametrize("make", [lambda: LogisticRecommender(max_iter=15), lambda: SVMRecommender(max_iter=8)])
def test_linear_models_take_thousands_of_levels(spark, many_levels, make):
    log, users, items = many_levels
    model = make().fit(log, users, items)
    data = model._design(log, users, items)
    estimator = LogisticRegression(maxIter=0) if isinstance(model, LogisticRecommender) else None
    assert estimator is None or estimator.fit(data).numFeatures == 5000 + 2 + 2 + 1
    # The logit of a side by the joins equals the sum of the row's weights by hand.
    weights = {(r["column"], r["value"]): r["weight"] for r in model.level_weights["user_idx"].collect()}
    assert len(weights) > 4000
    number = model.number_weights["user_idx"]["user_attr_0"]
    scale = model.scaler
    rows = model._part(users, "user_idx", model.intercept).collect()
    assert len(rows) == 6000
    for r in rows[::37]:
        x = r["user_attr_0"]
        if "user_attr_0" in scale.mean:
            x = (x - scale.mean["user_attr_0"]) / scale.std["user_attr_0"]
        assert r["__part"] == pytest.approx(model.intercept + number * x + weights.get(("segment", r["segment"]), 0.0))
    recs = model.predict(log, 3, users.limit(50), items)
    assert recs.groupBy("user_idx").count().filter("count = 3").count() == 50
    plan = model._part(users, "user_idx", 0.0)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 6000


def test_forest_takes_thousands_of_levels(spark, many_levels):
    log, users, items = many_levels
    model = RandomForestRecommender(n_estimators=3, max_depth=4, min_samples_leaf=1)
    data = model.training_rows(log, users, items)
    forest = model._forest().fit(data)
    assert forest.numFeatures == 1 + 5000 + 2 + 2
    model._keep(forest)
    names = model.user_cols + model.item_cols
    assert all(t.low.shape[1] == len(names) < 100 for t in model.trees)
    # Compact trees over named columns give what the fitted forest predicts for the same pairs.
    one, two = model._sides(users, items)
    pairs = log.join(one, "user_idx").join(two, "item_idx")
    score = sum((t.column(names) for t in model.trees), F.lit(0.0)) / len(model.trees)
    kept = pairs.select(F.round(score, 9).alias("p")).distinct()
    theirs = forest.transform(data).select(F.round("prediction", 9).alias("p")).distinct()
    assert theirs.join(kept, "p", "left_anti").count() == 0
    recs = model.predict(log, 3, users.limit(40), items)
    assert recs.groupBy("user_idx").count().filter("count = 3").count() == 40
