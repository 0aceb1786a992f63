"""Message passing: copies of hot nodes, symmetry, gradients, attention."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from revrank.functions.vectors import names
from revrank.operators import graph
from revrank.plans.graph_models import GATRecommender, GCNRecommender, LightGCNRecommender
from revrank.session import cut

D = 4


@pytest.fixture(scope="module")
def net(spark):
    rng = random.Random(5)
    pairs = {(u, rng.randint(0, 5)) for u in range(8) for _ in range(4)} | {(u, 0) for u in range(8)}
    edges = spark.createDataFrame(sorted(pairs), "user_idx bigint, item_idx bigint")
    return cut(edges), sorted(pairs)


def random_table(spark, nodes, seed):
    rng = np.random.default_rng(seed)
    rows = [(r["node"], r["copies"], *map(float, rng.normal(size=D))) for r in nodes.orderBy("node").collect()]
    schema = "node bigint, copies int, " + ", ".join(f"{c} double" for c in names(D))
    return spark.createDataFrame(rows, schema)


def matrix(df):
    return np.array([[r[c] for c in names(D)] for r in df.orderBy("node").collect()])


def test_copies_do_not_change_the_sum(spark, net):
    directed = graph.bidirectional_edges(net[0], 8)
    out = []
    for per_copy in (1_000, 2):
        edges, nodes = graph.normalized_edges(directed, edges_per_copy=per_copy)
        if per_copy == 2:
            assert nodes.agg(F.max("copies")).first()[0] >= 4
        out.append(matrix(graph.lightgcn_propagate(random_table(spark, nodes, 1), edges, nodes, D)))
    assert np.allclose(*out)


@pytest.mark.parametrize("kind", ["light", "gcn"])
def test_propagation_is_symmetric(spark, net, kind):
    directed = graph.bidirectional_edges(net[0], 8)
    edges, nodes = graph.normalized_edges(directed, self_loops=kind == "gcn")
    run = graph.lightgcn_propagate if kind == "light" else graph.gcn_propagate
    x, y = random_table(spark, nodes, 1), random_table(spark, nodes, 2)
    left = (matrix(x) * matrix(run(y, edges, nodes, D, 2))).sum()
    right = (matrix(run(x, edges, nodes, D, 2)) * matrix(y)).sum()
    assert left == pytest.approx(right)


def test_light_gcn_gradient_by_differences(spark, net):
    """The gradient the trainer uses equals a difference quotient of the loss."""
    model = LightGCNRecommender(dim=D, reg_lambda=0.0)
    log = net[0].withColumn("relevance", F.lit(1.0))
    items = spark.createDataFrame([(i, 2.0 + i) for i in range(6)], "item_idx bigint, price double")
    model._set_up(log, None, items)
    edges = cut(model._edges(graph.bidirectional_edges(model.edges, model.n_users)))
    samples = cut(model._samples(model.edges, 0))
    n = model.edges.count()
    start = random_table(spark, model.nodes, 3)

    def loss(e):
        return model._gradients(model._forward(e, edges), samples, n).agg(F.sum("loss")).first()[0]

    grad = model._gradients(model._forward(start, edges), samples, n).drop("loss")
    exact = matrix(model._backward(grad, edges))
    nodes = [r["node"] for r in model.nodes.orderBy("node").collect()]
    for node, c in ((nodes[0], 0), (nodes[-1], 2)):
        eps = 1e-5
        up = start.withColumn(f"e{c}", F.col(f"e{c}") + F.when(F.col("node") == node, eps).otherwise(0.0))
        down = start.withColumn(f"e{c}", F.col(f"e{c}") - F.when(F.col("node") == node, eps).otherwise(0.0))
        assert (loss(up) - loss(down)) / (2 * eps) == pytest.approx(exact[nodes.index(node), c], rel=1e-4, abs=1e-9)


@pytest.mark.parametrize("make", [
    lambda: GCNRecommender(embedding_dim=D, num_layers=2, seed=3), lambda: GATRecommender(embedding_dim=D, heads=2, seed=3),
])
def test_layer_gradients_by_differences(spark, net, make, monkeypatch):
    """Start vectors, matrices, biases and attention coefficients, with hot nodes split into copies."""
    monkeypatch.setattr(graph.node_copies, "__defaults__", (7,))
    model = make()
    log = net[0].withColumn("relevance", F.lit(1.0))
    items = spark.createDataFrame([(i, 2.0) for i in range(7)], "item_idx bigint, price double")
    model._set_up(log, None, items)
    assert model.nodes.agg(F.max("copies")).first()[0] > 1
    edges = cut(model._edges(graph.bidirectional_edges(model.edges, model.n_users)))
    samples = cut(model._samples(model.edges, 0))
    n = model.edges.count()
    start = cut(random_table(spark, model.nodes, 3))
    # Zero biases would hide a wrong sign.
    model.parameters = [p + 0.1 for p in model.parameters]
    model.reg_lambda = 0.0

    def loss(e):
        return model._gradients(cut(model._forward(e, edges)), samples, n).agg(F.sum("loss")).first()[0]

    exact = matrix(model._backward(model._gradients(cut(model._forward(start, edges)), samples, n).drop("loss"), edges))
    nodes = [r["node"] for r in model.nodes.orderBy("node").collect()]
    eps, found = 1e-5, model.gradients
    for node, c in ((nodes[0], 0), (nodes[-1], 2)):
        both = [loss(start.withColumn(f"e{c}", F.col(f"e{c}") + F.when(F.col("node") == node, s * eps).otherwise(0.0))) for s in (1, -1)]
        assert (both[0] - both[1]) / (2 * eps) == pytest.approx(exact[nodes.index(node), c], rel=1e-4, abs=1e-8)
    for k, p in [x for x in enumerate(model.parameters) if x[0] in (0, 1, 2, 5)]:
        place = (1, 2) if p.ndim == 2 else (k % D,)
        both = []
        for s in (1, -1):
            p[place] += s * eps
            both.append(loss(start))
            p[place] -= s * eps
        assert (both[0] - both[1]) / (2 * eps) == pytest.approx(found[k][place], rel=1e-4, abs=1e-8), k


def test_identity_matrices_give_the_plain_propagation(spark, net):
    model = GCNRecommender(embedding_dim=D, num_layers=3)
    model._set_up(net[0].withColumn("relevance", F.lit(1.0)), None, None)
    model.parameters = [x for _ in range(3) for x in (np.eye(D), np.zeros(D))]
    edges = cut(model._edges(graph.bidirectional_edges(model.edges, model.n_users)))
    start = random_table(spark, model.nodes, 2)
    assert np.allclose(matrix(model._forward(start, edges)), matrix(graph.gcn_propagate(start, edges, model.nodes, D, 3)))


def test_attention_weights_sum_to_one_and_copies_agree(spark, net):
    directed = graph.bidirectional_edges(net[0], 8)
    out = []
    for per_copy in (1_000, 2):
        edges, nodes = graph.attention_edges(directed, per_copy)
        emb = random_table(spark, nodes, 4)
        weights = graph.attention_weights(edges, emb, D, 2, [0.3] * D, [0.7] * D)
        sums = weights.groupBy("dst").agg(F.sum("a0").alias("a"), F.sum("a1").alias("b")).collect()
        assert all(abs(r["a"] - 1) < 1e-9 and abs(r["b"] - 1) < 1e-9 for r in sums)
        two_steps = graph.attend(weights, emb, nodes, D, 2)
        one_step = graph.attend_once(edges, emb, nodes, D, 2, [0.3] * D, [0.7] * D)
        assert np.allclose(matrix(two_steps), matrix(one_step))
        out.append(matrix(graph.gat_propagate(emb, edges, nodes, D, 2)))
    assert np.allclose(*out)


def test_attend_back_is_the_transpose(spark, net):
    edges, nodes = graph.attention_edges(graph.bidirectional_edges(net[0], 8), 2)
    x, y = random_table(spark, nodes, 1), random_table(spark, nodes, 2)
    weights = cut(graph.attention_weights(edges, x, D, 2, [1.0] * D, [1.0] * D))
    left = (matrix(y) * matrix(graph.attend(weights, x, nodes, D, 2))).sum()
    right = (matrix(graph.attend_back(weights, y, nodes, D, 2)) * matrix(x)).sum()
    assert left == pytest.approx(right)


@pytest.mark.parametrize("make", [
    lambda: GCNRecommender(embedding_dim=4, num_layers=2, lr=0.05, n_epochs=4, l2_lambda=0.0),
    lambda: GATRecommender(embedding_dim=4, heads=2, lr=0.05, n_epochs=3, l2_lambda=0.0),
])
def test_loss_falls_and_seen_is_left_out(spark, net, make):
    log = net[0].withColumn("relevance", F.lit(1.0))
    users = net[0].select("user_idx").distinct()
    items = spark.createDataFrame([(i, 2.0 + i) for i in range(6)], "item_idx bigint, price double")
    model = make().fit(log, users, items)
    assert model.losses[-1] < model.losses[0]
    assert all(np.abs(a - b).max() > 1e-3 for a, b in zip(model.parameters, model._parameters()))
    recs = model.predict(log, 3, users, items)
    assert not {(r["user_idx"], r["item_idx"]) for r in recs.collect()} & set(net[1])
    model.post_filter = True
    assert model.predict(log, 3, users, items).count() <= recs.count()
