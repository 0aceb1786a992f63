"""Fitted models. Training is iterative, so these have no SQL; tests check their properties."""

from __future__ import annotations

from pyspark.sql import DataFrame

from revrank.operators.sampling import temporal_split
from revrank.plans.graph_models import GATRecommender, GCNRecommender, LightGCNRecommender
from revrank.plans.linear import LogisticRecommender, SVMRecommender
from revrank.plans.sequence_models import SequenceAttentionRecommender, SequencePoolRecommender
from revrank.plans.trees import LambdaRankRecommender, RandomForestRecommender
from revrank.registry.base import query
from revrank.sources import tables

K = 10


def star(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Early iterations of the order log, users, items."""
    train, _test = temporal_split(tables.star_log(spark, d).select(*tables.LOG_COLUMNS), 3)
    return train, tables.star_users(spark, d), tables.star_items(spark, d)


@query("rec_logistic")
def _(spark, d):
    log, users, items = star(spark, d)
    model = LogisticRecommender(max_iter=30).fit(log, users, items)
    return model.predict(log, K, users, items, filter_seen_items=True)


@query("logistic_cv_accuracy")
def _(spark, d):
    log, users, items = star(spark, d)
    return LogisticRecommender(max_iter=20).cross_validate(log, users, items)


@query("rec_svm")
def _(spark, d):
    log, users, items = star(spark, d)
    return SVMRecommender(max_iter=15).fit(log, users, items).predict(log, K, users, items)


@query("rec_random_forest")
def _(spark, d):
    log, users, items = star(spark, d)
    model = RandomForestRecommender().fit(log, users, items)
    return model.predict(log, K, users, items)


@query("forest_grid_search")
def _(spark, d):
    log, users, items = star(spark, d)
    model = RandomForestRecommender()
    _search, scores = model.grid_search(model.training_rows(log, users, items))
    rows = [(s["max_depth"], s["min_samples_leaf"], s["n_estimators"], auc) for s, auc in scores]
    return spark.createDataFrame(rows, "max_depth int, min_samples_leaf int, n_estimators int, auc double")


@query("rec_lambda_rank")
def _(spark, d):
    log, users, items = star(spark, d)
    model = LambdaRankRecommender(num_boost_round=4, learning_rate=0.1, max_depth=4).fit(log, users, items)
    return model.predict(log, K, users, items)


@query("rank_auto_tune")
def _(spark, d):
    log, users, items = star(spark, d)
    rows = LambdaRankRecommender().auto_tune(log, users, items)
    return spark.createDataFrame(rows, "price_pow double, alpha double, learning_rate double, pseudo_revenue double")


def clicks(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Early iterations of the click log, its users, priced items."""
    train, _test = temporal_split(tables.event_log(spark, d), 3)
    return train, tables.event_users(spark, d), tables.event_items(spark, d)


def _graph(spark, d, model):
    log, users, items = clicks(spark, d)
    return model.fit(log, users, items).predict(log, K, users, items)


@query("rec_lightgcn")
def _(spark, d):
    return _graph(spark, d, LightGCNRecommender(n_epochs=3, dim=8, lr=0.05))


@query("rec_gcn")
def _(spark, d):
    return _graph(spark, d, GCNRecommender(embedding_dim=8, num_layers=2, lr=0.05, n_epochs=3))


@query("rec_gat")
def _(spark, d):
    return _graph(spark, d, GATRecommender(embedding_dim=8, heads=4, lr=0.05, n_epochs=2))


@query("rec_sequence_pool")
def _(spark, d):
    log, users, items = clicks(spark, d)
    model = SequencePoolRecommender(embed_dim=8, lr=0.02, epochs=3, max_seq_len=20, time=tables.EVENT_ORDER)
    return model.fit(log, users, items).predict(log, K, users, items)


@query("rec_sequence_attention")
def _(spark, d):
    log, users, items = clicks(spark, d)
    model = SequenceAttentionRecommender(dim=8, lr=0.02, epochs=2, max_len=20, time=tables.EVENT_ORDER)
    return model.fit(log, users, items).predict(log, K, users, items)
