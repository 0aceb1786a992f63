"""Tuning of the boosted ranker on packed rows: the whole grid, and the same trees as by a Spark job a round."""

import numpy as np
import pytest

from revrank.operators import packed_trees
from revrank.operators.packed_trees import PackedLists, mean_ndcg
from revrank.plans.trees import LambdaRankRecommender
from revrank.registry import QUERIES
from revrank.session import cut
from tests.conftest import FOLDER


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(5)
    log = []
    for u in range(30):
        for i in rng.choice(24, 1 + u % 24, replace=False):
            log.append((u, int(i), float(rng.random() < (0.8 if u % 2 == i % 2 else 0.2))))
    return (
        cut(spark.createDataFrame(log, "user_idx bigint, item_idx bigint, relevance double")),
        cut(spark.createDataFrame([(u, "ab"[u % 2], float(u % 7)) for u in range(30)], "user_idx bigint, segment string, user_attr_0 double")),
        cut(spark.createDataFrame([(i, "xy"[i % 2], float(5 + i % 7)) for i in range(24)], "item_idx bigint, category string, price double")),
    )


def test_rank_auto_tune_boosts_the_whole_grid(spark, monkeypatch):
    asked = {}

    def tuned(self, groups, settings, alphas):
        asked.update(settings=settings, alphas=alphas, rounds=self.num_boost_round, patience=self.early_stopping_rounds, depth=self.max_depth)
        return [(list, [1.0] * len(alphas)) for _ in settings]

    monkeypatch.setattr(LambdaRankRecommender, "_packed_lists", lambda self, groups: None)
    monkeypatch.setattr(LambdaRankRecommender, "_tune_rows", tuned)
    rows = QUERIES["rank_auto_tune"](spark, FOLDER).collect()
    assert len(rows) == 48
    assert len(asked["settings"]) == 12 and len(asked["alphas"]) == 4
    assert (asked["rounds"], asked["patience"], asked["depth"]) == (2500, 200, 5)


def test_packed_rows_give_the_trees_of_the_jobs(tables, monkeypatch):
    found = []
    for most in (packed_trees.PACKED_BYTES, 0):
        monkeypatch.setattr(packed_trees, "PACKED_BYTES", most)
        model = LambdaRankRecommender(
            num_boost_round=4, early_stopping_rounds=2, max_depth=2, min_data_in_leaf=3, holdout=0.3, bagging_fraction=1.0
        )
        results = model.auto_tune(*tables, price_pows=(1.1, 1.5), alphas=(0.8, 0.9), learning_rates=(0.2,))
        found.append((results, [np.sort(t.value) for t in model.trees], (model.price_pow, model.edr_alpha)))
    (a, trees, chosen), (b, others, same) = found
    assert [r[:3] for r in a] == [r[:3] for r in b] and np.allclose([r[3] for r in a], [r[3] for r in b])
    assert chosen == same and len(trees) == len(others)
    assert all(np.allclose(x, y) for x, y in zip(trees, others))


def test_held_out_users_and_ties():
    lists = PackedLists(
        np.zeros((5, 1), np.uint8), np.array([0.0, 1, 1, 0, 1]), np.ones(5), np.array([True, True, False, False, True]), np.array([2, 2, 1])
    )
    assert lists.part(True).sizes.tolist() == [2, 1] and lists.part(True).label.tolist() == [0, 1, 1]
    # Equal scores: the earlier row first, so the first user's positive is second.
    assert mean_ndcg(np.array([0.0, 1, 1]), np.zeros(3), np.array([2, 1])) == pytest.approx((1 / np.log2(3) + 1) / 2)
    assert mean_ndcg(np.zeros(2), np.ones(2), np.array([2])) == 0.0
