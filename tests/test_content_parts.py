"""The content model where items do not fit one broadcast: the same lists, and no row of a pair holds a vector in a shuffle."""

import re

import numpy as np
import pytest

from revrank.operators import blocked
from revrank.operators.blocked import blocked_topk
from revrank.plans import baselines
from revrank.plans.baselines import ContentRecommender, _mean_vectors
from revrank.session import cut


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(4)
    log = [(int(u), int(i), float(rng.random() < 0.5)) for u in range(30) for i in rng.choice(70, 9)]
    vectors = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)] + [(7, [1.0, 0.0, 0.0, 0.0])]
    return (
        cut(spark.createDataFrame(log, "user_idx bigint, item_idx bigint, relevance double")),
        cut(spark.createDataFrame(vectors, "item_idx bigint, vector array<double>")),
    )


def test_parts_give_the_same_lists(tables, monkeypatch):
    log, vectors = tables
    users, found = log.select("user_idx").distinct(), []
    whole = blocked_topk.__defaults__
    for most in (1 << 20, 300):
        monkeypatch.setattr(baselines, "BROADCAST_BYTES", most)
        monkeypatch.setattr(blocked_topk, "__defaults__", tuple(most if v == blocked.BROADCAST_BYTES else 8 if v == blocked.ITEM_BLOCK else v for v in whole))
        rows = ContentRecommender(-0.5).fit(log, None, vectors).predict(log, 5, users, vectors.select("item_idx").distinct()).collect()
        found.append(sorted((r["user_idx"], r["rank"], r["item_idx"], round(r["relevance"], 5)) for r in rows))
    assert found[0] == found[1] and len(found[0]) > 100


def test_items_beyond_a_broadcast_shuffle_each_user_once(tables):
    """Before, a copy of every user vector went to each block of items."""
    log, vectors = tables
    users = log.select("user_idx").distinct().selectExpr("user_idx", "array(1D, 0D, 0D, 0D) AS uvec")
    asked = []

    def packed(*args, whole=blocked._packed_users):
        asked.append(args[4])
        return whole(*args)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(blocked, "_packed_users", packed)
        rows = blocked_topk(users, vectors.selectExpr("item_idx", "vector AS ivec"), 3, user_block=1, item_block=4, broadcast_bytes=400)
        assert rows.count() == 90
    assert asked == [1]


def test_profiles_shuffle_only_pairs(tables):
    log, vectors = tables
    liked = cut(log.filter("relevance > 0").select("user_idx", "item_idx").distinct())
    plan = _mean_vectors(liked, vectors.withColumnRenamed("vector", "ivec"), 4)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert len([line for line in shuffled if re.search(r"hashpartitioning\(user_idx", line)]) == 1
    assert not any("vector" in line or "sum" in line for line in shuffled)
