"""Pruned and blocked top-k against brute force."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revrank.operators.blocked import best_of_row, blocked_logsumexp, blocked_topk
from revrank.operators.ranking import global_rank, head_of_order, top_k


def brute(users, scores, seen, k):
    out = set()
    for u in users:
        order = sorted((i for i in scores if (u, i) not in seen), key=lambda i: (-scores[i], i))
        out |= {(u, i, r + 1) for r, i in enumerate(order[:k])}
    return out


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_head_of_order_is_exact(spark, seed):
    rng = random.Random(seed)
    users, items = range(6), range(40)
    scores = {i: float(rng.randint(1, 12)) for i in items}
    # One user has seen almost everything, one nothing.
    seen = {(u, i) for u in users for i in items if rng.random() < [0.0, 0.95, 0.5, 0.2, 0.9, 1.0][u]}
    order = global_rank(spark.createDataFrame(list(scores.items()), "item_idx bigint, relevance double"),
                        [F.col("relevance").desc(), "item_idx"])
    who = spark.createDataFrame([(u,) for u in users], "user_idx bigint")
    gone = spark.createDataFrame(list(seen) or [(99, 99)], "user_idx bigint, item_idx bigint")
    got = top_k(head_of_order(who, order, gone, 5), 5)
    assert {(r["user_idx"], r["item_idx"], r["rank"]) for r in got.collect()} == brute(users, scores, seen, 5)


def _matrices(spark, nu, ni, d, seed=0):
    rng = np.random.default_rng(seed)
    u, i = rng.normal(size=(nu, d)), rng.normal(size=(ni, d))
    users = spark.createDataFrame([(n, r.tolist()) for n, r in enumerate(u)], "user_idx bigint, uvec array<double>")
    items = spark.createDataFrame([(n, r.tolist()) for n, r in enumerate(i)], "item_idx bigint, ivec array<double>")
    return u, i, users, items


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_blocked_topk_is_exact(spark, broadcast_bytes):
    u, i, users, items = _matrices(spark, 70, 90, 5)
    rng = random.Random(3)
    seen = {(a, b) for a in range(70) for b in range(90) if rng.random() < (0.98 if a == 0 else 0.3)}
    pairs = spark.createDataFrame(list(seen), "user_idx bigint, item_idx bigint")
    got = blocked_topk(users, items, 6, seen=pairs, user_block=16, item_block=20, broadcast_bytes=broadcast_bytes)
    found = {(r["user_idx"], r["item_idx"], r["rank"]) for r in got.collect()}
    want = set()
    for a in range(70):
        s = {b: float(u[a] @ i[b]) for b in range(90) if (a, b) not in seen}
        want |= {(a, b, n + 1) for n, b in enumerate(sorted(s, key=lambda b: (-s[b], b))[:6])}
    assert found == want


def test_blocked_logsumexp(spark):
    u, i, users, items = _matrices(spark, 20, 33, 4, 1)
    got = dict(blocked_logsumexp(users, items, user_block=7, item_block=10).collect())
    want = np.log(np.exp(u @ i.T).sum(axis=1))
    assert np.allclose([got[n] for n in range(20)], want)


def test_best_of_row_breaks_ties_by_id():
    scores = np.array([1.0, 2.0, 2.0, -np.inf, 2.0])
    assert best_of_row(scores, np.arange(5), 2).tolist() == [1, 2]
    assert best_of_row(scores, np.arange(5), 9).tolist() == [1, 2, 4, 0]


def test_blocked_topk_keeps_matrices_out_of_shuffles_and_cores_busy(spark):
    import re

    users = spark.range(900).selectExpr("id AS user_idx", "array(id % 50 * 1D, 1D, id % 7 * 1D) AS uvec")
    items = spark.range(700).selectExpr("id AS item_idx", "array(id % 90 * 1D, id % 5 * 1D, 2D) AS ivec")
    seen = spark.range(3000).selectExpr("id % 1000 AS user_idx", "id * 13 % 800 AS item_idx")
    for known in (None, seen):
        best = blocked_topk(users, items, 4, seen=known, user_block=512, item_block=128)
        plan = best._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in plan.splitlines() if re.search(r"(?<!Broadcast)Exchange hashpartitioning", line)]
        assert shuffles and not any("umat" in line or "imat" in line for line in shuffles)
        assert re.search(r"Exchange hashpartitioning\(ub#\d+, slice#\d+, (\d+)\), REPARTITION_BY_NUM", plan)
        banned = {(r[0], r[1]) for r in seen.collect()} if known is not None else set()
        want = []
        for u in range(900):
            scored = [(-((u % 50) * (i % 90) + i % 5 + 2 * (u % 7)), i) for i in range(700) if (u, i) not in banned]
            want += [(u, i) for _, i in sorted(scored)[:4]]
        assert sorted((r["user_idx"], r["item_idx"]) for r in best.collect()) == sorted(want)


def test_blocked_topk_beyond_the_broadcast_size(spark):
    users = spark.range(150).selectExpr("id AS user_idx", "array(id * 1D, 1D) AS uvec")
    items = spark.range(90).selectExpr("id AS item_idx", "array(id * 1D, -id * 2D) AS ivec")
    wide = blocked_topk(users, items, 3, user_block=16, item_block=16, broadcast_bytes=0)
    near = blocked_topk(users, items, 3)
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, near.collect()))


def test_shared_head_is_made_where_the_keys_are(spark):
    """No shuffle by rank: it held the same few ranks for all users and shrank to one task."""
    import re

    from revrank.operators import ranking

    items = spark.range(700).selectExpr("id AS item_idx", "CAST(700 - id AS DOUBLE) AS relevance")
    order = global_rank(items, [F.col("relevance").desc(), "item_idx"])
    users = spark.range(3000).selectExpr("id AS user_idx")
    # One user has seen more than the listed first ranks, one everything, and one an item of no order.
    pairs = [(0, i) for i in range(ranking.HEAD_RANKS + 90)] + [(1, i) for i in range(700)] + [(2, 1), (2, 9999)]
    seen = spark.createDataFrame(pairs, "user_idx bigint, item_idx bigint")
    for gone in (None, seen):
        got = head_of_order(users, order, gone, 4)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning\(rank", plan)
        assert "REPARTITION_BY_NUM" in plan
        found = {(r["user_idx"], r["item_idx"], r["rank"]) for r in top_k(got.select("user_idx", "item_idx", "relevance"), 4).collect()}
        known = set(pairs) if gone is not None else set()
        assert found == brute(range(3000), {i: 700.0 - i for i in range(700)}, known, 4)
