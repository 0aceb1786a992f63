"""Top-k that leaves out blocks: the same rows as over all pairs, from few of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revrank.operators import pruned
from revrank.operators.blocked import dot_bound, dot_scores
from revrank.operators.pruned import pruned_topk
from revrank.plans.linear import _itself, _probability, _trig_lift, product_range


def additive(lift):
    score = lambda u, i: lift(_probability(u[:, :1] + i[:, 0][None, :])) * i[:, 1][None, :]

    def bound(ulo, uhi, ilo, ihi):
        return product_range(lift(_probability(ulo[:, :1] + ilo[:, 0])), lift(_probability(uhi[:, :1] + ihi[:, 0])), ilo[:, 1], ihi[:, 1])

    return score, bound


@pytest.mark.parametrize("kind", ["dot", "trig", "revenue"])
def test_pruned_topk_is_exact(spark, kind):
    rng = np.random.default_rng(len(kind))
    nu, ni, k = 90, 260, 5
    if kind == "dot":
        u, i, (score, bound) = rng.normal(size=(nu, 3)), rng.normal(size=(ni, 3)), (dot_scores, dot_bound)
    else:
        u, i = rng.normal(size=(nu, 1)), rng.normal(size=(ni, 2)).round(1)
        score, bound = additive(_trig_lift if kind == "trig" else _itself)
    # Equal vectors, a missing number, a user who saw nearly all.
    i[100:140] = i[100]
    i[7, -1] = np.nan
    u[3] = u[4]
    seen = {(a, b) for a in range(nu) for b in range(ni) if rng.random() < (0.99 if a == 0 else 0.1)}
    users = spark.createDataFrame([(n, r.tolist()) for n, r in enumerate(u)], "user_idx bigint, uvec array<double>")
    items = spark.createDataFrame([(n, r.tolist()) for n, r in enumerate(i)], "item_idx bigint, ivec array<double>")
    items = items.withColumn("ivec", F.transform("ivec", lambda x: F.nanvl(x, F.lit(None).cast("double"))))
    known = spark.createDataFrame(list(seen), "user_idx bigint, item_idx bigint")
    with np.errstate(all="ignore"):
        scores = np.asarray(score(u, i))
    for gone in (None, known):
        got = pruned_topk(users, items, k, score, bound, gone, user_block=16, item_block=16).collect()
        found = {(r["user_idx"], r["item_idx"], r["rank"]) for r in got}
        want = set()
        for a in range(nu):
            open_ = [b for b in range(ni) if np.isfinite(scores[a, b]) and (gone is None or (a, b) not in seen)]
            want |= {(a, b, n + 1) for n, b in enumerate(sorted(open_, key=lambda b: (-scores[a, b], b))[:k])}
        assert found == want


def test_pruned_topk_multiplies_few_pairs(spark):
    """All pairs would be 12 million products; the accumulator counts what the scorer was asked for."""
    asked = spark.sparkContext.accumulator(0)

    def counted(u, i):
        asked.add(len(u) * len(i))
        return dot_scores(u, i)

    circle = lambda n, name, vec: spark.range(n).selectExpr(f"id AS {name}", f"array(sin(id), cos(id), sin(2 * id)) AS {vec}")
    users, items = circle(2000, "user_idx", "uvec"), circle(6000, "item_idx", "ivec")
    best = pruned_topk(users, items, 3, counted, dot_bound, user_block=64, item_block=32)
    assert best.count() == 6000
    assert 0 < asked.value < 12_000_000 // 4
