"""Top-k by classes: the same rows as over all pairs, from few scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revrank.operators import blocked, classes
from revrank.operators.classes import class_topk
from revrank.plans.trees import _tree, tree_marks, tree_share

ROOTS = [
    (0, 0.5, (2, 1.0, 0.3, (3, 2.0, 0.1, 0.0)), (1, 1.5, (3, 1.0, 0.7, 0.2), 0.4)),
    (2, 2.0, (1, 0.5, 0.0, 0.6), (0, 1.5, 0.25, (3, 3.0, 0.5, 0.125))),
]


def tables(spark, nu, ni):
    rng = np.random.default_rng(5)
    u = rng.integers(0, 4, (nu, 2)).astype(float)
    i = np.column_stack([rng.integers(0, 4, (ni, 2)), rng.integers(0, 6, ni) * 1.1]).astype(float)
    u[4, 0], i[9, 1], i[11, 2] = np.nan, np.nan, np.nan
    seen = {(a, b) for a in range(nu) for b in range(ni) if rng.random() < (0.98 if a == 0 else 0.1)}
    empty = lambda c: F.transform(c, lambda x: F.nanvl(x, F.lit(None).cast("double")))
    users = spark.createDataFrame([(n, r.tolist()) for n, r in enumerate(u)], "user_idx bigint, uvec array<double>")
    items = spark.createDataFrame([(n, r.tolist()) for n, r in enumerate(i)], "item_idx bigint, ivec array<double>")
    known = spark.createDataFrame(sorted(seen), "user_idx bigint, item_idx bigint")
    return u, i, seen, users.withColumn("uvec", empty("uvec")), items.withColumn("ivec", empty("ivec")), known


@pytest.mark.parametrize("shift, power, step", [(0.0, 1.0, 128), (-0.3, 0.8, 4), (-2.0, 1.4, 16)])
def test_class_topk_is_exact(spark, monkeypatch, shift, power, step):
    monkeypatch.setattr(classes, "LEVEL_SEEN", step)
    monkeypatch.setattr(classes, "LEVEL_STEP", 3)
    trees = [_tree(r, 4) for r in ROOTS]
    trees[0].value[:] += shift
    u, i, seen, users, items, known = tables(spark, 40, 150)
    share, k = tree_share(trees, [0, 1], [2, 3], 0.5), 5
    weight = lambda x: x[:, -1] ** power
    for gone in (seen, set()):
        got = class_topk(users, items, k, share, tree_marks(trees, [0, 1]), tree_marks(trees, [2, 3]), weight, known if gone else None)
        scores = share(u, i) * weight(i)[None, :]
        want = []
        for a in range(len(u)):
            open_ = [(-scores[a, b], b) for b in range(len(i)) if (a, b) not in gone and np.isfinite(scores[a, b])]
            want += [(a, b, -s, n) for n, (s, b) in enumerate(sorted(open_)[:k], 1)]
        assert sorted(map(tuple, got.select("user_idx", "item_idx", "relevance", "rank").collect())) == sorted(want)
        assert [t for _, t in got.dtypes] == ["bigint", "bigint", "double", "int"]


def test_users_and_items_that_score_alike_are_scored_once(spark, monkeypatch):
    trees = [_tree(r, 4) for r in ROOTS]
    u, i, _seen, users, items, known = tables(spark, 400, 3000)
    pairs = []
    made = blocked.blocked_topk

    def watched(users, items, *rest, **more):
        pairs.append(users.count() * items.count())
        return made(users, items, *rest, **more)

    monkeypatch.setattr(classes, "blocked_topk", watched)
    few = known.filter("user_idx > 0 and item_idx < 100")
    class_topk(users, items, 3, tree_share(trees, [0, 1], [2, 3], 0.5), tree_marks(trees, [0, 1]), tree_marks(trees, [2, 3]), lambda x: x[:, -1], few).count()
    assert pairs and sum(pairs) < len(u) * len(i) / 100
