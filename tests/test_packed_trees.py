"""Whole forests on packed rows: trees, scores and the search over all settings."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from revrank.operators.packed_trees import (
    BinTree, FlatTree, ForestTable, bin_numbers, cut_points, fits, grow, roc_area,
)
from revrank.plans import trees as plans
from revrank.plans.trees import RandomForestRecommender
from revrank.registry import QUERIES
from tests.conftest import FOLDER


def rows(n, width, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 6, (n, width)).astype(float)
    edges = [cut_points(x[:, c], np.ones(n)) for c in range(width)]
    return x, edges, bin_numbers(x, edges), (rng.random(n) < 0.2 + 0.1 * x[:, 0]).astype(float), rng


def test_rec_random_forest_grows_its_whole_forest(spark, monkeypatch):
    seen = {}

    def predict(self, *args, **kwargs):
        seen.update(trees=self.trees, asked=(self.n_estimators, self.max_depth, self.min_samples_leaf))

    monkeypatch.setattr(RandomForestRecommender, "predict", predict)
    QUERIES["rec_random_forest"](spark, FOLDER)
    assert seen["asked"] == (400, 12, 3) and len(seen["trees"]) == 400

    def depth(node):
        return 0 if isinstance(node, float) else 1 + max(depth(node[2]), depth(node[3]))

    assert max(depth(t.root) for t in seen["trees"][:20]) == 12


def test_first_split_is_the_best_of_all():
    x, edges, codes, y, rng = rows(300, 3)
    w, n = rng.random(300) + 0.5, rng.poisson(1.0, 300)
    tree = grow(codes, w * n, w * n * y, n, lambda nodes: np.arange(3), 1, 20)

    def error(part):
        mean = (w * n * y)[part].sum() / (w * n)[part].sum()
        return (w * n * (y - mean) ** 2)[part].sum()

    errors = {
        (c, b): error(x[:, c] <= e) + error(x[:, c] > e) for c in range(3) for b, e in enumerate(edges[c])
        if min(n[x[:, c] <= e].sum(), n[x[:, c] > e].sum()) >= 20
    }
    best = min(errors, key=errors.get)
    assert (tree.feature[0], tree.split[0]) == best
    low = x[:, best[0]] <= edges[best[0]][best[1]]
    assert tree.value[tree.low[0]] == pytest.approx((w * n * y)[low].sum() / (w * n)[low].sum())


def test_less_depth_is_the_tree_cut_off():
    _, _, codes, y, _ = rows(500, 5)
    packed = codes, y, np.ones(500)
    deep, flat = (plans._forest_tree(packed, 7, 3, depth, 2) for depth in (9, 4))
    for depth, place in enumerate(deep.places(codes, 4)):
        if depth == 4:
            *_, other = flat.places(codes, 4)
            assert np.array_equal(deep.value[place], flat.value[other])


@pytest.mark.parametrize("cells", [1 << 14, 0])
def test_scores_are_those_of_walking_the_trees(monkeypatch, cells):
    """Tables and products; numbers that are missing pass no leaf of a tree that splits on them."""
    monkeypatch.setattr("revrank.operators.packed_trees.CELLS", cells)
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.integers(0, 9, (400, 4)), rng.permutation(400)[:, None] % 3 == np.arange(2)]).astype(float)
    y = (rng.random(400) < 0.1 + 0.1 * (x[:, 0] + x[:, 2] > 8) + 0.3 * x[:, 4]).astype(float)
    edges = [cut_points(x[:, c], np.ones(400)) for c in range(6)]
    packed = bin_numbers(x, edges), y, np.ones(400)
    trees = [FlatTree.of_bins(plans._forest_tree(packed, 1, n, 6, 2), edges) for n in range(9)]
    trees += [FlatTree.of_node(t.root, 6) for t in trees[:2]]
    table = ForestTable(trees, 2, 4)
    assert table.grid == bool(cells)
    u, i = x[:40, :2].copy(), x[40:100, 2:].copy()
    u[3, 1], i[5, 0] = np.nan, np.nan
    got = table.sums(u, i)

    def walk(tree, row):
        if np.isnan(row[sorted(set(tree.feature[tree.feature >= 0]))]).any():
            return 0.0
        node = tree.root
        while not isinstance(node, float):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node

    want = [[sum(walk(t, np.concatenate((a, b))) for t in trees) for b in i] for a in u]
    assert np.allclose(got, want, atol=1e-9)
    # Boxes of the trees give the same.
    t = trees[0]
    reach = (x[:, None] > t.low) & (x[:, None] <= t.high)
    assert np.allclose(reach.all(axis=2) @ t.value, [walk(t, r) for r in x])


def test_cut_points_part_all_values_or_even_shares():
    assert cut_points(np.array([3.0, 1.0, 3.0]), np.ones(3)).tolist() == [2.0]
    many = cut_points(np.arange(1000.0), np.ones(1000))
    counts = np.diff(np.searchsorted(np.arange(1000.0), [0, *many, 1000]))
    assert len(many) == 31 and counts.max() - counts.min() <= 2
    assert not len(cut_points(np.array([5.0, 5.0]), np.ones(2)))


def test_roc_area_counts_equal_scores_half():
    rng = np.random.default_rng(2)
    score, label = rng.integers(0, 5, 80).astype(float), (rng.random(80) < 0.4).astype(float)
    good, bad = score[label == 1][:, None], score[label == 0][None]
    assert roc_area(score, label) == pytest.approx(((good > bad) + 0.5 * (good == bad)).mean())
    assert fits(10, 5, 2) and not fits(1 << 30, 5, 2)
    assert isinstance(grow(np.zeros((1, 1), np.uint8), np.ones(1), np.ones(1), np.ones(1), lambda n: np.array([0]), 3, 1), BinTree)


def test_forest_grid_search_asks_for_the_whole_grid(spark, monkeypatch):
    asked = {}

    def grid_search(self, data):
        asked.update(self.grid, folds=self.folds)
        return None, []

    monkeypatch.setattr(RandomForestRecommender, "grid_search", grid_search)
    QUERIES["forest_grid_search"](spark, FOLDER)
    assert asked == {"max_depth": [6, 12, 30], "min_samples_leaf": [1, 3, 5], "n_estimators": [200, 400], "folds": 3}


def test_settings_that_share_trees_score_as_if_alone(spark):
    x, _, _, y, rng = rows(240, 3)
    data = spark.createDataFrame([(float(b), 1.0, Vectors.dense(a)) for a, b in zip(x, y)], ["label", "weight", "features"])
    whole = {"max_depth": [1, 4], "min_samples_leaf": [1, 9], "n_estimators": [3, 8]}
    search, scores = RandomForestRecommender(grid=whole, folds=2).grid_search(data)
    assert len(scores) == 8 and len({s for _, s in scores}) > 4
    for setting, score in (scores[1], scores[6]):
        grid = {name: [value] for name, value in setting.items()}
        assert RandomForestRecommender(grid=grid, folds=2).grid_search(data)[1] == [(setting, pytest.approx(score))]
    best = max(scores, key=lambda s: s[1])[0]
    assert search.setting == best and len(search.bestModel) == best["n_estimators"]
