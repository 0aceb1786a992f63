"""Tree models over user and item features: a forest and a boosted ranker.

No feature mixes a user and an item, so a leaf is reached by a pair exactly when the
user passes the leaf's user conditions and the item its item conditions. A tree's score
for a block of users and items is then a small matrix product of two 0/1 tables,
and all pairs are scored exactly; no candidate is left out. Users (items) that pass the same
conditions are one class, and classes are scored, not their members (``class_topk``).
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from revrank.functions.hashing import keep_share, with_row_id
from revrank.functions.scores import price_power
from revrank.operators import features
from revrank.operators.aggregates import distinct_counts, item_stats, user_stats
from revrank.operators.classes import class_topk
from revrank.operators.joins import enrich_interactions
from revrank.operators.lambdas import ideal_dcg, lambda_gradients, list_gradients, newton_leaves
from revrank.operators.packed_trees import (
    UNIT_BITS, BinTree, Boosting, FlatTree, ForestTable, PackedLists, bin_edges, boost, fits, grow, packed_rows, roc_area,
)
from revrank.operators.positions import split_hot
from revrank.operators.ranking import top_k
from revrank.plans.base import Recommender, with_features
from revrank.session import cores, cut, cut_wide, write_table

_LINE = re.compile(
    r"^ *(?:(?:If|Else) \(feature (?P<feature>\d+) (?:<=|>) (?P<threshold>[-\d.eE]+)\)|Predict: (?P<value>[-\d.eE]+))"
)

# A node is (feature, threshold, node if <=, node if >), a leaf its value.
Node = tuple | float


@dataclass(frozen=True)
class Tree:
    """A fitted tree, also as boxes: leaf n holds low[n] < x <= high[n] and gives value[n]."""

    root: Node
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray

    def passes(self, x: np.ndarray, columns: list[int]) -> np.ndarray:
        """Table (rows, leaves): does the row pass the leaf's conditions on ``columns``?"""
        out = np.ones((len(x), len(self.value)), dtype=bool)
        for n, c in enumerate(columns):
            if np.isfinite(self.low[:, c]).any() or np.isfinite(self.high[:, c]).any():
                v = x[:, n : n + 1]
                out &= (v > self.low[:, c]) & (v <= self.high[:, c])
        return out

    def reach(self, x: np.ndarray, columns: list[int]) -> np.ndarray:
        """``passes`` as 0 and 1."""
        return self.passes(x, columns).astype(np.float64)

    def column(self, names: list[str | Column]) -> Column:
        """The tree as one expression over feature columns."""

        def build(node: Node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, threshold, low, high = node
            value = names[feature]
            value = F.col(value) if isinstance(value, str) else value
            return F.when(value <= F.lit(threshold), build(low)).otherwise(build(high))

        return build(self.root)


def trees_of(model, n_features: int) -> list[Tree]:
    """The trees of a fitted model, read from its public description."""
    return [_tree(root, n_features) for root in _roots(model)]


def _renumbered(node: Node, place: dict[int, int]) -> Node:
    """The same node with feature n called place[n]."""
    if isinstance(node, float):
        return node
    return place[node[0]], node[1], _renumbered(node[2], place), _renumbered(node[3], place)


def _with_leaves(node: Node, values: Iterator[float]) -> Node:
    """The same node with its leaves replaced, in the order of ``Tree.value``."""
    if isinstance(node, float):
        return float(next(values))
    low = _with_leaves(node[2], values)
    return node[0], node[1], low, _with_leaves(node[3], values)


def _roots(model) -> list[Node]:
    blocks: list[list[re.Match]] = [[]]
    for line in model.toDebugString.splitlines():
        found = _LINE.match(line)
        if found:
            blocks[-1].append(found)
        elif re.match(r"^ *Tree \d+", line):
            blocks.append([])
        elif " (feature " in line or "Predict:" in line:
            raise ValueError(f"a tree holds a line of unknown form: {line.strip()}")
    return [_node(iter(lines)) for lines in blocks if lines]


def _node(lines: Iterator[re.Match]) -> Node:
    line = next(lines)
    if line["value"] is not None:
        return float(line["value"])
    low = _node(lines)
    next(lines)  # the matching "Else"
    return int(line["feature"]), float(line["threshold"]), low, _node(lines)


def _tree(root: Node, n_features: int) -> Tree:
    boxes: list[tuple[np.ndarray, np.ndarray, float]] = []

    def walk(node: Node, low: np.ndarray, high: np.ndarray) -> None:
        if isinstance(node, float):
            boxes.append((low, high, node))
            return
        feature, threshold, left, right = node
        below, above = high.copy(), low.copy()
        below[feature] = min(below[feature], threshold)
        above[feature] = max(above[feature], threshold)
        walk(left, low, below)
        walk(right, above, high)

    walk(root, np.full(n_features, -np.inf), np.full(n_features, np.inf))
    lows, highs, values = zip(*boxes)
    return Tree(root, np.array(lows), np.array(highs), np.array(values))


def tree_share(trees: list[Tree], user_cols: list[int], item_cols: list[int], scale: float):
    """scale * (sum of the trees) of all pairs; the item's last number is left out."""

    def share(u: np.ndarray, i: np.ndarray) -> np.ndarray:
        total = np.zeros((len(u), len(i)))
        for t in trees:
            total += (t.reach(u, user_cols) * t.value) @ t.reach(i[:, :-1], item_cols).T
        return total * scale

    return share


def tree_marks(trees: list[Tree], columns: list[int]):
    """Leaves of all trees whose conditions on ``columns`` a row passes."""

    def marks(x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros((len(x), 0), bool), *[t.passes(x[:, : len(columns)], columns) for t in trees]], axis=1)

    return marks


def _forest_tree(packed, seed: int, number: int, depth: int, least: int, out: np.ndarray | None = None) -> BinTree:
    """Tree ``number`` on a Poisson draw of the rows, without those marked ``out``."""
    codes, label, weight = packed
    rng = np.random.default_rng([seed, number])
    times = rng.poisson(1.0, len(label))
    if out is not None:
        times[out] = 0
    width = codes.shape[1]
    size = int(np.ceil(np.sqrt(width)))

    def draw(nodes: int) -> np.ndarray:
        return rng.random((nodes, width)).argpartition(size - 1, axis=1)[:, :size]

    w = weight * times
    return grow(codes, w, w * label, times, draw, min(depth, 30), least, binary=True)


class _TreeModel(Recommender):
    user_cols: list[str]
    item_cols: list[str]

    def _score_all(self, k, users, items, seen, trees, scale, power) -> DataFrame:
        """``users`` and ``items`` carry the feature columns; items also ``price``."""
        nu = len(self.user_cols)
        number = lambda c: F.col(c).cast("double")
        asked = users.select("user_idx", F.array(*[number(c) for c in self.user_cols]).alias("uvec"))
        offered = items.select(
            "item_idx", F.array(*[number(c) for c in self.item_cols], number("price")).alias("ivec")
        )
        on_user, on_item = list(range(nu)), list(range(nu, nu + len(self.item_cols)))
        return class_topk(
            asked, offered, k, tree_share(trees, on_user, on_item, scale), tree_marks(trees, on_user), tree_marks(trees, on_item),
            lambda i: i[:, -1] ** power, seen,
        )


@dataclass(frozen=True)
class SearchedForest:
    """Trees refitted on all rows under the best setting of a search."""

    bestModel: list[FlatTree]
    setting: dict[str, int]


class RandomForestRecommender(_TreeModel):
    """Balanced forest on user and item attributes; ranks by P(convert) * price.

    Trees are grown on the 0/1 label as regression trees: the mean of a leaf is its share of
    positives and the variance of a 0/1 label is half its Gini impurity, so splits and
    probabilities are those of a classification forest. Scaling is left out, it cannot move
    a split.
    """

    def __init__(self, n_estimators: int = 400, max_depth: int = 12, min_samples_leaf: int = 3,
                 tune_hyper: bool = False, grid: dict | None = None, folds: int = 3, seed: int = 42):
        super().__init__(seed)
        self.n_estimators, self.max_depth, self.min_samples_leaf = n_estimators, max_depth, min_samples_leaf
        self.tune_hyper, self.folds = tune_hyper, folds
        # MLlib trees stop at depth 30, which stands for "no limit".
        self.grid = grid or {"max_depth": [6, 12, 30], "min_samples_leaf": [1, 3, 5], "n_estimators": [200, 400]}

    TEXT = {"user_idx": "segment", "item_idx": "category"}

    def _sides(self, users: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Both tables with a 0/1 column for each level the trees split on."""
        out = []
        for side, key in ((users, "user_idx"), (items, "item_idx")):
            hot = {name: F.col(self.TEXT[key]) == F.lit(value) for name, value in self.levels[key].items()}
            out.append(side.withColumns({n: F.coalesce(c.cast("int"), F.lit(0)) for n, c in hot.items()}))
        return out[0], out[1]

    def training_rows(self, log, users, items) -> DataFrame:
        """(label, weight, features) of the balanced sample, written; any number of levels."""
        time = ["timestamp"] if "timestamp" in log.columns else []
        rows = log.select("user_idx", "item_idx", *time, (F.col("relevance") > 0).cast("int").alias("label"))
        kept = cut(features.undersample_negatives(cut(rows), "label", ["user_idx", "item_idx", *time], self.seed))
        # The weights are written so that they are known to be two rows: a join by label shuffles all rows to two tasks.
        made = kept.join(cut(features.class_weights(kept)), "label")
        # Features are packed on the two small tables; a log row only picks up two short lists.
        columns, self.level_tables, size = [], {}, 0
        for side, key, numbers in (
            (users, "user_idx", [c for c in users.columns if c.startswith("user_attr_")]),
            (items, "item_idx", [c for c in items.columns if c.startswith("item_attr_")] + ["price"]),
        ):
            text = self.TEXT[key]
            levels = self.level_tables[key] = cut(features.level_table(side, [text]))
            parts = features.sparse_parts(side, key, [F.col(c) for c in numbers], [text], levels, size, f"__{key}")
            made = made.join(cut(parts), key)
            columns.append(numbers + [f"{text}_level_{n}" for n in range(levels.count())])
            size += len(columns[-1])
        self.user_cols, self.item_cols = columns
        made = made.select(F.col("label").cast("double").alias("label"), "weight", "__user_idx", "__item_idx")
        return features.written_vectors(made, ["__user_idx", "__item_idx"], size)

    def _keep(self, model) -> None:
        """The model's trees, and the columns and level values they split on (no more than splits)."""
        names = self.user_cols + self.item_cols
        trees = model if isinstance(model, list) else [FlatTree.of_node(root, len(names)) for root in _roots(model)]
        kept = sorted({0}.union(*[t.feature[t.feature >= 0].tolist() for t in trees]))
        place = {feature: n for n, feature in enumerate(kept)}
        self.trees = [t.renumbered(place) for t in trees]
        wanted = {names[n] for n in kept}
        self.levels = {}
        for key, text in self.TEXT.items():
            table = self.level_tables[key].withColumn("name", F.concat(F.lit(f"{text}_level_"), F.col("level")))
            asked = sorted(n for n in wanted if n.startswith(f"{text}_level_"))
            rows = table.filter(F.col("name").isin(asked)).collect() if asked else []
            self.levels[key] = {r["name"]: r["value"] for r in rows}
        self.user_cols = [c for c in self.user_cols if c in wanted]
        self.item_cols = [c for c in self.item_cols if c in wanted]

    def _forest(self) -> RandomForestRegressor:
        return RandomForestRegressor(
            featuresCol="features", labelCol="label", weightCol="weight", numTrees=self.n_estimators,
            maxDepth=self.max_depth, minInstancesPerNode=self.min_samples_leaf, featureSubsetStrategy="sqrt",
            maxMemoryInMB=512, seed=self.seed,
        )

    def _packed(self, data: DataFrame):
        """Broadcast (bin numbers, label, weight) of small ``data``, rows in an order of their own, and the thresholds; else None."""
        first = data.select("features").first()
        width = first["features"].size if first else 0
        if not first or not fits(data.count(), width, 2):
            return None
        rows = data.select("label", "weight", vector_to_array("features").alias("x"))
        edges = bin_edges(rows, "x", width)
        codes, other = packed_rows(rows, "x", edges, ["label", "weight"])
        order = np.lexsort((other["weight"], other["label"], *codes.T))
        packed = codes[order], other["label"][order], other["weight"][order]
        return data.sparkSession.sparkContext.broadcast(packed), edges

    def _fit_packed(self, spark, shared, edges) -> list[FlatTree]:
        """All trees, grown a share a task."""
        tasks = min(self.n_estimators, 4 * cores(spark))
        seed, n, depth, least = self.seed, self.n_estimators, self.max_depth, self.min_samples_leaf
        kinds = {"feature": np.int32, "split": np.uint8, "low": np.int32, "value": np.float64}

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for task in batch["id"]:
                    for number in range(task, n, tasks):
                        tree = _forest_tree(shared.value, seed, number, depth, least)
                        yield pd.DataFrame({"number": [number], **{c: [getattr(tree, c).tobytes()] for c in kinds}})

        found = spark.range(0, tasks, 1, tasks).mapInPandas(run, "number int, feature binary, split binary, low binary, value binary").collect()
        trees = [BinTree(*[np.frombuffer(r[c], kind) for c, kind in kinds.items()]) for r in sorted(found, key=lambda r: r["number"])]
        return [FlatTree.of_bins(t, edges) for t in trees]

    def _fitted(self, data: DataFrame):
        """A list of trees, or MLlib's model where ``data`` is too large for one task."""
        packed = self._packed(data)
        return self._forest().fit(data) if packed is None else self._fit_packed(data.sparkSession, *packed)

    def grid_search(self, data: DataFrame):
        """Cross-validated ROC-AUC over the grid; (fitted search, one row of settings per score)."""
        packed = self._packed(data)
        if packed is not None:
            return self._search_packed(data.sparkSession, *packed)
        forest = self._forest()
        names = {"max_depth": forest.maxDepth, "min_samples_leaf": forest.minInstancesPerNode,
                 "n_estimators": forest.numTrees}
        builder = ParamGridBuilder()
        for name, values in self.grid.items():
            builder = builder.addGrid(names[name], values)
        search = CrossValidator(
            estimator=forest, estimatorParamMaps=builder.build(), numFolds=self.folds, seed=self.seed,
            evaluator=BinaryClassificationEvaluator(rawPredictionCol="prediction", labelCol="label"),
        ).fit(data)
        settings = [
            ({n: int(m[p]) for n, p in names.items() if p in m}, float(s))
            for m, s in zip(search.getEstimatorParamMaps(), search.avgMetrics)
        ]
        return search, settings

    def _search_packed(self, spark, shared, edges):
        """The search over packed rows.

        A forest of less depth is the deeper one cut off, one of fewer trees its first trees (draws of a tree depend on
        its number, those of a node on the levels above), so settings with equal leaf sizes share their trees.
        """
        own = {"max_depth": self.max_depth, "min_samples_leaf": self.min_samples_leaf, "n_estimators": self.n_estimators}
        values = {name: sorted({min(v, 30) if name == "max_depth" else v for v in self.grid.get(name, [own[name]])}) for name in own}
        depths, leasts, counts = values["max_depth"], values["min_samples_leaf"], values["n_estimators"]
        share = max(1, -(-counts[-1] * len(leasts) * self.folds // (4 * cores(spark))))
        # A task's trees lie between two of the counts, so its sums serve all larger ones.
        parts = [
            (n, at, min(at + share, end))
            for n, (begin, end) in enumerate(zip([0, *counts], counts)) for at in range(begin, end, share)
        ]
        tasks = [(least, fold, *part) for part in parts for least in leasts for fold in range(self.folds)]
        folds, seed = self.folds, self.seed

        def fold_of(n: int) -> np.ndarray:
            return np.random.default_rng([seed, 1 << 32]).permutation(n) % folds

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for least, fold, part, begin, end in (tasks[n] for n in batch["id"]):
                    codes = shared.value[0]
                    out = fold_of(len(codes)) == fold
                    held = codes[out]
                    sums = {depth: np.zeros(len(held)) for depth in depths}
                    for number in range(begin, end):
                        tree = _forest_tree(shared.value, seed, number, depths[-1], least, out)
                        whole = np.rint(tree.value * 2.0**UNIT_BITS)
                        for depth, place in enumerate(tree.places(held, depths[-1])):
                            if depth in sums:
                                sums[depth] += whole[place]
                    for depth, total in sums.items():
                        yield pd.DataFrame({"least": [least], "fold": [fold], "depth": [depth], "part": [part], "sums": [total.tobytes()]})

        def area(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            label = shared.value[1]
            label = label[fold_of(len(label)) == key[1]]
            total, areas = np.zeros(len(label)), []
            for part in range(len(counts)):
                for some in rows["sums"][rows["part"] == part]:
                    total = total + np.frombuffer(some, np.float64)
                areas.append(roc_area(total, label))
            return pd.DataFrame({"least": key[0], "fold": key[1], "depth": key[2], "trees": counts, "area": areas})

        sums = spark.range(0, len(tasks), 1, len(tasks)).mapInPandas(run, "least int, fold int, depth int, part int, sums binary")
        areas = sums.groupBy("least", "fold", "depth").applyInPandas(area, "least int, fold int, depth int, trees int, area double")
        found: dict[tuple, list[float]] = {}
        for r in areas.orderBy("fold").collect():
            found.setdefault((r["depth"], r["least"], r["trees"]), []).append(r["area"])
        settings = []
        for chosen in itertools.product(*self.grid.values()):
            setting = dict(zip(self.grid, chosen))
            full = {**own, **setting}
            of = found[min(full["max_depth"], 30), full["min_samples_leaf"], full["n_estimators"]]
            settings.append((setting, float(np.mean(of))))
        best = max(settings, key=lambda s: s[1])[0]
        final = RandomForestRecommender(**{**own, **best}, seed=self.seed)
        return SearchedForest(final._fit_packed(spark, shared, edges), best), settings

    def fit(self, log, user_features=None, item_features=None):
        data = self.training_rows(log, user_features, item_features)
        if self.tune_hyper:
            search, _ = self.grid_search(data)
            model = search.bestModel
        else:
            model = self._fitted(data)
        self._keep(model)
        return self

    def _score_all(self, k, users, items, seen, trees, scale, power) -> DataFrame:
        """As ``_TreeModel._score_all``, with scores from tables of all leaves; rows between the same thresholds are one class."""
        number = lambda c: F.col(c).cast("double")
        asked = users.select("user_idx", F.array(*[number(c) for c in self.user_cols]).alias("uvec"))
        offered = items.select("item_idx", F.array(*[number(c) for c in self.item_cols], number("price")).alias("ivec"))
        nu, ni = len(self.user_cols), len(self.item_cols)
        table = users.sparkSession.sparkContext.broadcast(ForestTable(trees, nu, ni))
        return class_topk(
            asked, offered, k, lambda u, i: table.value.sums(u, i[:, :ni]) * scale, lambda x: table.value.marks(x, 0),
            lambda x: table.value.marks(x[:, :ni], nu), lambda i: i[:, -1] ** power, seen,
        )

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        users, items = self._sides(
            with_features(users, user_features, "user_idx"), with_features(items, item_features, "item_idx")
        )
        seen = self._seen(log, filter_seen_items)
        return self._score_all(k, users, items, seen, self.trees, 1.0 / len(self.trees), 1.0)


class LambdaRankRecommender(_TreeModel):
    """Boosted trees on pairwise ranking gradients; ranks by score * price^alpha.

    Each round turns the current scores into lambdas and curvatures, draws
    ``bagging_fraction`` of the rows and ``feature_fraction`` of the features, and fits one
    regression tree to lambda / curvature, weighted by curvature and price^price_pow. The
    tree gives the splits; its leaves then get the Newton step with an L2 penalty, from sums
    over the drawn rows (``newton_leaves``). Early stopping watches NDCG@10 on held-out users.

    The rows of a user are packed into one row once, so a round works out its gradients where the rows
    are: no join and no shuffle. Users with more than ``GROUP_ROWS`` rows stay rows and take the joins.
    """

    ROUNDS_PER_CUT = 20
    GROUP_ROWS = 1000

    def __init__(self, price_pow: float | None = None, edr_alpha: float | None = None, num_boost_round: int = 2500,
                 early_stopping_rounds: int = 200, learning_rate: float = 0.05, max_depth: int = 5,
                 min_data_in_leaf: int = 15, label_leak: bool = True, holdout: float = 0.1, seed: int = 42,
                 feature_fraction: float = 0.8, bagging_fraction: float = 0.8, lambda_l2: float = 5.0):
        super().__init__(seed)
        self.feature_fraction, self.bagging_fraction, self.lambda_l2 = feature_fraction, bagging_fraction, lambda_l2
        self.price_pow = 1.4 if price_pow is None else price_pow
        self.edr_alpha = 0.8 if edr_alpha is None else edr_alpha
        self.num_boost_round, self.early_stopping_rounds = num_boost_round, early_stopping_rounds
        self.learning_rate, self.max_depth, self.min_data_in_leaf = learning_rate, max_depth, min_data_in_leaf
        self.label_leak, self.holdout = label_leak, holdout

    def _learn_sides(self, log, users, items):
        """Statistics, encodings and levels; user table and item table with all features."""
        label = (F.col("relevance") > 0).cast("int")
        joined = enrich_interactions(log.select("user_idx", "item_idx", "relevance"), users, items)
        joined = cut(joined)
        text = [c for c, t in joined.dtypes if t == "string"]
        self.user_stats = cut(user_stats(joined))
        self.item_stats = cut(item_stats(joined))
        # Users and items of the joined rows; their text is looked at here, not row by row.
        sides = (users.join(self.user_stats, "user_idx", "left_semi"), items.join(self.item_stats, "item_idx", "left_semi"))
        home = {c: side for side in sides for c in text if c in side.columns}
        wide_text = set()
        for side in sides:
            counted = distinct_counts(side, [c for c in text if home[c] is side])
            wide_text |= {r["column"] for r in counted.filter(F.col("distinct") >= 30).collect()}
        self.global_mean = joined.agg(F.avg(label)).first()[0]
        self.encodings = {c: cut(features.target_encoding(joined, c, label)) for c in text if c in wide_text}
        # Fewer than 30 values each; a value without log rows could not move a split.
        self.levels = {c: features.levels_of(home[c], [c])[c] for c in text if c not in wide_text}
        return joined

    def _user_side(self, users: DataFrame) -> DataFrame:
        return self._side(users).join(self.user_stats, "user_idx", "left").fillna(
            0, subset=["user_price_mean", "user_ctr"]
        )

    def _item_side(self, items: DataFrame) -> DataFrame:
        priced = self._side(items).withColumns(
            {"price_log": F.log1p("price"), "price_sqrt": F.sqrt("price")}
        )
        return priced.join(self.item_stats, "item_idx", "left").fillna(0, subset=["item_buy_rate", "item_log_views"])

    def _side(self, df: DataFrame) -> DataFrame:
        out = features.one_hot(df, {c: v for c, v in self.levels.items() if c in df.columns})
        for c, encoding in self.encodings.items():
            if c in out.columns:
                # A value never seen in training gets the prior.
                out = features.apply_encoding(out, encoding, c, self.global_mean).drop(c)
        return out

    def training_rows(self, log, users, items) -> DataFrame:
        """(row_id, user_idx, label, features as plain columns)."""
        return self._flat(*self._training_groups(log, users, items))

    def _training_groups(self, log, users, items) -> tuple[DataFrame, DataFrame | None]:
        """``_groups`` of the log with all features."""
        self._learn_sides(log, users, items)
        one, two = cut(self._user_side(users)), cut(self._item_side(items))
        skip = ("user_idx", "item_idx", "__iter")
        self.user_cols = [c for c in one.columns if c not in skip]
        self.item_cols = [c for c in two.columns if c not in skip]
        rows = log.select("user_idx", "item_idx", (F.col("relevance") > 0).cast("int").alias("label"))
        # Features are packed on the two small tables; the id breaks ties of scores, so it must not depend on the order of rows.
        one, two = (
            cut(side.select(key, F.array(*[F.col(c).cast("double") for c in columns]).alias(name)))
            for side, key, columns, name in ((one, "user_idx", self.user_cols, "__u"), (two, "item_idx", self.item_cols, "__i"))
        )
        wide = cut(with_row_id(rows)).join(one, "user_idx").join(two, "item_idx")
        return self._groups(wide.select("row_id", "user_idx", "label", F.concat("__u", "__i").alias("x")))

    def _groups(self, wide: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Written (user_idx, ids, labels, x), one row a user, and the rows of users that are too large for that (or None).

        ``wide`` has row_id, user_idx, label and ``x``, the features as one array.
        """
        plain, large = split_hot(wide, ["user_idx"], self.GROUP_ROWS)
        listed = plain.repartition("user_idx").groupBy("user_idx").agg(F.sort_array(F.collect_list(F.struct("row_id", "label", "x"))).alias("r"))
        users = cut(listed.select("user_idx", F.col("r.row_id").alias("ids"), F.col("r.label").alias("labels"), F.col("r.x").alias("x")))
        return users, None if large is None else cut_wide(large)

    def _flat(self, users: DataFrame, large: DataFrame | None) -> DataFrame:
        """The rows of ``_groups`` with features as plain columns."""
        rows = users.select("user_idx", F.inline(F.arrays_zip("ids", "labels", "x")))
        rows = rows.withColumnsRenamed({"ids": "row_id", "labels": "label"})
        if large is not None:
            rows = rows.unionByName(large)
        names = self.user_cols + self.item_cols
        return rows.select("row_id", "user_idx", "label", *[F.col("x")[n].alias(c) for n, c in enumerate(names)])

    def _packed(self, rows: DataFrame) -> DataFrame:
        """Rows with plain feature columns, these as one array ``x``."""
        names = self.user_cols + self.item_cols
        kept = [c for c in rows.columns if c not in names]
        return rows.select(*kept, F.array(*[F.col(c).cast("double") for c in names]).alias("x"))

    def _round(self, users: DataFrame, large: DataFrame | None, pending: list[Tree], learning_rate: float, done: int) -> DataFrame:
        """Rows (x, lambda, hessian, price) drawn for a round, at the stored scores ``base`` (none yet: 0) and the trees since."""
        names = self.user_cols + self.item_cols

        def score(base: Column, x: Column) -> Column:
            return _sum_trees(base, pending, [x[n] for n in range(len(names))], learning_rate)

        base = F.col("base") if "base" in users.columns else F.array_repeat(F.lit(0.0), F.size("labels"))
        scores = F.zip_with(base, "x", score) if pending else base
        told = users.withColumn("g", list_gradients(F.col("labels"), scores))
        rows = told.select(F.inline(F.arrays_zip("ids", "x", "g"))).select(F.col("ids").alias("row_id"), "x", "g.lambda", "g.hessian")
        if large is not None:
            start = F.col("base") if "base" in large.columns else F.lit(0.0)
            scored = cut(large.select("row_id", "user_idx", "label", score(start, F.col("x")).alias("score")))
            lambdas = lambda_gradients(scored, "row_id").select("row_id", "lambda", "hessian")
            rows = rows.unionByName(large.select("row_id", "x").join(lambdas, "row_id").select(*rows.columns))
        drawn = rows.filter((F.col("hessian") > 1e-12) & keep_share(self.bagging_fraction, "row_id", F.lit(self.seed), F.lit(done)))
        return drawn.select("x", "lambda", "hessian", F.col("x")[names.index("price")].alias("price"))

    def _fold(self, users: DataFrame, large: DataFrame | None, pending: list[Tree], learning_rate: float) -> tuple[DataFrame, DataFrame | None]:
        """Both tables with the trees so far added to a stored score, so the expression stays short."""
        n = len(self.user_cols + self.item_cols)

        def score(base: Column, x: Column) -> Column:
            return _sum_trees(base, pending, [x[c] for c in range(n)], learning_rate)

        base = F.col("base") if "base" in users.columns else F.array_repeat(F.lit(0.0), F.size("labels"))
        users = cut(users.withColumn("base", F.zip_with(base, "x", score)))
        if large is not None:
            start = F.col("base") if "base" in large.columns else F.lit(0.0)
            large = cut_wide(large.withColumn("base", score(start, F.col("x"))))
        return users, large

    def _boost(
        self, rows: DataFrame, price_pow: float, learning_rate: float,
        groups: tuple[DataFrame, DataFrame | None] | None = None, first: str | None = None,
    ) -> list[Tree]:
        """Trees of ``rows``. ``groups`` are the same rows packed; ``first`` is the first round's table (``_first``)."""
        names = self.user_cols + self.item_cols
        held = keep_share(self.holdout, "user_idx", F.lit(self.seed))
        users, large = self._train_groups(groups or self._groups(self._packed(rows)))
        stops = self.early_stopping_rounds < self.num_boost_round
        checked = cut(rows.filter(held).withColumn("__base", F.lit(0.0))) if stops else None
        trees: list[Tree] = []
        pending: list[Tree] = []
        best, best_at = -1.0, 0
        for done in range(1, self.num_boost_round + 1):
            drawn = self._draw_features(len(names), done)
            path = first if done == 1 and first else self._write_round(self._round(users, large, pending, learning_rate, done), drawn)
            tree = self._grow_written(path, rows.sparkSession, price_pow, len(names), drawn)
            if tree is None:
                break
            trees.append(tree)
            pending.append(tree)
            if len(pending) >= self.ROUNDS_PER_CUT:
                users, large = self._fold(users, large, pending, learning_rate)
                if stops:
                    checked = cut_wide(checked.withColumn("__base", _sum_trees(F.col("__base"), pending, names, learning_rate)))
                pending = []
            if stops:
                # Every round can be the best one; only the stop waits.
                now = self.ndcg(checked, pending, names, learning_rate)
                if now > best:
                    best, best_at = now, len(trees)
                elif len(trees) - best_at >= self.early_stopping_rounds:
                    break
        return trees[:best_at] if best_at else trees

    def _train_groups(self, groups: tuple[DataFrame, DataFrame | None]) -> tuple[DataFrame, DataFrame | None]:
        """Users who are not held out."""
        held = keep_share(self.holdout, "user_idx", F.lit(self.seed))
        users, large = groups
        return users.filter(~held), None if large is None else large.filter(~held)

    def _first(self, groups: tuple[DataFrame, DataFrame | None]) -> str:
        """The first round's table: all scores are 0 there, whatever the settings."""
        drawn = self._draw_features(len(self.user_cols + self.item_cols), 1)
        return self._write_round(self._round(*self._train_groups(groups), [], 0.0, 1), drawn)

    def _draw_features(self, n: int, round_: int) -> list[int]:
        """Numbers of the features a round may split on: a share of them, one at least."""
        size = min(n, max(1, round(self.feature_fraction * n)))
        return sorted(int(c) for c in np.random.default_rng([self.seed, round_]).choice(n, size, replace=False))

    def _grow(self, data: DataFrame, names: list[str], drawn: list[int]) -> Tree | None:
        """One tree over the drawn features of ``data`` (features, lambda, hessian, w); None without rows."""
        rows = data.select(F.array(*[F.col(c).cast("double") for c in names]).alias("x"), "lambda", "hessian", F.col("w").alias("price"))
        return self._grow_written(self._write_round(rows, drawn), data.sparkSession, 1.0, len(names), drawn)

    def _write_round(self, rows: DataFrame, drawn: list[int]) -> str:
        """Folder of ``rows`` (x, lambda, hessian, price) with the drawn features as the fields of a vector."""
        def known(v: Column) -> Column:
            return F.when(v.isNull() | F.isnan(v), F.raise_error(F.lit("a feature is null or not a number"))).otherwise(v)

        none = F.lit(None)
        vector = F.struct(
            F.lit(1).cast("tinyint").alias("type"), none.cast("int").alias("size"), none.cast("array<int>").alias("indices"),
            F.array(*[known(F.col("x")[c]) for c in drawn]).alias("values"),
        )
        return write_table(rows.select(vector.alias("features"), "lambda", "hessian", "price"))

    def _grow_written(self, path: str, spark, price_pow: float, n: int, drawn: list[int]) -> Tree | None:
        """One tree over a table of ``_write_round``, weighted by curvature and price^price_pow; None without rows."""
        vector = VectorUDT.sqlType().simpleString()
        plain = spark.read.schema(f"features {vector}, lambda double, hessian double, price double").parquet(path)
        if plain.isEmpty():
            return None
        read_as = StructType([StructField(f.name, VectorUDT()) if f.name == "features" else f for f in plain.schema])
        weight = price_power("price", price_pow)
        packed = spark.read.schema(read_as).parquet(path).select(
            "features", (F.col("lambda") / F.col("hessian")).alias("step"), (F.col("hessian") * weight).alias("__w")
        )
        model = DecisionTreeRegressor(
            featuresCol="features", labelCol="step", weightCol="__w", maxDepth=self.max_depth,
            minInstancesPerNode=self.min_data_in_leaf, seed=self.seed,
        ).fit(packed)
        roots = _roots(model)
        if not roots:
            return None
        # At most 2^max_depth leaves come to the driver.
        small = _tree(roots[0], len(drawn))
        numbered = _tree(_with_leaves(small.root, iter(range(len(small.value)))), len(drawn))
        places = [F.col("features.values")[p] for p in range(len(drawn))]
        rows = plain.select(numbered.column(places).cast("int").alias("leaf"), "lambda", "hessian", weight.alias("w"))
        found = {r["leaf"]: r["value"] for r in newton_leaves(rows, "leaf", self.lambda_l2).collect()}
        values = [found.get(c, 0.0) for c in range(len(small.value))]
        return _tree(_renumbered(_with_leaves(small.root, iter(values)), dict(enumerate(drawn))), n)

    def _stored_scores(self, rows: DataFrame, trees: list[Tree], names: list[str], learning_rate: float) -> DataFrame:
        """``rows`` with the sum of all trees as ``__base``, a few trees an expression."""
        out = rows.withColumn("__base", F.lit(0.0))
        for at in range(0, len(trees), self.ROUNDS_PER_CUT):
            some = trees[at : at + self.ROUNDS_PER_CUT]
            out = cut(out) if at else out
            out = out.withColumn("__base", _sum_trees(F.col("__base"), some, names, learning_rate))
        return out

    def ndcg(self, rows: DataFrame, pending: list[Tree], names: list[str], learning_rate: float, k: int = 10) -> float:
        """NDCG of the stored score ``__base`` (none yet: 0) plus the trees since it was stored."""
        start = F.col("__base") if "__base" in rows.columns else F.lit(0.0)
        scored = rows.select("row_id", "user_idx", "label", _sum_trees(start, pending, names, learning_rate).alias("score"))
        best = top_k(scored, k, score="score", tie="row_id")
        got = best.groupBy("user_idx").agg(F.sum(F.col("label") / F.log2(F.col("rank") + 1.0)).alias("dcg"))
        both = got.join(ideal_dcg(scored, k).filter(F.col("ideal") > 0), "user_idx")
        return both.agg(F.avg(F.col("dcg") / F.col("ideal"))).first()[0] or 0.0

    def fit(self, log, user_features=None, item_features=None):
        groups = self._training_groups(log, user_features, item_features)
        self.trees = self._boost(self._flat(*groups), self.price_pow, self.learning_rate, groups)
        return self

    def auto_tune(self, log, user_features, item_features, price_pows=(1.1, 1.3, 1.5, 1.7),
                  alphas=(0.75, 0.8, 0.85, 0.9), learning_rates=(0.04, 0.05, 0.06)) -> list[tuple]:
        """Grid by mean predicted revenue; sets the best and returns every (setting, value)."""
        groups = self._training_groups(log, user_features, item_features)
        settings = list(itertools.product(price_pows, learning_rates))
        packed = self._packed_lists(groups)
        tuned = self._tune_rows(groups, settings, alphas) if packed is None else self._tune_packed(log.sparkSession, *packed, settings, alphas)
        results, best = [], None
        for (pow_, lr), (trees, values) in zip(settings, tuned):
            for a, v in zip(alphas, values):
                if v is None or v != v:
                    continue
                results.append((pow_, a, lr, float(v)))
                if best is None or v > best[0]:
                    best = (v, pow_, a, lr, trees)
        if best is None:
            raise RuntimeError("no setting gave a number")
        _, self.price_pow, self.edr_alpha, self.learning_rate, trees = best
        self.trees = trees()
        return results

    def _tune_rows(self, groups, settings, alphas) -> Iterator[tuple]:
        """(trees, mean predicted revenue for each alpha) of each setting, a Spark job a round."""
        rows, first = self._flat(*groups), self._first(groups)
        names = self.user_cols + self.item_cols
        for pow_, lr in settings:
            trees = self._boost(rows, pow_, lr, groups, first)
            scored = self._stored_scores(rows, trees, names, lr)
            score = F.col("__base")
            values = scored.agg(*[F.avg(F.nanvl(score, F.lit(None)) * price_power("price", a)) for a in alphas]).first()
            yield (lambda trees=trees: trees), values

    def _packed_lists(self, groups):
        """Broadcast ``PackedLists`` of small ``groups`` and the thresholds; else None."""
        users, large = groups
        rows = users.select("user_idx", F.inline(F.arrays_zip("ids", "labels", "x"))).withColumnsRenamed({"ids": "row_id", "labels": "label"})
        if large is not None:
            rows = rows.unionByName(large)
        names = self.user_cols + self.item_cols
        if not fits(rows.count(), len(names), 4):
            return None
        edges = bin_edges(rows, "x", len(names))
        held = keep_share(self.holdout, "user_idx", F.lit(self.seed))
        made = rows.select(
            F.col("user_idx").cast("bigint").alias("user_idx"), "row_id", "x", F.col("label").cast("double").alias("label"),
            F.col("x")[names.index("price")].alias("price"), held.cast("double").alias("held"),
        )
        made = made.repartition("user_idx").sortWithinPartitions("user_idx", "row_id")
        codes, other = packed_rows(made, "x", edges, ["user_idx", "label", "price", "held"])
        order = np.argsort(other["user_idx"], kind="stable")
        sizes = np.unique(other["user_idx"], return_counts=True)[1]
        lists = PackedLists(codes[order], other["label"][order], other["price"][order], other["held"][order] > 0, sizes)
        return users.sparkSession.sparkContext.broadcast(lists), edges

    def _tune_packed(self, spark, shared, edges, settings, alphas) -> list[tuple]:
        """As ``_tune_rows``, every setting a task over the packed rows."""
        how = Boosting(
            self.seed, self.num_boost_round, self.early_stopping_rounds, self.max_depth, self.min_data_in_leaf, self.lambda_l2,
            self.bagging_fraction, [self._draw_features(len(edges), n) for n in range(1, self.num_boost_round + 1)],
        )
        kinds = {"feature": np.int32, "split": np.uint8, "low": np.int32, "value": np.float64}

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for n in batch["id"]:
                    lists = shared.value
                    trees, score = boost(lists, *settings[n], how)
                    price = np.where(np.isnan(lists.price), 0.0, lists.price)
                    values = [float((score * price**a).mean()) if len(score) else None for a in alphas]
                    yield pd.DataFrame({"n": [n], "means": [values], "sizes": [[len(t.value) for t in trees]], **{
                        c: [np.concatenate([np.zeros(0, kind), *[getattr(t, c) for t in trees]]).astype(kind).tobytes()] for c, kind in kinds.items()
                    }})

        schema = "n int, means array<double>, sizes array<int>, feature binary, split binary, low binary, value binary"
        found = spark.range(0, len(settings), 1, len(settings)).mapInPandas(run, schema).collect()

        def trees(row) -> list[Tree]:
            parts = [np.split(np.frombuffer(row[c], kind), np.cumsum(row["sizes"])[:-1]) for c, kind in kinds.items()] if row["sizes"] else [[]] * 4
            return [_tree(FlatTree.of_bins(BinTree(*p), edges).root, len(edges)) for p in zip(*parts)]

        return [((lambda r=r: trees(r)), r["means"]) for r in sorted(found, key=lambda r: r["n"])]

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        users = self._user_side(with_features(users, user_features, "user_idx"))
        items = self._item_side(with_features(items, item_features, "item_idx"))
        seen = self._seen(log, filter_seen_items)
        return self._score_all(k, users, items, seen, self.trees, self.learning_rate, self.edr_alpha)


def _sum_trees(start: Column, trees: list[Tree], names: list[str], learning_rate: float) -> Column:
    total = start
    for t in trees:
        total = total + t.column(names) * F.lit(float(learning_rate))
    return total
