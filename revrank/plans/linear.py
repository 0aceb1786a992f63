"""Linear models: logistic regression with a revenue score, and a linear SVM."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrank.operators import features
from revrank.operators.blocked import blocked_topk, product_range
from revrank.operators.evaluate import accuracy
from revrank.operators.joins import enrich_interactions
from revrank.plans.base import Recommender, with_features
from revrank.session import cut, cut_wide

TEXT, NUMBERS = "string", ("double", "float", "int", "bigint")


def _kind(df: DataFrame, kinds, skip: tuple[str, ...]) -> list[str]:
    wanted = (kinds,) if isinstance(kinds, str) else kinds
    return [c for c, t in df.dtypes if t in wanted and c not in skip]


class _Additive(Recommender):
    """A linear model without cross features: logit(u, i) = a(u) + b(i).

    So a user is one number and an item two (its part and its worth), and pairs are
    scored in blocks instead of being built; blocks of neighbouring numbers have a close bound.
    """

    ID_COLUMNS = ("user_idx", "item_idx", "__iter", "timestamp", "relevance")

    def _design(self, log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
        """Keys, label and one sparse vector per log row, written; remembers how to make them."""
        self.user_text = _kind(users, TEXT, self.ID_COLUMNS)
        self.item_text = _kind(items, TEXT, self.ID_COLUMNS)
        self.user_nums = _kind(users, NUMBERS, self.ID_COLUMNS)
        self.item_nums = _kind(items, NUMBERS, self.ID_COLUMNS)
        self.keys = [c for c in ("user_idx", "item_idx", "timestamp") if c in log.columns]
        base = log.select(*self.keys, F.col("relevance"))
        rows = cut(enrich_interactions(base, users, items))
        scaled = [c for c in self.user_nums + self.item_nums if c in self._scaled()]
        self.scaler = features.fit_scaler(rows, scaled)
        label = (F.col("relevance") > 0).cast("double").alias("label")
        # Features are made on the two small tables; a log row only picks up two short lists.
        made = rows.select(*self.keys, label)
        self.levels, self.first, size = {}, {}, 0
        for side, key, nums, text in (
            (users, "user_idx", self.user_nums, self.user_text),
            (items, "item_idx", self.item_nums, self.item_text),
        ):
            levels = self.levels[key] = cut(features.level_table(side, text))
            self.first[key] = size
            numbers = [self._number(c) for c in nums]
            part = features.sparse_parts(side, key, numbers, text, levels, size, f"__{key}")
            made = made.join(cut(part), key)
            size += len(nums) + levels.count()
        return features.written_vectors(made, ["__user_idx", "__item_idx"], size)

    def _scaled(self) -> tuple[str, ...]:
        return ("price",)

    def _number(self, c: str) -> Column:
        return self.scaler.column(c) if c in self.scaler.mean else F.col(c)

    def _keep(self, model) -> None:
        """Weights of the fitted model: a few numbers' here, the levels' as written tables.

        The solver holds one vector of all weights on the driver (8 bytes a level); only its
        entries other than 0 become rows.
        """
        self.intercept = float(model.intercept)
        all_weights = np.asarray(model.coefficients.toArray(), np.float64)
        self.number_weights, self.level_weights = {}, {}
        for key, nums in (("user_idx", self.user_nums), ("item_idx", self.item_nums)):
            first, n_levels = self.first[key], self.levels[key].count()
            self.number_weights[key] = dict(zip(nums, all_weights[first : first + len(nums)].tolist()))
            own = all_weights[first + len(nums) : first + len(nums) + n_levels]
            place = np.flatnonzero(own)
            spark = self.levels[key].sparkSession
            weights = spark.createDataFrame(
                pd.DataFrame({"level": place.astype(np.int64), "weight": own[place]}), "level bigint, weight double"
            )
            self.level_weights[key] = cut(self.levels[key].join(weights, "level").drop("level"))

    def _part(self, df: DataFrame, key: str, start: float) -> DataFrame:
        """``df`` and ``__part``, this side's share of the logit: numbers here, levels by a join."""
        text = self.user_text if key == "user_idx" else self.item_text
        present = [c for c in text if c in df.columns]
        total = F.lit(float(start))
        for c, weight in self.number_weights[key].items():
            if weight and c in df.columns:
                total = total + F.coalesce(self._number(c).cast("double"), F.lit(0.0)) * F.lit(weight)
        for n in range(len(present)):
            total = total + F.coalesce(F.col(f"__weight{n}"), F.lit(0.0))
        return features.lookup_levels(df, self.level_weights[key], present, "weight", "__weight").withColumn("__part", total)

    def _rank(self, k, users, items, seen, lift: Callable[[np.ndarray], np.ndarray], worth: Column) -> DataFrame:
        """Best by lift(probability) * worth; ``lift`` rises with the probability, ``worth`` is the item's."""
        asked = self._part(users, "user_idx", self.intercept).select("user_idx", F.array("__part").alias("uvec"))
        offered = self._part(items, "item_idx", 0.0).select(
            "item_idx", F.array(F.col("__part"), worth.cast("double")).alias("ivec")
        )

        def score(u: np.ndarray, i: np.ndarray) -> np.ndarray:
            return lift(_probability(u[:, :1] + i[:, 0][None, :])) * i[:, 1][None, :]

        def bound(ulo: np.ndarray, uhi: np.ndarray, ilo: np.ndarray, ihi: np.ndarray) -> np.ndarray:
            low, high = lift(_probability(ulo[:, :1] + ilo[:, 0])), lift(_probability(uhi[:, :1] + ihi[:, 0]))
            return product_range(low, high, ilo[:, 1], ihi[:, 1])

        return blocked_topk(asked, offered, k, score, seen, bound=bound)


def _probability(logit: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-logit))


def _trig_lift(p: np.ndarray) -> np.ndarray:
    return (np.sin(p) + 1) * np.exp(p - 1) * (1 + np.tan(p * np.pi / 4))


def _trig_worth() -> Column:
    price = F.col("price").cast("double")
    return F.log1p(price) * F.cos(price / 100)


def _itself(p: np.ndarray) -> np.ndarray:
    return p


class LogisticRecommender(_Additive):
    """One-hot text, scaled price, ridge or lasso logistic regression, trigonometric revenue score."""

    def __init__(self, penalty: str = "l2", C: float = 1.0, max_iter: int = 1000, cv: int = 5, seed: int = 42):
        super().__init__(seed)
        if penalty not in ("l1", "l2"):
            raise ValueError("penalty is 'l1' or 'l2'")
        self.penalty, self.C, self.max_iter, self.cv = penalty, C, max_iter, cv

    def _estimator(self, n: int) -> LogisticRegression:
        # The penalty is averaged over rows here: C on a sum is 1 / (C n) on a mean.
        return LogisticRegression(
            regParam=1.0 / (self.C * max(1, n)),
            elasticNetParam=1.0 if self.penalty == "l1" else 0.0,
            standardization=False,
            maxIter=self.max_iter,
        )

    def fit(self, log, user_features=None, item_features=None):
        data = self._design(log, user_features, item_features)
        self._keep(self._estimator(data.count()).fit(data))
        return self

    def cross_validate(self, log, user_features, item_features) -> DataFrame:
        """(fold, accuracy) over stratified folds; the mean is an average away."""
        data = self._design(log, user_features, item_features)
        data = cut_wide(features.stratified_folds(data, "label", self.keys, self.cv, self.seed))
        n = data.count()
        parts = None
        for fold in range(self.cv):
            model = self._estimator(n * (self.cv - 1) // self.cv).fit(data.filter(F.col("fold") != fold))
            scored = model.transform(data.filter(F.col("fold") == fold))
            row = accuracy(scored).select(F.lit(fold).alias("fold"), "accuracy")
            parts = row if parts is None else parts.unionByName(row)
        return parts

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=False):
        users = with_features(users, user_features, "user_idx")
        items = with_features(items, item_features, "item_idx")
        best = self._rank(k, users, items, self._seen(log, filter_seen_items), _trig_lift, _trig_worth())
        return best.join(items.select("item_idx", "price"), "item_idx").select(
            "user_idx", "item_idx", "relevance", "price", "rank"
        )


class SVMRecommender(_Additive):
    """Linear SVM; the margin goes through the logistic link and is paid by price."""

    def __init__(self, reg_param: float = 0.01, max_iter: int = 50, seed: int = 42):
        super().__init__(seed)
        self.reg_param, self.max_iter = reg_param, max_iter

    def _scaled(self):
        return tuple(self.user_nums + self.item_nums)

    def fit(self, log, user_features=None, item_features=None):
        data = self._design(log, user_features, item_features)
        self._keep(LinearSVC(regParam=self.reg_param, maxIter=self.max_iter).fit(data))
        return self

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        users = with_features(users, user_features, "user_idx")
        items = with_features(items, item_features, "item_idx")
        return self._rank(k, users, items, self._seen(log, filter_seen_items), _itself, F.col("price"))
