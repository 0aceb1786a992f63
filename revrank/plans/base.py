"""The contract every recommender keeps."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame

from revrank.operators.joins import seen_pairs


class Recommender(ABC):
    """``fit`` on a log, then ``predict`` (user_idx, item_idx, relevance, rank).

    Users of the library add a model by writing these two methods. Everything in and
    out is a DataFrame; nothing log-sized passes through the driver.
    """

    def __init__(self, seed: int = 42):
        self.seed = seed

    @abstractmethod
    def fit(self, log: DataFrame, user_features: DataFrame | None = None, item_features: DataFrame | None = None):
        """Learn from the log; returns self."""

    @abstractmethod
    def predict(
        self,
        log: DataFrame | None,
        k: int,
        users: DataFrame,
        items: DataFrame,
        user_features: DataFrame | None = None,
        item_features: DataFrame | None = None,
        filter_seen_items: bool = True,
    ) -> DataFrame:
        """Best ``k`` items per user, pairs of ``log`` left out unless told otherwise."""

    @staticmethod
    def _seen(log: DataFrame | None, filter_seen_items: bool) -> DataFrame | None:
        return seen_pairs(log) if filter_seen_items and log is not None else None


def with_features(ids: DataFrame, features: DataFrame | None, key: str) -> DataFrame:
    """Rows of ``ids`` with the feature columns they do not carry already."""
    if features is None:
        return ids
    extra = [c for c in features.columns if c not in ids.columns]
    return ids.join(features.select(key, *extra), key, "left") if extra else ids
