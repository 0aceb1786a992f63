"""Joins of the pipeline.

No broadcast hints: which side is small depends on the data. Spark broadcasts a
side below ``autoBroadcastJoinThreshold`` from file statistics, and adaptive
execution does it from the measured size of the finished shuffle. Where both are
large, adaptive execution splits a partition that holds a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR = ["user_idx", "item_idx"]


def enrich_interactions(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Log with user and item features. The item table's price replaces the log's."""
    clash = [c for c in log.columns if c in items.columns and c != "item_idx"]
    return log.drop(*clash).join(users, "user_idx").join(items, "item_idx")


def seen_pairs(log: DataFrame) -> DataFrame:
    return log.select(*PAIR).distinct()


def exclude_seen(candidates: DataFrame, log: DataFrame | None, filter_seen_items: bool = True) -> DataFrame:
    """Candidates the user has no row for in the log."""
    if not filter_seen_items or log is None:
        return candidates
    return candidates.join(seen_pairs(log), PAIR, "left_anti")


def filter_users_isin(log: DataFrame, users: DataFrame) -> DataFrame:
    """Log rows of the asked users: a semi join, not a literal list."""
    return log.join(users.select("user_idx").distinct(), "user_idx", "left_semi")


def restrict_ids(df: DataFrame, column: str, size: int) -> DataFrame:
    return df.filter(F.col(column) < F.lit(size))


def attach_stats(df: DataFrame, user_stats: DataFrame, item_stats: DataFrame) -> DataFrame:
    """Left join both statistics tables; an unknown id gets zeros."""
    added = [c for c in user_stats.columns + item_stats.columns if c not in PAIR]
    return df.join(user_stats, "user_idx", "left").join(item_stats, "item_idx", "left").fillna(0, subset=added)


def pair_features(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    return pairs.join(users, "user_idx").join(items, "item_idx")
