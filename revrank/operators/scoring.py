"""Scores of given (user, item) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.functions.vectors import dot


def softmax_by(df: DataFrame, by: str, x: str, name: str = "p") -> DataFrame:
    """exp(x - max) / sum inside each key, by two small aggregates instead of a window over the key."""
    top = df.groupBy(by).agg(F.max(x).alias("__top"))
    raised = df.join(top, by).withColumn("__e", F.exp(F.col(x) - F.col("__top")))
    total = raised.groupBy(by).agg(F.sum("__e").alias("__sum"))
    return raised.join(total, by).withColumn(name, F.col("__e") / F.col("__sum")).drop("__top", "__e", "__sum")


def dot_product_scores(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Inner product of ``uvec`` and ``ivec`` for the given pairs. For all pairs see ``blocked_topk``."""
    found = pairs.join(users, "user_idx").join(items, "item_idx")
    return found.withColumn("logit", dot("uvec", "ivec")).drop("uvec", "ivec")
