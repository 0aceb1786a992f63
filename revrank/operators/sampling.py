"""Splits and negative samples, all set-based and repeatable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.functions.hashing import draw, keep_share
from revrank.operators.joins import PAIR


def distinct_edges(log: DataFrame) -> DataFrame:
    return log.select(*PAIR).distinct()


def holdout_split(edges: DataFrame, share: float = 0.1, seed: int = 42) -> DataFrame:
    """Marks ``is_val`` on about ``share`` of the edges."""
    return edges.withColumn("is_val", keep_share(share, *PAIR, F.lit(seed)))


def temporal_split(log: DataFrame, last_train: int) -> tuple[DataFrame, DataFrame]:
    return log.filter(F.col("__iter") <= last_train), log.filter(F.col("__iter") > last_train)


def edge_dropout(edges: DataFrame, p: float, epoch: int, seed: int = 42) -> DataFrame:
    """Keeps each undirected edge with probability 1 - p, anew for every epoch."""
    if p <= 0:
        return edges
    return edges.filter(~keep_share(p, *PAIR, F.lit(epoch), F.lit(seed)))


def negative_sample_uniform(edges: DataFrame, n_items: int, epoch: int = 0, seed: int = 42) -> DataFrame:
    """One random item id below ``n_items`` per edge."""
    return edges.withColumn("neg_idx", draw(*PAIR, F.lit(epoch), F.lit(seed)) % F.lit(n_items))


def numbered_items(items: DataFrame) -> DataFrame:
    """(slot, item_idx): a dense number for every item, so a draw can name one."""
    from revrank.operators.ranking import global_rank

    return global_rank(items.select("item_idx").distinct(), ["item_idx"]).select(
        (F.col("rank") - 1).alias("slot"), "item_idx"
    )


def negative_sample_unseen(
    samples: DataFrame, key: list[str], seen: DataFrame, slots: DataFrame, tries: int = 4, seed: int = 42
) -> DataFrame:
    """One item per sample that the sample's user has no row for.

    ``tries`` seeded draws per sample meet the seen pairs in one anti join and the
    first survivor is kept. Samples whose draws were all seen take the user's
    smallest unseen slot instead (an exact way for the rest); samples of users who
    have seen everything are dropped, there is no negative for them.
    """
    size = slots.agg(F.count("*")).first()[0]
    seen_slots = seen.select(*PAIR).distinct().join(slots, "item_idx").select("user_idx", "slot")
    tried = samples.withColumn("__try", F.explode(F.sequence(F.lit(0), F.lit(tries - 1)))).withColumn(
        "slot", draw(*key, F.col("__try"), F.lit(seed)) % F.lit(size)
    )
    alive = tried.join(seen_slots, ["user_idx", "slot"], "left_anti")
    first = alive.groupBy(*key).agg(F.min_by("slot", "__try").alias("__slot"))
    drawn = samples.join(first, key, "left")
    fallback = smallest_unseen(samples.select("user_idx").distinct(), seen_slots, size)
    return (
        drawn.join(fallback, "user_idx", "left")
        .withColumn("slot", F.coalesce("__slot", "__free"))
        .drop("__slot", "__free")
        .join(slots.withColumnRenamed("item_idx", "neg_idx"), "slot")
        .drop("slot")
    )


def smallest_unseen(users: DataFrame, seen_slots: DataFrame, size: int) -> DataFrame:
    """(user, __free): smallest slot the user has not seen, without listing the unseen ones.

    It is 0, or one above a seen slot whose successor is not seen.
    """
    follow = seen_slots.select("user_idx", (F.col("slot") + 1).alias("slot"))
    starts = users.select("user_idx", F.lit(0).cast("bigint").alias("slot"))
    free = follow.unionByName(starts).join(seen_slots, ["user_idx", "slot"], "left_anti")
    return free.filter(F.col("slot") < size).groupBy("user_idx").agg(F.min("slot").alias("__free"))


def negative_sample_bipartite(
    edges: DataFrame, slots: DataFrame, tries: int = 4, seed: int = 42
) -> DataFrame:
    """A non-edge (same user, other item) for every edge whose user has one."""
    drawn = negative_sample_unseen(edges, PAIR, edges, slots, tries, seed)
    return drawn.select("user_idx", F.col("neg_idx").alias("item_idx"))
