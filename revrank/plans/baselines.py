"""Popularity, random, content and linear-margin recommenders."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.functions.hashing import draw
from revrank.functions.vectors import l2_normalize
from revrank.operators.aggregates import item_popularity
from revrank.operators.blocked import BROADCAST_BYTES, blocked_topk
from revrank.operators.joins import seen_pairs
from revrank.operators.ranking import global_rank, head_of_order, top_k
from revrank.plans.base import Recommender
from revrank.session import cores, cut

# Pairs of users and liked items that one task sums at most, give or take a user.
PAIRS_PER_TASK = 50_000


class PopularityRecommender(Recommender):
    """Sum of relevance^alpha per item; the order is the same for all users."""

    def __init__(self, alpha: float = 1.0, seed: int = 42):
        super().__init__(seed)
        self.alpha = alpha

    def fit(self, log, user_features=None, item_features=None):
        self.scores = item_popularity(log, self.alpha)
        return self

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        scored = items.select("item_idx").join(self.scores, "item_idx", "left").select(
            "item_idx", F.coalesce("score", F.lit(0.0)).alias("relevance")
        )
        order = global_rank(scored, [F.col("relevance").desc(), F.col("item_idx")])
        found = head_of_order(users.select("user_idx"), order, self._seen(log, filter_seen_items), k)
        return top_k(found.select("user_idx", "item_idx", "relevance"), k)


class RandomRecommender(Recommender):
    """A seeded shuffle of the items that every user enters at another place.

    Each user starts at a hashed position of one shuffled ring and takes the next k unseen
    items. Relevance falls from 1 with the distance on the ring.
    """

    def fit(self, log, user_features=None, item_features=None):
        return self

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        mixed = items.select("item_idx").distinct().withColumn("__mix", draw("item_idx", F.lit(self.seed)))
        ring = global_rank(mixed, ["__mix", "item_idx"]).select((F.col("rank") - 1).alias("slot"), "item_idx")
        size = ring.agg(F.count("*")).first()[0]
        asked = users.select("user_idx").withColumn(
            "start", draw(F.lit("start"), "user_idx", F.lit(self.seed)) % F.lit(size)
        )
        seen = self._seen(log, filter_seen_items)
        if seen is None:
            asked = asked.withColumn("upto", F.lit(k))
        else:
            gone = seen.groupBy("user_idx").agg(F.count("*").alias("gone"))
            asked = asked.join(gone, "user_idx", "left").withColumn("upto", F.lit(k) + F.coalesce("gone", F.lit(0)))
        # No more than k + seen steps are needed, and no more than one round.
        steps = F.sequence(F.lit(0), (F.least("upto", F.lit(size)) - 1).cast("int"))
        walk = asked.select("user_idx", "start", F.explode(steps).alias("step")).withColumn(
            "slot", (F.col("start") + F.col("step")) % F.lit(size)
        )
        found = walk.join(ring, "slot")
        if seen is not None:
            found = found.join(seen, ["user_idx", "item_idx"], "left_anti")
        return top_k(found.select("user_idx", "item_idx", (1.0 - F.col("step") / F.lit(size)).alias("relevance")), k)


class ContentRecommender(Recommender):
    """Cosine between an item's vector and the mean vector of the user's liked items."""

    def __init__(self, similarity_threshold: float = 0.0, seed: int = 42):
        super().__init__(seed)
        self.similarity_threshold = similarity_threshold

    def fit(self, log, user_features=None, item_features=None):
        """``item_features`` carries an array column ``vector``."""
        self.vectors = item_features.select("item_idx", l2_normalize("vector").alias("ivec"))
        liked = cut(seen_pairs(log.filter(F.col("relevance") > 0)))
        width = item_features.select(F.max(F.size("vector"))).first()[0]
        profile = _mean_vectors(liked, self.vectors, width or 0)
        self.width = width
        self.profiles = profile.select("user_idx", l2_normalize("uvec").alias("uvec"))
        return self

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        # Who liked nothing is equally far from everything.
        nothing = F.array_repeat(F.lit(0.0), self.width)
        asked = users.select("user_idx").join(self.profiles, "user_idx", "left")
        asked = asked.select("user_idx", F.coalesce("uvec", nothing).alias("uvec"))
        offered = items.select("item_idx").join(self.vectors, "item_idx")
        best = blocked_topk(
            asked, offered, k, _cosine_above(self.similarity_threshold), self._seen(log, filter_seen_items)
        )
        return best


def _mean_vectors(liked: DataFrame, vectors: DataFrame, width: int) -> DataFrame:
    """(user_idx, uvec): mean vector of each user's liked items.

    Only the pairs are shuffled, by user; the vectors of liked items come to them by broadcast, in parts where they are
    many. So no row per pair that holds a vector or its sums is written.
    """
    vectors = vectors.join(cut(liked.select("item_idx").distinct()), "item_idx", "left_semi")
    pairs, n_items = liked.count(), vectors.count()
    parts = max(1, -(-n_items * (width + 1) * 8 // BROADCAST_BYTES))
    spread = liked.repartition(max(cores(liked.sparkSession), -(-pairs // PAIRS_PER_TASK)), "user_idx")
    number = F.pmod(F.xxhash64("item_idx"), F.lit(parts))
    sums = None
    for part in range(parts):
        some = vectors if parts == 1 else vectors.filter(number == part)
        met = spread.join(F.broadcast(some), "item_idx").groupBy("user_idx")
        if parts == 1:
            return met.agg(F.array(*[F.avg(F.element_at("ivec", j + 1)) for j in range(width)]).alias("uvec"))
        found = cut(met.agg(*[f(F.element_at("ivec", j + 1)).alias(f"{n}{j}") for j in range(width) for n, f in (("s", F.sum), ("n", F.count))]))
        sums = found if sums is None else sums.unionByName(found)
    return sums.groupBy("user_idx").agg(F.array(*[F.sum(f"s{j}") / F.nullif(F.sum(f"n{j}"), F.lit(0)) for j in range(width)]).alias("uvec"))


def _cosine_above(threshold: float):
    def score(u: np.ndarray, i: np.ndarray) -> np.ndarray:
        # Seven digits, so that the order of summing cannot decide between equal items.
        s = np.floor((u @ i.T) * 1e6 + 0.50001) / 1e6
        s[s < threshold] = -np.inf
        return s

    return score
