"""Autoregressive recommender: what follows the user's newest items, times price.

Most items of a user share one default probability, so among them the order is the
price order, the same for everyone. A user's top-k lies in the union of

* the head of the list of counted successors of the user's context, and
* the head of the price order of every default class,

each long enough to skip what the user has seen (``head_of_order``). Taking an item's
best score over the lists is exact: a counted item that also sits in a default list has
the larger score in its own list (items of negative price, where it is the other way round,
are kept out of the default lists of contexts that count them), and fewer than k items can
stand before a true top-k item in any list that scores no item too high. The work grows with
users * k plus the seen pairs, not with users * items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.operators.aggregates import last_price_per_item, scalar
from revrank.operators.ngram import (
    BACKOFF_FLOOR,
    addk_probabilities,
    backoff_probabilities,
    ngram_counts,
    ngram_totals,
    suffix,
)
from revrank.operators.positions import with_position
from revrank.operators.ranking import global_rank, head_of_order, top_k
from revrank.operators.sequences import current_context
from revrank.plans.base import Recommender
from revrank.session import cut
from revrank.sources.schema import with_default_columns

UNSMOOTHED_PROBABILITY = 0.0001


def price_order(items: DataFrame) -> DataFrame:
    return global_rank(items, [F.col("price").desc(), F.col("item_idx")])


class NGramRecommender(Recommender):
    """``smoothing`` None scores every pair alike (price order), "add-k" or "back-off"."""

    def __init__(self, order: int = 2, max_seq_len: int = 100, smoothing: str | None = None, k: float = 0.001,
                 time: list[str] | None = None, seed: int = 42):
        super().__init__(seed)
        if smoothing not in (None, "add-k", "back-off"):
            raise ValueError("smoothing is None, 'add-k' or 'back-off'")
        self.order, self.max_seq_len, self.smoothing, self.k = order, max_seq_len, smoothing, k
        self.time = time or ["timestamp", "item_idx"]

    def fit(self, log, user_features=None, item_features=None):
        log = with_default_columns(log)
        if self.smoothing is None:
            return self
        self.prices = last_price_per_item(log, self.time)
        self.counts = cut(ngram_counts(log, self.order, self.time, self.max_seq_len))
        self.totals = ngram_totals(self.counts)
        self.vocabulary = log.select("item_idx").distinct()
        self.vocabulary_size = scalar(log, F.count_distinct("item_idx"))
        self.contexts = current_context(log, self.order, self.time)
        return self

    def _priced(self, items: DataFrame) -> DataFrame:
        """Candidate items with the log's last price, else their own, else 1."""
        own = F.col("price") if "price" in items.columns else F.lit(None).cast("double")
        base = items.select("item_idx", own.cast("double").alias("__own"))
        last = self.prices.withColumnRenamed("price", "__last")
        return base.join(last, "item_idx", "left").select(
            "item_idx", F.coalesce("__last", "__own", F.lit(1.0)).alias("price")
        )

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        seen = self._seen(log, filter_seen_items)
        users = users.select("user_idx")
        if self.smoothing is None:
            priced = items.select("item_idx", "price")
            found = head_of_order(users, price_order(priced), seen, k)
            scored = found.select("user_idx", "item_idx", (F.col("price") * UNSMOOTHED_PROBABILITY).alias("relevance"))
            return top_k(scored, k)
        priced = cut(self._priced(items))
        asked = users.join(self.contexts, "user_idx", "left")
        asked = cut(asked.withColumn("ctx", F.coalesce("ctx", F.array().cast("array<bigint>"))))
        if seen is not None:
            seen = cut(seen.join(users, "user_idx", "left_semi"))
        if self.smoothing == "add-k":
            lists = self._addk_lists(asked, priced, seen, k)
        else:
            lists = self._backoff_lists(asked, priced, seen, k)
        rows = lists[0]
        for more in lists[1:]:
            rows = rows.unionByName(more)
        best = rows.groupBy("user_idx", "item_idx").agg(F.max("relevance").alias("relevance"))
        return top_k(best, k)

    # Lists of (user_idx, item_idx, relevance) ------------------------------------------

    @staticmethod
    def _ranked_successors(probs: DataFrame, priced: DataFrame) -> DataFrame:
        """Counted successors per context, best expected revenue first."""
        scored = probs.select("ctx", "item_idx", "p").join(priced, "item_idx").withColumn(
            "revenue", F.col("price") * F.col("p")
        )
        order = [F.col("revenue").desc(), F.col("item_idx")]
        placed = with_position(scored, ["ctx"], order, "rank")
        return placed.select("ctx", (F.col("rank") + 1).alias("rank"), "item_idx", "revenue")

    def _addk_lists(self, asked, priced, seen, k):
        size = self.vocabulary_size
        contexts = asked.select("ctx").distinct()
        probs = addk_probabilities(self.counts.join(contexts, "ctx", "left_semi"), self.k, size)
        successors = cut(self._ranked_successors(probs, priced))
        own = head_of_order(asked, successors, seen, k, group="ctx").select(
            "user_idx", "item_idx", F.col("revenue").alias("relevance")
        )
        # Outside its context's counts an item gets k / (total + kV); with no such context, or
        # outside the vocabulary, 1/V.
        known = asked.join(self.totals, "ctx", "left").select(
            "user_idx",
            F.when(F.col("total").isNull(), F.lit(self.k) / (F.lit(self.k) * size))
            .otherwise(F.lit(self.k) / (F.col("total") + F.lit(self.k) * size))
            .alias("p0"),
            "ctx",
        )
        inside = price_order(priced.join(self.vocabulary, "item_idx", "left_semi"))
        outside = price_order(priced.join(self.vocabulary, "item_idx", "left_anti"))
        score = (F.col("price") * F.col("p0")).alias("relevance")
        low = probs.join(self._negative(priced), "item_idx").select("ctx", "item_idx")
        if low.isEmpty():
            default = head_of_order(known.drop("ctx"), inside, seen, k).select("user_idx", "item_idx", score)
        else:
            low = cut(low)
            special = self._needs(asked, seen, k).join(low.select("ctx").distinct(), "ctx", "left_semi")
            heads = self._context_heads(special, inside, low, None)
            mine = head_of_order(known, heads, seen, k, group="ctx").select("user_idx", "item_idx", score)
            others = known.join(special.select("ctx"), "ctx", "left_anti").drop("ctx")
            default = mine.unionByName(head_of_order(others, inside, seen, k).select("user_idx", "item_idx", score))
        foreign = head_of_order(asked.select("user_idx"), outside, seen, k).select(
            "user_idx", "item_idx", (F.col("price") * (F.lit(self.k) / (F.lit(self.k) * size))).alias("relevance")
        )
        return [own, default, foreign]

    def _backoff_lists(self, asked, priced, seen, k):
        """One list per context length, and the default list.

        A shorter context may only offer what the longer ones did not count. That is worked
        out per context, not per user: users who share a context share its lists.
        """
        probs = cut(backoff_probabilities(self.counts))
        contexts = cut(self._needs(asked, seen, k))
        ranked = cut(self._ranked_successors(probs, priced).withColumnRenamed("ctx", "tail"))
        lists = []
        for n in range(self.order, 0, -1):
            here = contexts.filter(F.size("ctx") >= n).withColumn("tail", suffix("ctx", n))
            longer = self._counted_by_longer(here, probs, n)
            heads = self._context_heads(here, ranked, longer, "tail")
            lists.append(
                head_of_order(asked, heads, seen, k, group="ctx").select(
                    "user_idx", "item_idx", F.col("revenue").alias("relevance")
                )
            )
        default = price_order(priced)
        floor = (F.col("price") * BACKOFF_FLOOR).alias("relevance")
        lists.append(head_of_order(asked.select("user_idx"), default, seen, k).select("user_idx", "item_idx", floor))
        # A context seen more than 1 / floor times can count an item below the floor; the default
        # list must not offer it then. Such contexts get a default list of their own.
        rare = probs.filter(F.col("p") < BACKOFF_FLOOR).select("ctx", "item_idx")
        negative = self._negative(priced)
        if not (rare.isEmpty() and negative.isEmpty()):
            lists[-1] = self._default_without(asked, contexts, probs, default, seen, k, negative)
        return lists

    @staticmethod
    def _negative(priced: DataFrame) -> DataFrame:
        """Items of negative price: the larger probability gives the smaller score."""
        return priced.filter(F.col("price") < 0).select("item_idx").distinct()

    @staticmethod
    def _needs(asked: DataFrame, seen: DataFrame | None, k: int) -> DataFrame:
        """(ctx, need): how far down its lists the most demanding user of a context has to look."""
        gone = None if seen is None else seen.groupBy("user_idx").agg(F.count("*").alias("__gone"))
        needed = asked if gone is None else asked.join(gone, "user_idx", "left")
        upto = F.lit(k) if gone is None else F.lit(k) + F.coalesce(F.max("__gone"), F.lit(0))
        return needed.groupBy("ctx").agg(upto.alias("need"))

    def _counted_by_longer(self, here: DataFrame, probs: DataFrame, n: int) -> DataFrame | None:
        """(ctx, item_idx) counted by a suffix of ctx longer than n."""
        parts = None
        for m in range(n + 1, self.order + 1):
            tails = here.filter(F.size("ctx") >= m).select("ctx", suffix("ctx", m).alias("__tail"))
            part = tails.join(probs.select(F.col("ctx").alias("__tail"), "item_idx"), "__tail").select("ctx", "item_idx")
            parts = part if parts is None else parts.unionByName(part)
        return None if parts is None else parts.distinct()

    @staticmethod
    def _context_heads(here: DataFrame, order: DataFrame, longer: DataFrame | None, group: str | None) -> DataFrame:
        """The shared order cut down to one head per context, ranked anew."""
        heads = head_of_order(here, order, longer, F.col("need"), key="ctx", group=group)
        placed = with_position(heads.withColumnRenamed("rank", "__old"), ["ctx"], ["__old"], "rank")
        return cut(placed.withColumn("rank", F.col("rank") + 1).drop("__old", "need", "tail"))

    def _default_without(self, asked, contexts, probs, default, seen, k, negative):
        parts = None
        for n in range(1, self.order + 1):
            tails = contexts.filter(F.size("ctx") >= n).select("ctx", suffix("ctx", n).alias("__tail"))
            part = tails.join(probs.select(F.col("ctx").alias("__tail"), "item_idx", "p"), "__tail").select(
                "ctx", "item_idx", "p", F.lit(n).alias("n")
            )
            parts = part if parts is None else parts.unionByName(part)
        final = parts.groupBy("ctx", "item_idx").agg(F.max_by("p", "n").alias("p"))
        below = final.join(negative.withColumn("__negative", F.lit(True)), "item_idx", "left")
        low = cut(below.filter((F.col("p") < BACKOFF_FLOOR) | F.col("__negative")).select("ctx", "item_idx"))
        special = contexts.join(low.select("ctx").distinct(), "ctx", "left_semi")
        heads = self._context_heads(special, default, low, None)
        floor = (F.col("price") * BACKOFF_FLOOR).alias("relevance")
        mine = head_of_order(asked, heads, seen, k, group="ctx").select("user_idx", "item_idx", floor)
        others = asked.join(special.select("ctx"), "ctx", "left_anti").select("user_idx")
        return mine.unionByName(head_of_order(others, default, seen, k).select("user_idx", "item_idx", floor))

