"""Next-item models over the user's newest items.

Both keep one vector per item. A user's state before a row is a mix of the vectors of the
up to L rows before it. Histories are packed once; an epoch brings vectors to the packed
chunks, works out gradients in the tasks and sums them per item (operators.sequence_blocks).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.functions.hashing import with_row_id
from revrank.functions.vectors import dot, names, to_array
from revrank.operators import sampling
from revrank.operators.aggregates import first_price_per_item
from revrank.operators.blocked import blocked_logsumexp, blocked_topk
from revrank.operators.graph import EDGES_PER_COPY
from revrank.operators.sequence_blocks import CHUNK, attention_gradient, chunk_nodes, pack_histories, pooled_softmax_gradient
from revrank.operators.sequences import last_n_history
from revrank.plans.base import Recommender
from revrank.plans.training import adam_step, gather, start_state
from revrank.session import cut
from revrank.sources.schema import price_from_items


class _SequenceRecommender(Recommender):
    def __init__(self, dim: int, max_len: int, lr: float, weight_decay: float, epochs: int, time, seed: int, chunk: int = CHUNK):
        super().__init__(seed)
        self.chunk = chunk
        self.dim, self.max_len, self.lr, self.weight_decay, self.epochs = dim, max_len, lr, weight_decay, epochs
        self.time = time or ["timestamp", "item_idx"]
        self.losses: list[float] = []

    def _pack(self, log: DataFrame, item_features: DataFrame | None, extras: list[str]) -> None:
        """Chunks of histories, their links to items, and the node table; written once, used every epoch."""
        base = self._base(log, item_features)
        self.chunks = pack_histories(base, self.time, self.max_len, extras, self.chunk)
        lists = ["items", *[c for c in extras if c == "negs"]]
        self.links, used = chunk_nodes(self.chunks, lists, EDGES_PER_COPY)
        # Items that nobody touched take part in the softmax and can be recommended, too.
        every = log.select("item_idx") if item_features is None else log.select("item_idx").union(item_features.select("item_idx"))
        nodes = every.distinct().withColumnRenamed("item_idx", "node").join(used, "node", "left")
        self.nodes = cut(nodes.select("node", F.coalesce("copies", F.lit(1)).alias("copies")))
        live = F.size(F.filter("own", lambda x: x)) - F.when(F.get("own", F.lit(0)), 1).otherwise(0)
        self.n_rows = self.chunks.agg(F.sum(live)).first()[0] or 0
        if not self.n_rows:
            raise ValueError("no user has two log rows")

    def _base(self, log: DataFrame, item_features: DataFrame | None) -> DataFrame:
        return log.select("user_idx", "item_idx", *[c for c in self.time if c != "item_idx"])

    def _start(self) -> DataFrame:
        return cut(start_state(self.nodes, self.dim, self.seed, self._scale()))

    def _scale(self) -> float:
        return 1.0 / math.sqrt(self.dim)

    def _vectors(self, state: DataFrame) -> DataFrame:
        return state.select("node", "copies", *names(self.dim))

    def _gradient(self, emb: DataFrame) -> DataFrame:
        """(node, e0.., loss) of the whole log at the vectors ``emb``."""
        raise NotImplementedError

    def _limit(self, grad: DataFrame) -> DataFrame:
        return grad

    def _epoch(self, state: DataFrame, step: int) -> DataFrame:
        grad = cut(self._gradient(self._vectors(state)))
        self.losses.append(grad.agg(F.sum("loss")).first()[0])
        return cut(adam_step(state, self._limit(grad), self.dim, step, self.lr, self.weight_decay))

    def _newest(self, log: DataFrame, users: DataFrame) -> DataFrame:
        asked = log.select("user_idx", "item_idx", *[c for c in self.time if c != "item_idx"])
        asked = asked.join(users.select("user_idx").distinct(), "user_idx", "left_semi")
        return last_n_history(asked, self.max_len, self.time)

    def _items(self, items: DataFrame, prices: DataFrame) -> DataFrame:
        """Candidates as vector and price; an item that was unknown to ``fit`` has its start vector."""
        vec = self.state.select(F.col("node").alias("item_idx"), to_array(self.dim).alias("v"))
        fresh = start_state(items.select(F.col("item_idx").alias("node"), F.lit(1).alias("copies")), self.dim, self.seed, self._scale())
        start = fresh.select(F.col("node").alias("item_idx"), to_array(self.dim).alias("s"))
        found = start.join(vec, "item_idx", "left").join(prices, "item_idx", "left")
        return found.select("item_idx", F.concat(F.coalesce("v", "s"), F.array(F.coalesce("price", F.lit(1.0)))).alias("ivec"))

    def _with_cold(self, states: DataFrame, users: DataFrame) -> DataFrame:
        """Users without history start from the zero state."""
        cold = F.array_repeat(F.lit(0.0), self.dim)
        return users.select("user_idx").join(states, "user_idx", "left").select(
            "user_idx", F.coalesce("uvec", cold).alias("uvec")
        )


def _logits(u: np.ndarray, i: np.ndarray) -> np.ndarray:
    return u @ i[:, :-1].T


def _exp_price(u: np.ndarray, i: np.ndarray) -> np.ndarray:
    # The user's last number is the log of the softmax denominator.
    return np.exp(u[:, :-1] @ i[:, :-1].T - u[:, -1:]) * i[:, -1][None, :]


def _sigmoid_price(power: float):
    def score(u: np.ndarray, i: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(u @ i[:, :-1].T))) * i[:, -1][None, :] ** power

    return score


class SequencePoolRecommender(_SequenceRecommender):
    """State = half the newest item, half the mean of the last L; score = softmax * price.

    Trained on the full softmax: the next item against all items, whole-log gradients.
    """

    def __init__(self, embed_dim: int = 64, lr: float = 1e-3, weight_decay: float = 1e-5, epochs: int = 5,
                 max_seq_len: int = 50, time: list[str] | None = None, seed: int = 42, chunk: int = CHUNK):
        super().__init__(embed_dim, max_seq_len, lr, weight_decay, epochs, time, seed, chunk)

    def fit(self, log, user_features=None, item_features=None):
        self._pack(log, item_features, [])
        state = self._start()
        for epoch in range(self.epochs):
            state = self._epoch(state, epoch + 1)
        self.state = state
        self.history = log
        return self

    def _gradient(self, emb):
        return pooled_softmax_gradient(self.chunks, self.links, emb, self.dim, self.max_len, self.n_rows)

    def _limit(self, grad):
        return _clip(grad, self.dim, 5.0)

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        d = self.dim
        newest = self._newest(self.history if log is None else log, users)
        found = gather(newest, self._vectors(self.state), "item_idx", "e", d)
        means = [F.avg(f"e{j}") for j in range(d)]
        lasts = [F.max(F.when(F.col("recency") == 1, F.col(f"e{j}"))) for j in range(d)]
        states = found.groupBy("user_idx").agg(F.array(*[(m + x) / 2.0 for m, x in zip(means, lasts)]).alias("uvec"))
        uvec = cut(self._with_cold(states, users))
        prices = (items if item_features is None else item_features).select("item_idx", "price")
        ivec = cut(self._items(items, prices))
        norms = blocked_logsumexp(uvec, ivec, _logits)
        asked = uvec.join(norms, "user_idx").select("user_idx", F.concat("uvec", F.array("lse")).alias("uvec"))
        return blocked_topk(asked, ivec, k, _exp_price, self._seen(log, filter_seen_items))


class SequenceAttentionRecommender(_SequenceRecommender):
    """The newest item asks, the last L items answer; price-weighted pairwise loss.

    The state is the softmax-weighted mean of the last L vectors, weights from the inner
    product with the newest one. The gradient runs through values, keys and query.
    """

    def __init__(self, dim: int = 128, max_len: int = 50, lr: float = 5e-4, weight_decay: float = 1e-4, epochs: int = 15,
                 patience: int = 3, price_exp: float = 1.0, time: list[str] | None = None, seed: int = 42, chunk: int = CHUNK):
        super().__init__(dim, max_len, lr, weight_decay, epochs, time, seed, chunk)
        self.patience, self.price_exp = patience, price_exp

    def _base(self, log, item_features):
        """Rows with an unseen negative and the price of their item, relative to the highest."""
        base = cut(with_row_id(super()._base(log, item_features)))
        slots = cut(sampling.numbered_items(base))
        drawn = sampling.negative_sample_unseen(base, ["row_id"], base, slots, seed=self.seed)
        rows = base.join(drawn.select("row_id", F.col("neg_idx").alias("negs")), "row_id").drop("row_id")
        self.log_prices = cut(first_price_per_item(price_from_items(log, item_features), self.time))
        top = self.log_prices.agg(F.max("price")).first()[0] or 1.0
        priced = rows.join(self.log_prices, "item_idx", "left")
        return priced.withColumn("weights", F.coalesce("price", F.lit(1.0)) / F.lit(float(top))).drop("price")

    def fit(self, log, user_features=None, item_features=None):
        self._pack(log, item_features, ["negs", "weights"])
        state = self._start()
        best, stall = float("inf"), 0
        for epoch in range(self.epochs):
            state = self._epoch(state, epoch + 1)
            if self.losses[-1] < best - 1e-5:
                best, stall = self.losses[-1], 0
            else:
                stall += 1
            if stall >= self.patience:
                break
        self.state = state
        self.history = log
        return self

    def _gradient(self, emb):
        return attention_gradient(self.chunks, self.links, emb, self.dim, self.max_len, self.n_rows)

    def _attend(self, listed: str):
        """(weights over the list, state) for a list of vectors, oldest first."""
        scale = 1.0 / math.sqrt(self.dim)
        query = F.element_at(listed, -1)
        logits = F.transform(listed, lambda v: dot(v, query) * scale)
        return logits

    def _mix(self, df: DataFrame, listed: str) -> DataFrame:
        """Adds ``__w`` (weights) and ``__h`` (state) for rows with a non-empty list."""
        d = self.dim
        df = df.withColumn("__l", self._attend(listed))
        df = df.withColumn("__x", F.transform("__l", lambda x: F.exp(x - F.array_max("__l"))))
        total = F.aggregate("__x", F.lit(0.0), lambda s, x: s + x)
        df = df.withColumn("__total", total).withColumn("__w", F.transform("__x", lambda x: x / F.col("__total")))
        paired = F.arrays_zip(F.col("__w").alias("w"), F.col(listed).alias("v"))
        state = F.aggregate(
            paired,
            F.array_repeat(F.lit(0.0), d),
            lambda s, p: F.zip_with(s, p["v"], lambda a, b: a + p["w"] * b),
        )
        return df.withColumn("__h", state).drop("__l", "__x", "__total")

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        newest = self._newest(self.history if log is None else log, users)
        vec = self.state.select(F.col("node").alias("item_idx"), to_array(self.dim).alias("v"))
        ordered = F.array_sort(
            F.collect_list(F.struct((-F.col("recency")).alias("at"), F.col("v")))
        )
        lists = newest.join(vec, "item_idx").groupBy("user_idx").agg(F.transform(ordered, lambda r: r["v"]).alias("__vs"))
        states = self._mix(lists, "__vs").select("user_idx", F.col("__h").alias("uvec"))
        prices = self.log_prices
        if item_features is not None and "price" in item_features.columns:
            prices = item_features.select("item_idx", "price")
        ivec = self._items(items, prices)
        asked = self._with_cold(states, users)
        return blocked_topk(asked, ivec, k, _sigmoid_price(self.price_exp), self._seen(log, filter_seen_items))


def _clip(grad: DataFrame, d: int, limit: float) -> DataFrame:
    """Scale the whole gradient down if its norm is above the limit."""
    squares = sum((F.col(c) * F.col(c) for c in names(d)), F.lit(0.0))
    size = F.sqrt(grad.select(F.sum(squares)).scalar())
    factor = F.when(size > limit, limit / size).otherwise(1.0)
    return grad.withColumns({c: F.col(c) * factor for c in names(d)})
