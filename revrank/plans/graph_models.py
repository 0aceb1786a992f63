"""Recommenders on the user-item graph: light convolution, convolution, attention.

All share one loop. Light propagation is linear with a symmetric matrix P, so the gradient of the
loss in the start vectors is P applied to the gradient in the final vectors: the backward pass
is the same join-and-sum as the forward pass. The layered models go back layer by layer in the
same way and collect the gradients of their matrices and coefficients, a fixed number of values.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrank.functions.scores import bpr_term, log_sigmoid, sigmoid
from revrank.functions.vectors import dot_wide, names, to_array
from revrank.operators import graph, sampling
from revrank.operators.blocked import blocked_topk
from revrank.operators.evaluate import dcg_revenue, fill_missing_price, relative_log_price
from revrank.operators.joins import exclude_seen
from revrank.plans.base import Recommender
from revrank.plans.training import DenseAdam, adam_step, gather, glorot, start_state, sum_gradients, unit_rows, xavier
from revrank.session import cut

VALIDATION_K = 20


class _GraphRecommender(Recommender):
    """Set-up, sampling, steps and serving; subclasses say how to propagate and what the loss is."""

    self_loops = False
    decoupled = True
    normalize = False

    def __init__(self, n_epochs: int, dim: int, lr: float, weight_decay: float, seed: int, post_filter: bool = False):
        super().__init__(seed)
        self.n_epochs, self.dim, self.lr, self.weight_decay = n_epochs, dim, lr, weight_decay
        self.post_filter = post_filter
        self.losses: list[float] = []

    # -- what subclasses define ----------------------------------------------------

    def _edges(self, directed: DataFrame) -> DataFrame:
        edges, _ = graph.normalized_edges(directed, self_loops=self.self_loops, nodes=self.nodes)
        return edges

    def _forward(self, emb: DataFrame, edges: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _backward(self, grad: DataFrame, edges: DataFrame) -> DataFrame:
        """Gradient in the start vectors; the symmetric case is the forward pass."""
        return self._forward(grad, edges)

    def _push(self, n: int) -> tuple[Column, Column, Column]:
        """(loss of a row, d loss / d pos logit, d loss / d neg logit), already divided by n."""
        raise NotImplementedError

    reg_lambda = 0.0

    # -- the loop --------------------------------------------------------------------

    def _set_up(self, log: DataFrame, user_features: DataFrame | None, item_features: DataFrame | None) -> None:
        users = (log if user_features is None else user_features).select("user_idx")
        items = (log if item_features is None else item_features).select("item_idx")
        self.n_users = users.agg(F.max("user_idx")).first()[0] + 1
        self.n_items = items.agg(F.max("item_idx")).first()[0] + 1
        edges = sampling.distinct_edges(log)
        self.edges = cut(self._known(edges))
        if self.edges.isEmpty():
            raise ValueError("empty log")
        directed = graph.bidirectional_edges(self.edges, self.n_users)
        counted = graph.node_copies(directed)
        every = users.select(F.col("user_idx").alias("node")).unionByName(
            items.select((F.col("item_idx") + F.lit(self.n_users)).alias("node"))
        )
        everyone = every.distinct().join(counted.select("node", "copies"), "node", "left")
        self.nodes = cut(everyone.select("node", F.coalesce("copies", F.lit(1)).alias("copies")))
        self.slots = cut(sampling.numbered_items(items))
        self.prices = self._item_prices(item_features, items)

    def _known(self, edges: DataFrame) -> DataFrame:
        return edges.filter((F.col("user_idx") < self.n_users) & (F.col("item_idx") < self.n_items))

    @staticmethod
    def _item_prices(item_features: DataFrame | None, items: DataFrame) -> DataFrame:
        """Price, price relative to the mean log price, and loss weight per item."""
        if item_features is not None and "price" in item_features.columns:
            priced = fill_missing_price(item_features.select("item_idx", "price"))
        else:
            priced = items.distinct().withColumn("price", F.lit(1.0))
        return cut(relative_log_price(priced))

    def _samples(self, train: DataFrame, epoch: int) -> DataFrame:
        """Positive edge, one negative, both as nodes, with the copy numbers of hot nodes."""
        drawn = self._negatives(train, epoch)
        weighted = drawn.join(self.prices.select("item_idx", "loss_weight"), "item_idx", "left").withColumn(
            "loss_weight", F.coalesce("loss_weight", F.lit(1.0))
        )
        rows = weighted.select(
            F.col("user_idx").alias("u"), (F.col("item_idx") + F.lit(self.n_users)).alias("i"),
            (F.col("neg_idx") + F.lit(self.n_users)).alias("n"), "loss_weight",
        )
        rows = graph.spread(rows, self.nodes, "u", "i", "ucopy")
        return graph.spread(rows, self.nodes, "i", "u", "icopy")

    def _negatives(self, train: DataFrame, epoch: int) -> DataFrame:
        size = self.slots.agg(F.count("*")).first()[0]
        drawn = sampling.negative_sample_uniform(train, size, epoch, self.seed).withColumnRenamed("neg_idx", "slot")
        return drawn.join(self.slots.withColumnRenamed("item_idx", "neg_idx"), "slot").drop("slot")

    def _gradients(self, final: DataFrame, samples: DataFrame, n: int) -> DataFrame:
        """(node, copies, gradient in the final vectors, loss)."""
        d = self.dim
        rows = gather(samples, final, "u", "a", d, "ucopy")
        rows = gather(rows, final, "i", "b", d, "icopy")
        rows = gather(rows, final, "n", "c", d)
        rows = rows.withColumns({"pos": dot_wide("a", "b", d), "neg": dot_wide("a", "c", d)})
        loss, up, down = self._push(n)
        rows = rows.withColumns({"__loss": loss, "__gp": up, "__gn": down})
        reg = self.reg_lambda / n
        gp, gn = F.col("__gp"), F.col("__gn")
        grad = sum_gradients(
            rows,
            [
                ("u", lambda j: gp * F.col(f"b{j}") + gn * F.col(f"c{j}") + reg * F.col(f"a{j}")),
                ("i", lambda j: gp * F.col(f"a{j}") + reg * F.col(f"b{j}")),
                ("n", lambda j: gn * F.col(f"a{j}") + reg * F.col(f"c{j}")),
            ],
            F.col("__loss"),
            d,
        )
        return grad.join(self.nodes, "node")

    def _epoch(self, state: DataFrame, edges: DataFrame, samples: DataFrame, n: int, step: int) -> DataFrame:
        final = cut(self._forward(state.select("node", "copies", *names(self.dim)), edges))
        grad = cut(self._gradients(final, samples, n))
        self.losses.append(grad.agg(F.sum("loss")).first()[0])
        back = self._backward(grad.drop("loss"), edges)
        state = adam_step(state, back, self.dim, step, self.lr, self.weight_decay, self.decoupled)
        return cut(unit_rows(state, self.dim) if self.normalize else state)

    def fit(self, log, user_features=None, item_features=None):
        self._set_up(log, user_features, item_features)
        edges = cut(self._edges(graph.bidirectional_edges(self.edges, self.n_users)))
        n = self.edges.count()
        state = cut(start_state(self.nodes, self.dim, self.seed, xavier(self.n_users + self.n_items, self.dim) * 4))
        for epoch in range(self.n_epochs):
            state = self._epoch(state, edges, self._samples(self.edges, epoch), n, epoch + 1)
        self.final = cut(self._forward(state.select("node", "copies", *names(self.dim)), edges))
        return self

    # -- serving ------------------------------------------------------------------------

    def _vectors(self, users: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
        vec = self.final.select("node", to_array(self.dim).alias("v"))
        uvec = users.select("user_idx").join(
            vec.select(F.col("node").alias("user_idx"), F.col("v").alias("uvec")), "user_idx"
        )
        ivec = (
            items.select("item_idx", (F.col("item_idx") + F.lit(self.n_users)).alias("node"))
            .join(vec, "node")
            .join(self.prices.select("item_idx", "rel_price"), "item_idx", "left")
        )
        price = F.array(F.coalesce("rel_price", F.lit(1.0)))
        return uvec.filter(F.col("user_idx") < self.n_users), ivec.select("item_idx", F.concat("v", price).alias("ivec"))

    def _scorer(self):
        return _plain_scores

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        uvec, ivec = self._vectors(users, items)
        seen = self._seen(log, filter_seen_items)
        if self.post_filter:
            return exclude_seen(blocked_topk(uvec, ivec, k, self._scorer()), log, filter_seen_items)
        return blocked_topk(uvec, ivec, k, self._scorer(), seen)


def _plain_scores(u: np.ndarray, i: np.ndarray) -> np.ndarray:
    return u @ i[:, :-1].T


def _price_scores(power: float):
    def score(u: np.ndarray, i: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(u @ i[:, :-1].T))) * i[:, -1][None, :] ** power

    return score


class LightGCNRecommender(_GraphRecommender):
    """Light convolution, price-weighted pairwise loss, edge dropout, unit rows, early stopping.

    Validation edges are kept out of the graph and scored by revenue DCG of the top 20.
    """

    normalize = True

    def __init__(self, n_epochs: int = 30, dim: int = 128, n_layers: int = 2, lr: float = 8e-4, reg_lambda: float = 8e-4,
                 edge_dropout: float = 0.5, patience: int = 8, price_exp: float = 0.6, root_price_loss: bool = True,
                 validation: float = 0.1, seed: int = 42):
        super().__init__(n_epochs, dim, lr, 5e-3, seed)
        self.n_layers, self.reg_lambda, self.edge_dropout = n_layers, reg_lambda, edge_dropout
        self.patience, self.price_exp, self.root_price_loss = patience, price_exp, root_price_loss
        self.validation = validation
        self.scores: list[float] = []

    def _forward(self, emb, edges):
        return graph.lightgcn_propagate(emb, edges, self.nodes, self.dim, self.n_layers)

    def _push(self, n):
        w = F.col("loss_weight") if self.root_price_loss else F.col("loss_weight") * F.col("loss_weight")
        slope = w * sigmoid(F.col("neg") - F.col("pos")) / n
        return bpr_term("pos", "neg", w) / n, -slope, slope

    def _scorer(self):
        return _price_scores(self.price_exp)

    def _validate(self, state: DataFrame, edges: DataFrame, held: DataFrame) -> float:
        self.final = cut(self._forward(state.select("node", "copies", *names(self.dim)), edges))
        uvec, ivec = self._vectors(held.select("user_idx").distinct(), self.prices)
        best = blocked_topk(uvec, ivec, VALIDATION_K, self._scorer())
        return dcg_revenue(best, held, self.prices.select("item_idx", F.col("rel_price").alias("price"))).first()[0] or 0.0

    def fit(self, log, user_features=None, item_features=None):
        self._set_up(log, user_features, item_features)
        marked = cut(sampling.holdout_split(self.edges, self.validation, self.seed))
        train = marked.filter(~F.col("is_val")).drop("is_val")
        held = marked.filter("is_val").drop("is_val")
        whole = cut(self._edges(graph.bidirectional_edges(train, self.n_users)))
        n = train.count()
        state = cut(start_state(self.nodes, self.dim, self.seed, xavier(self.n_users + self.n_items, self.dim)))
        best, best_state, stall = -1.0, state, 0
        for epoch in range(self.n_epochs):
            kept = sampling.edge_dropout(train, self.edge_dropout, epoch, self.seed)
            edges = cut(self._edges(graph.bidirectional_edges(kept, self.n_users)))
            state = self._epoch(state, edges, self._samples(train, epoch), n, epoch + 1)
            score = self._validate(state, whole, held)
            self.scores.append(score)
            if score > best + 1e-5:
                best, best_state, stall = score, state, 0
            else:
                stall += 1
            if stall >= self.patience:
                break
        self.final = cut(self._forward(best_state.select("node", "copies", *names(self.dim)), whole))
        return self

    def refresh(self, log, user_features=None, item_features=None):
        """The lighter refit on a new slice: 3 epochs, half the step, no dropout."""
        light = LightGCNRecommender(3, self.dim, self.n_layers, 4e-4, 8e-4, 0.0, self.patience, self.price_exp,
                                    self.root_price_loss, self.validation, self.seed)
        return light.fit(log, user_features, item_features)


class _CrossEntropy(_GraphRecommender):
    """Edges against as many non-edges, logistic loss on both."""

    decoupled = False

    def _negatives(self, train, epoch):
        return sampling.negative_sample_unseen(
            train, ["user_idx", "item_idx"], self.edges, self.slots, seed=self.seed + epoch
        )

    def _push(self, n):
        loss = -(log_sigmoid("pos") + log_sigmoid(-F.col("neg"))) / n
        return loss, (sigmoid("pos") - 1.0) / n, sigmoid("neg") / n


class _Layered(_CrossEntropy):
    """Layers with trained parameters. A forward pass keeps what the backward pass needs."""

    def _parameters(self) -> list[np.ndarray]:
        """Start values, drawn from the seed."""
        raise NotImplementedError

    def _set_up(self, log, user_features, item_features):
        super()._set_up(log, user_features, item_features)
        self.parameters = self._parameters()
        self._adam = DenseAdam(self.lr, self.weight_decay)

    def _epoch(self, state, edges, samples, n, step):
        state = super()._epoch(state, edges, samples, n, step)
        self.parameters = self._adam.step(self.parameters, self.gradients)
        return state


class GCNRecommender(_Layered):
    """Linear convolution with self loops; every layer has a matrix and a bias."""

    self_loops = True

    def __init__(self, embedding_dim: int = 128, num_layers: int = 4, l2_lambda: float = 0.02, lr: float = 0.01,
                 n_epochs: int = 100, post_filter: bool = False, seed: int = 42):
        super().__init__(n_epochs, embedding_dim, lr, l2_lambda, seed, post_filter)
        self.num_layers = num_layers

    def _parameters(self):
        rng, d = np.random.default_rng(self.seed), self.dim
        return [x for _ in range(self.num_layers) for x in (glorot(rng, d, d), np.zeros(d))]

    def _forward(self, emb, edges):
        self._sums = []
        for layer in range(self.num_layers):
            hop = cut(graph.gcn_propagate(emb, edges, self.nodes, self.dim, 1))
            self._sums.append(hop)
            emb = graph.times_matrix(hop, self.parameters[2 * layer], self.parameters[2 * layer + 1])
        return emb

    def _backward(self, grad, edges):
        found: list[np.ndarray] = []
        for layer in reversed(range(self.num_layers)):
            grad = cut(grad)
            rows = graph.outer_sums(self._sums[layer], grad, self.dim).orderBy("k").collect()
            bias = grad.agg(*[F.sum(c) for c in names(self.dim)]).first()
            found = [np.array([r[1:] for r in rows], float), np.array(bias, float), *found]
            grad = graph.gcn_layer_back(grad, edges, self.nodes, self.dim, self.parameters[2 * layer])
        self.gradients = found
        return grad


class GATRecommender(_Layered):
    """Two attention layers (``heads`` heads and ELU, then one head) with trained matrices and score coefficients."""

    reg_lambda = 1e-6

    def __init__(self, embedding_dim: int = 128, heads: int = 4, l2_lambda: float = 0.01, lr: float = 0.01,
                 n_epochs: int = 20, post_filter: bool = False, seed: int = 42):
        if embedding_dim % heads:
            raise ValueError("embedding_dim must be a multiple of heads")
        super().__init__(n_epochs, embedding_dim, lr, l2_lambda, seed, post_filter)
        self.heads = heads

    def _parameters(self):
        rng, d = np.random.default_rng(self.seed), self.dim
        sizes = (d // self.heads, d)
        return [x for size in sizes for x in (glorot(rng, d, d), *(rng.uniform(-1, 1, d) * xavier(size, 1) for _ in range(2)))]

    def _edges(self, directed):
        base = directed.select("src", "dst")
        every = self.nodes.select(F.col("node").alias("src"), F.col("node").alias("dst"))
        out = graph.spread(base.unionByName(every), self.nodes, "src", "dst")
        return graph.spread(out, self.nodes, "dst", "src", "dcopy")

    def _forward(self, emb, edges):
        d, self._layers = self.dim, []
        for layer, heads in enumerate((self.heads, 1)):
            w, left, right = self.parameters[3 * layer : 3 * layer + 3]
            x = cut(graph.times_matrix(emb, w))
            weights = cut(graph.attention_weights(edges, x, d, heads, left, right))
            out = cut(graph.attend(weights, x, self.nodes, d, heads))
            self._layers.append((emb, x, weights, out))
            emb = out.withColumns({c: graph.elu(F.col(c)) for c in names(d)}) if layer == 0 else out
        return emb

    def _backward(self, grad, edges):
        d, found = self.dim, []
        for layer, heads in ((1, 1), (0, self.heads)):
            w, left, right = self.parameters[3 * layer : 3 * layer + 3]
            emb, x, weights, out = self._layers[layer]
            if layer == 0:
                raw = out.select("node", *[F.col(f"e{j}").alias(f"r{j}") for j in range(d)])
                slope = {f"e{j}": F.col(f"e{j}") * F.when(F.col(f"r{j}") > 0, 1.0).otherwise(F.exp(F.least(f"r{j}", F.lit(0.0)))) for j in range(d)}
                grad = grad.join(raw, "node").withColumns(slope).select("node", "copies", *names(d))
            back = cut(graph.attention_back(weights, x, out, grad, d, heads, left, right))
            coefs = np.array(graph.coefficient_gradients(back, x, d, heads).first(), float)
            inner = back.select("node", *names(d)).join(self.nodes, "node")
            rows = graph.outer_sums(emb, inner, d).orderBy("k").collect()
            found = [np.array([r[1:] for r in rows], float), coefs[:d], coefs[d:], *found]
            grad = graph.times_matrix(inner, w.T)
        self.gradients = found
        return grad
