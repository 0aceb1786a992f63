"""Trees over tables that are small enough to be handed to every task.

Where a table packs into at most ``PACKED_BYTES`` (one byte a feature and row), it is brought to the tasks as one array of
bin numbers, and a task grows whole trees, level by level, from sums per node and bin. Numbers are cut into at most
``BINS`` bins at quantiles, as MLlib does. Larger tables take the plans that shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrank.operators.lambdas import list_sums

PACKED_BYTES = 64 << 20
BINS = 32
# Features beyond which rows are not packed.
MOST_FEATURES = 512
MISSING = 255
# Values of a feature a partition keeps for its quantiles, and bins of all nodes that are summed at once.
POINTS = 4096
SUMS = 1 << 22
# Sums over trees are made in whole numbers of 2^-UNIT_BITS, so that they do not depend on the order.
UNIT_BITS = 40
# Cells of one user's table of scores, and columns of numbers in it.
CELLS, GRID_COLUMNS = 1 << 14, 3


def fits(n: int, width: int, others: int) -> bool:
    """Do ``n`` rows of ``width`` features and ``others`` numbers of eight bytes pack?"""
    return width <= MOST_FEATURES and n * (width + 8 * others) <= PACKED_BYTES


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """One row for each list; a null is not a number."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if column.null_count or len(flat) != len(column) * width:
        raise ValueError(f"a row has not {width} features")
    return flat.reshape(len(column), width)


def _condensed(values: np.ndarray, counts: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values and their counts, at most ``points`` of them at even steps of the count."""
    known, place = np.unique(values, return_inverse=True)
    total = np.bincount(place, counts, len(known))
    if len(known) <= max(points, 1):
        return known, total
    upto = np.cumsum(total)
    kept = np.unique(np.minimum(np.searchsorted(upto, np.linspace(0, upto[-1], points + 1)[1:]), len(known) - 1))
    return known[kept], np.diff(upto[kept], prepend=0)


def cut_points(values: np.ndarray, counts: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Ascending thresholds: between all values where there are at most ``bins``, else at quantiles."""
    known, total = _condensed(values, counts, max(len(values), 1))
    at = np.arange(len(known) - 1)
    if len(known) > bins:
        upto = np.cumsum(total)
        at = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, bins) / bins))
        at = at[at < len(known) - 1]
    low, high = known[at], known[at + 1]
    middle = low + (high - low) / 2
    return np.where(middle < high, middle, low)


def bin_edges(rows: DataFrame, x: str, width: int) -> list[np.ndarray]:
    """``cut_points`` of each place of the array column ``x``, from all rows."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0), np.zeros(0))] * width
        for batch in batches:
            m = _matrix(batch.column(0), width)
            held = [
                _condensed(np.concatenate((v, x)), np.concatenate((n, np.ones(len(x)))), POINTS)
                for (v, n), x in zip(held, (col[~np.isnan(col)] for col in m.T))
            ]
        yield pa.RecordBatch.from_pydict(
            {"feature": np.arange(width), "v": [v for v, _ in held], "n": [n for _, n in held]}
        )

    def merge(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        values, counts = (np.concatenate([np.asarray(v, np.float64) for v in parts[c]]) for c in "vn")
        return pd.DataFrame({"feature": [key[0]], "edges": [cut_points(values, counts)]})

    parts = rows.select(x).mapInArrow(sketch, "feature bigint, v array<double>, n array<double>")
    found = parts.groupBy("feature").applyInPandas(merge, "feature bigint, edges array<double>")
    edges = {r["feature"]: np.array(r["edges"], np.float64) for r in found.collect()}
    return [edges.get(c, np.zeros(0)) for c in range(width)]


def bin_numbers(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Number of a row's bin: how many thresholds its value is above; ``MISSING`` without a value, which goes high everywhere."""
    out = np.empty(x.shape, np.uint8)
    for c, e in enumerate(edges):
        out[:, c] = np.where(np.isnan(x[:, c]), MISSING, np.searchsorted(e, x[:, c], side="left"))
    return out


def packed_rows(rows: DataFrame, x: str, edges: list[np.ndarray], others: list[str]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Bin numbers of ``x`` and the columns ``others`` (double or bigint) on the driver, in the order of the partitions."""
    kinds = {c: "<i8" if dict(rows.dtypes)[c] == "bigint" else "<f8" for c in others}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out = {"x": [bin_numbers(_matrix(batch.column(0), len(edges)), edges).tobytes()]}
            for n, c in enumerate(others):
                out[c] = [batch.column(n + 1).to_numpy(zero_copy_only=False).astype(kinds[c]).tobytes()]
            yield pa.RecordBatch.from_pydict(out)

    made = rows.select(x, *others).mapInArrow(run, ", ".join(["x binary", *[f"`{c}` binary" for c in others]])).collect()
    codes = np.concatenate([np.zeros((0, len(edges)), np.uint8), *[np.frombuffer(r["x"], np.uint8).reshape(-1, len(edges)) for r in made]])
    return codes, {c: np.concatenate([np.zeros(0, kinds[c]), *[np.frombuffer(r[c], kinds[c]) for r in made]]) for c in others}


@dataclass(frozen=True)
class BinTree:
    """Nodes level by level: feature (-1: a leaf), last bin that goes low, low child (the high one follows), mean."""

    feature: np.ndarray
    split: np.ndarray
    low: np.ndarray
    value: np.ndarray

    def places(self, codes: np.ndarray, depth: int) -> Iterator[np.ndarray]:
        """The node of each row after 0, 1 .. ``depth`` steps."""
        at = np.zeros(len(codes), np.int64)
        yield at
        going = np.flatnonzero(self.feature[at] >= 0)
        for _ in range(depth):
            if len(going):
                now = at[going]
                at[going] = self.low[now] + (codes[going, self.feature[now]] > self.split[now])
                going = going[self.feature[at[going]] >= 0]
            yield at


def grow(
    codes: np.ndarray, w: np.ndarray, wy: np.ndarray, n: np.ndarray, draw: Callable[[int], np.ndarray],
    depth: int, least: int, binary: bool = False,
) -> BinTree:
    """The tree whose splits lower the squared error of y most, over rows that are drawn ``n`` times.

    ``w`` is a row's weight and ``wy`` weight times y, both times ``n`` already. ``draw(nodes)`` gives the features a
    level may split on: one row for each node, or one list for all. A side of a split has ``least`` drawn rows at least.
    ``binary``: y is 0 or 1, so nodes of one label are leaves. A tree of less depth is the same tree cut off.
    """
    rows = np.flatnonzero(n)
    w, wy, n = w[rows].astype(np.float64), wy[rows].astype(np.float64), n[rows].astype(np.float64)
    at, base, size, levels = np.zeros(len(rows), np.int64), 0, 1, []
    for level in range(depth + 1):
        total_w, total_y, total_n = (np.bincount(at, v, size) for v in (w, wy, n))
        value = np.divide(total_y, total_w, out=np.zeros(size), where=total_w > 0)
        feature, split, low = np.full(size, -1, np.int32), np.zeros(size, np.uint8), np.full(size, -1, np.int32)
        levels.append((feature, split, low, value))
        if level == depth:
            break
        open_ = (total_n >= 2 * least) & (total_w > 0)
        if binary:
            open_ &= (value > 1e-12) & (value < 1 - 1e-12)
        if not open_.any():
            break
        number = np.cumsum(open_) - 1
        here = open_[at]
        rows, w, wy, n, at = rows[here], w[here], wy[here], n[here], number[at[here]]
        total_w, total_y, total_n = total_w[open_], total_y[open_], total_n[open_]
        best, best_split = _best_splits(codes, rows, at, w, wy, n, total_w, total_y, total_n, draw(len(total_w)), least)
        cut = best >= 0
        if not cut.any():
            break
        nodes = np.flatnonzero(open_)[cut]
        feature[nodes], split[nodes] = best[cut], best_split[cut]
        low[nodes] = base + size + 2 * np.arange(len(nodes))
        here = cut[at]
        rows, w, wy, n, at = rows[here], w[here], wy[here], n[here], at[here]
        above = codes[rows, best[at]] > best_split[at]
        at = 2 * (np.cumsum(cut) - 1)[at] + above
        base, size = base + size, 2 * len(nodes)
    return BinTree(*[np.concatenate(part) for part in zip(*levels)])


def _best_splits(codes, rows, at, w, wy, n, total_w, total_y, total_n, drawn, least) -> tuple[np.ndarray, np.ndarray]:
    """Feature (-1: none) and bin of each node's best split."""
    nodes = len(total_w)
    best_feature, best_split = np.full(nodes, -1, np.int32), np.zeros(nodes, np.uint8)
    before = total_y**2 / total_w
    best = before * 1e-12 + 1e-300
    step = max(1, SUMS // BINS)
    for start in range(0, nodes, step):
        end = min(start + step, nodes)
        some = slice(None) if nodes <= step else np.flatnonzero((at >= start) & (at < end))
        r, a, ws, ys, ns = rows[some], at[some] - start, w[some], wy[some], n[some]
        part, node = slice(start, end), np.arange(end - start)
        tw, ty, tn = total_w[part, None], total_y[part, None], total_n[part, None]
        shared = drawn.ndim == 1
        for s in range(drawn.shape[-1]):
            feature = drawn[s] if shared else drawn[part, s]
            bins = codes[r, feature if shared else feature[a]]
            if bins.max() == MISSING:
                raise ValueError("a feature is null or not a number")
            key = a * BINS + bins
            cw, cy, cn = (
                np.bincount(key, v, BINS * len(node)).reshape(-1, BINS)[:, :-1].cumsum(axis=1) for v in (ws, ys, ns)
            )
            with np.errstate(all="ignore"):
                gain = cy**2 / cw + (ty - cy) ** 2 / (tw - cw) - before[part, None]
            gain[(cn < least) | (tn - cn < least) | ~np.isfinite(gain)] = 0.0
            found = gain.argmax(axis=1)
            gain = gain[node, found]
            better = gain > best[part]
            best[part] = np.where(better, gain, best[part])
            best_feature[part] = np.where(better, feature, best_feature[part])
            best_split[part] = np.where(better, found, best_split[part])
    return best_feature, best_split


@dataclass(frozen=True)
class Boosting:
    """Settings of ``boost``."""

    seed: int
    rounds: int
    patience: int
    depth: int
    least: int
    l2: float
    bagging: float
    features: list[list[int]]


@dataclass(frozen=True)
class PackedLists:
    """Rows that lie user after user: bin numbers, label, price, held out or not, and the rows of each user."""

    codes: np.ndarray
    label: np.ndarray
    price: np.ndarray
    held: np.ndarray
    sizes: np.ndarray

    def part(self, held: bool) -> PackedLists:
        own = self.held == held
        ends = np.cumsum(self.sizes)
        users = own[ends - self.sizes] if len(own) else np.zeros(0, bool)
        return PackedLists(np.asfortranarray(self.codes[own]), self.label[own], self.price[own], self.held[own], self.sizes[users])


def mean_ndcg(label: np.ndarray, score: np.ndarray, sizes: np.ndarray, k: int = 10) -> float:
    """Mean NDCG of users with a positive; ties go to the earlier row."""
    user = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((-score, user))
    rank = np.arange(len(user)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    top = rank < k
    got = np.bincount(user[top], label[order][top] / np.log2(rank[top] + 2.0), len(sizes))
    ideal = np.concatenate(([0.0], np.cumsum(1.0 / np.log2(np.arange(k) + 2.0))))
    best = ideal[np.minimum(np.bincount(user, label, len(sizes)).astype(np.int64), k)]
    return float((got[best > 0] / best[best > 0]).mean()) if (best > 0).any() else 0.0


def boost(lists: PackedLists, price_pow: float, learning_rate: float, how: Boosting) -> tuple[list[BinTree], np.ndarray]:
    """Boosted trees on lambda gradients with Newton leaves, and the scores they give all rows.

    A round draws a share of the rows and the features, and the tree is grown on lambda / curvature, weighted by
    curvature and price^price_pow. Rounds end when NDCG of the held-out users has not risen for ``patience`` rounds.
    """
    train, other = lists.part(False), lists.part(True)
    weight = np.where(np.isnan(train.price), 0.0, train.price) ** price_pow
    stops = how.patience < how.rounds
    scores = [np.zeros(len(train.label)), np.zeros(len(other.label))]
    trees, best, best_at, kept = [], -1.0, 0, None
    for done in range(1, how.rounds + 1):
        slope, bend = list_sums(train.label, scores[0], train.sizes)
        drawn = (bend > 1e-12) & (np.random.default_rng([how.seed, done, 1]).random(len(bend)) < how.bagging)
        if not drawn.any():
            break
        w, wy = bend * weight, slope * weight
        some = np.array(how.features[done - 1])
        tree = grow(train.codes, w, wy, drawn, lambda nodes: some, how.depth, how.least)
        *_, leaf = tree.places(train.codes, how.depth)
        top, below = (np.bincount(leaf[drawn], v[drawn], len(tree.value)) for v in (wy, w))
        below = below + how.l2
        tree = BinTree(tree.feature, tree.split, tree.low, np.divide(top, below, out=np.zeros(len(top)), where=below > 0))
        scores[0] = scores[0] + tree.value[leaf] * learning_rate
        *_, leaf = tree.places(other.codes, how.depth)
        scores[1] = scores[1] + tree.value[leaf] * learning_rate
        trees.append(tree)
        if stops:
            now = mean_ndcg(other.label, scores[1], other.sizes)
            if now > best:
                best, best_at, kept = now, len(trees), list(scores)
            elif len(trees) - best_at >= how.patience:
                break
    if best_at:
        trees, scores = trees[:best_at], kept
    score = np.zeros(len(lists.label))
    score[~lists.held], score[lists.held] = scores
    return trees, score


@dataclass(frozen=True)
class FlatTree:
    """A fitted tree as arrays of nodes; leaves have feature -1. ``root``, ``low`` and ``high`` are made when asked for."""

    width: int
    feature: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    above: np.ndarray
    node_value: np.ndarray

    @staticmethod
    def of_bins(tree: BinTree, edges: list[np.ndarray]) -> FlatTree:
        inner = tree.feature >= 0
        threshold = np.zeros(len(inner))
        threshold[inner] = [edges[f][b] for f, b in zip(tree.feature[inner], tree.split[inner])]
        return FlatTree(len(edges), tree.feature, threshold, tree.low, np.where(inner, tree.low + 1, -1), tree.value)

    @staticmethod
    def of_node(root, width: int) -> FlatTree:
        """From nested (feature, threshold, node if <=, node if >), parents before children."""
        nodes, place = [root], 0
        feature, threshold, below, above, value = [], [], [], [], []
        while place < len(nodes):
            node = nodes[place]
            place += 1
            leaf = isinstance(node, float)
            feature.append(-1 if leaf else node[0])
            threshold.append(0.0 if leaf else node[1])
            value.append(node if leaf else 0.0)
            below.append(-1 if leaf else len(nodes))
            above.append(-1 if leaf else len(nodes) + 1)
            if not leaf:
                nodes += [node[2], node[3]]
        ints = (np.array(v, np.int32) for v in (below, above))
        return FlatTree(width, np.array(feature, np.int32), np.array(threshold), *ints, np.array(value))

    def renumbered(self, place: dict[int, int]) -> FlatTree:
        """The same tree with feature n called place[n]."""
        feature = np.array([place[f] if f >= 0 else -1 for f in self.feature], np.int32)
        return FlatTree(len(place), feature, self.threshold, self.below, self.above, self.node_value)

    @cached_property
    def root(self):
        nodes: list = [None] * len(self.feature)
        for n in reversed(range(len(nodes))):
            f = int(self.feature[n])
            nodes[n] = float(self.node_value[n]) if f < 0 else (
                f, float(self.threshold[n]), nodes[self.below[n]], nodes[self.above[n]]
            )
        return nodes[0]

    @cached_property
    def _boxes(self) -> tuple[np.ndarray, np.ndarray]:
        low = np.full((len(self.feature), self.width), -np.inf)
        high = np.full((len(self.feature), self.width), np.inf)
        for n in np.flatnonzero(self.feature >= 0):
            f, t, b, a = self.feature[n], self.threshold[n], self.below[n], self.above[n]
            low[[b, a]], high[[b, a]] = low[n], high[n]
            high[b, f], low[a, f] = min(high[n, f], t), max(low[n, f], t)
        leaf = self.feature < 0
        return low[leaf], high[leaf]

    @property
    def low(self) -> np.ndarray:
        return self._boxes[0]

    @property
    def high(self) -> np.ndarray:
        return self._boxes[1]

    @property
    def value(self) -> np.ndarray:
        return self.node_value[self.feature < 0]

    def column(self, names: list[str | Column]) -> Column:
        """The tree as one expression over feature columns."""

        def build(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            value = names[node[0]]
            value = F.col(value) if isinstance(value, str) else value
            return F.when(value <= F.lit(node[1]), build(node[2])).otherwise(build(node[3]))

        return build(self.root)


class ForestTable:
    """All leaves of a forest as boxes of bin numbers, for scores of blocks of users and items.

    A row's number in a column is how many of the forest's thresholds it is above. Which leaves a user reaches fixes
    a sum of item boxes; it is made once for each user as a table over all numbers an item can have, by differences
    at the corners of the boxes. Where that table would be too large, a tree's scores are a product of two 0/1 tables.
    A number that is missing passes no leaf of a tree that splits on its column.
    """

    def __init__(self, trees: list[FlatTree], n_user: int, n_item: int):
        self.n_user, self.n_item = n_user, n_item
        width = n_user + n_item
        inner = [t.feature >= 0 for t in trees]
        feature = np.concatenate([np.zeros(0, np.int32), *[t.feature[i] for t, i in zip(trees, inner)]])
        threshold = np.concatenate([np.zeros(0), *[t.threshold[i] for t, i in zip(trees, inner)]])
        self.cuts = [np.unique(threshold[feature == c]) for c in range(width)]
        los, his, values, self.starts = [], [], [], [0]
        for t, i in zip(trees, inner):
            lo = np.full((len(t.feature), width), -1, np.int16)
            hi = np.tile(np.array([len(c) for c in self.cuts], np.int16), (len(t.feature), 1))
            for c in set(range(width)) - set(t.feature[i].tolist()):
                hi[:, c] = np.iinfo(np.int16).max
            place = np.zeros(len(t.feature), np.int16)
            for c in set(t.feature[i].tolist()):
                mine = t.feature == c
                place[mine] = np.searchsorted(self.cuts[c], t.threshold[mine])
            now = np.array([0])
            while len(now := now[t.feature[now] >= 0]):
                # One level of the tree at a time.
                f, p, below, above = t.feature[now], place[now], t.below[now], t.above[now]
                for child in (below, above):
                    lo[child], hi[child] = lo[now], hi[now]
                hi[below, f] = np.minimum(hi[now, f], p)
                lo[above, f] = np.maximum(lo[now, f], p)
                now = np.concatenate((below, above))
            leaf = t.feature < 0
            los.append(lo[leaf])
            his.append(hi[leaf])
            values.append(np.rint(t.node_value[leaf] * 2.0**UNIT_BITS))
            self.starts.append(self.starts[-1] + int(leaf.sum()))
        self.lo = np.ascontiguousarray(np.concatenate(los).T)
        self.hi = np.ascontiguousarray(np.concatenate(his).T)
        self.value = np.concatenate(values)
        item_cuts = [len(c) for c in self.cuts[n_user:]]
        # Columns of more than one threshold span the table, those of one are levels of a text.
        self.wide = [c for c, k in enumerate(item_cuts) if k > 1]
        self.hot = [c for c, k in enumerate(item_cuts) if k == 1]
        self.shape = [item_cuts[c] + 2 for c in self.wide] + [len(self.hot) + 1]
        self.grid = len(self.wide) <= GRID_COLUMNS and int(np.prod(np.array([float(s) for s in self.shape]))) <= CELLS
        self._last: tuple = (None, None)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_last": (None, None)}

    def marks(self, x: np.ndarray, first: int) -> np.ndarray:
        """For columns ``first`` on: is the value above each threshold, and is it missing?"""
        parts = [np.zeros((len(x), 1), bool)]
        for c in range(x.shape[1]):
            parts += [x[:, c, None] > self.cuts[first + c], np.isnan(x[:, c, None])]
        return np.concatenate(parts, axis=1)

    def _numbers(self, x: np.ndarray, first: int) -> np.ndarray:
        out = np.zeros(x.shape, np.int16)
        for c in range(x.shape[1]):
            # A missing value is above all thresholds, by one more.
            out[:, c] = np.searchsorted(self.cuts[first + c], x[:, c], side="left") + np.isnan(x[:, c])
        return out

    def sums(self, u: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Sum of all trees for each pair of a user and an item row."""
        users, items = self._numbers(u, 0), self._numbers(i, self.n_user)
        hot = items[:, self.hot]
        if not self.grid or (hot > 1).any() or (hot.sum(axis=1) > 1).any():
            return self._products(users, items)
        if self._last[0] != users.tobytes():
            self._last = (users.tobytes(), self._tables(users))
        level = np.where(hot.any(axis=1), hot.argmax(axis=1) + 1, 0) if len(self.hot) else np.zeros(len(items), np.int64)
        place = np.ravel_multi_index([*[items[:, c] for c in self.wide], level], self.shape)
        return self._last[1][:, place] / 2.0**UNIT_BITS

    def _passes(self, x: np.ndarray, first: int, leaves: slice, columns=None) -> np.ndarray:
        """(rows, leaves): does the row pass the leaf's conditions?"""
        out = np.ones((len(x), leaves.stop - leaves.start), bool)
        for c in range(x.shape[1]) if columns is None else columns:
            lo, hi = self.lo[first + c, leaves], self.hi[first + c, leaves]
            out &= (x[:, c, None] > lo) & (x[:, c, None] <= hi)
        return out

    def _products(self, users: np.ndarray, items: np.ndarray) -> np.ndarray:
        total = np.zeros((len(users), len(items)))
        for start, end in zip(self.starts, self.starts[1:]):
            some = slice(start, end)
            one = self._passes(users, 0, some) * self.value[some]
            total += one @ self._passes(items, self.n_user, some).astype(np.float64).T
        return total / 2.0**UNIT_BITS

    def _tables(self, users: np.ndarray) -> np.ndarray:
        """(users, cells): sums for every combination of numbers an item can have."""
        levels = np.zeros((len(self.hot) + 1, self.n_item), np.int16)
        levels[np.arange(len(self.hot)) + 1, self.hot] = 1
        # One place more in each direction, for the differences behind the last number.
        padded = [s + 1 for s in self.shape[:-1]] + [self.shape[-1]]
        total = np.zeros((len(users), int(np.prod(padded))))
        step = max(1, SUMS // (4 * 2 ** len(self.wide) * padded[-1]))
        for start in range(0, len(self.value), step):
            some = slice(start, min(start + step, len(self.value)))
            corner, sign = np.zeros((some.stop - start, 1), np.int64), np.ones((1, 1))
            for c, size in zip(self.wide, padded):
                lo = self.lo[self.n_user + c, some].astype(np.int64) + 1
                hi = np.minimum(self.hi[self.n_user + c, some].astype(np.int64), size - 2) + 1
                # An empty box has no corners that differ.
                hi = np.maximum(hi, lo)
                corner = np.concatenate((corner * size + lo[:, None], corner * size + hi[:, None]), axis=1)
                sign = np.concatenate((sign, -sign), axis=1)
            open_ = self._passes(levels, self.n_user, some, self.hot).T
            weight = (self.value[some, None] * sign)[:, :, None] * open_[:, None, :]
            cell = corner[:, :, None] * padded[-1] + np.arange(padded[-1])
            weight, cell = weight.reshape(len(weight), -1), cell.reshape(len(cell), -1)
            for n, row in enumerate(users):
                on = np.flatnonzero(self._passes(row[None], 0, some)[0])
                total[n] += np.bincount(cell[on].ravel(), weight[on].ravel(), total.shape[1])
        total = total.reshape(len(users), *padded)
        for axis in range(1, len(padded)):
            total = total.cumsum(axis=axis)
        kept = total[(slice(None), *[slice(0, s) for s in self.shape])]
        return kept.reshape(len(users), -1)


def roc_area(score: np.ndarray, label: np.ndarray) -> float:
    """Area under the ROC curve; equal scores count half."""
    known, place = np.unique(score, return_inverse=True)
    good = np.bincount(place, label, len(known))
    bad = np.bincount(place, 1.0 - label, len(known))
    if not good.sum() or not bad.sum():
        return 1.0 if not bad.sum() else 0.0
    return float((good * (np.cumsum(bad) - bad / 2)).sum() / (good.sum() * bad.sum()))
