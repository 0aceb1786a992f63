"""Gradients of next-item models over packed histories.

A user's rows in time order are packed into chunks of bounded length; a chunk starts with
the rows before it that its windows can see. Packed once, chunks serve every epoch: the vectors of
a chunk's different items are brought to it by one join, the arithmetic is done on arrays in
the task, and what an item receives is summed in the chunk before it travels.

A row's number is ``chunk * ROWS + place``. Vector tables have ``node, copies, e0..``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.functions.vectors import to_array
from revrank.operators import positions
from revrank.operators.blocked import blocked_logsumexp, blocked_softmax_gradients
from revrank.operators.graph import fan_out, spread
from revrank.session import cores, cut

ROWS = 1 << 13
CHUNK = 2048
# An item table of at most so many bytes goes whole to every part of the chunks; a part has about so many log rows.
WHOLE_BYTES = 16 << 20
PART_ROWS = 200_000
# Log rows, and scores, worked on at once there. Scores up to SAFE need no shift before exp().
ROWS_AT_ONCE = 1 << 13
SCORES = 1 << 18
SAFE = 300.0
# Numbers (rows x history x dimension) worked on at once.
STEP = 1 << 22


def pack_histories(rows: DataFrame, time: list[str], max_len: int, extras: list[str], chunk: int = CHUNK) -> DataFrame:
    """(chunk, user_idx, items, own, one array per extra column), written.

    ``own`` is false for the up to ``max_len`` rows before the chunk's own ones.
    """
    if max_len > chunk or chunk + max_len > ROWS:
        raise ValueError("max_len must fit in a chunk")
    cut_up = positions.chunk_rows(rows, ["user_idx"], time, max_len, 0, hot_rows=chunk, chunk=chunk)
    fields = list(dict.fromkeys([*time, "item_idx", *extras, "__own"]))
    listed = cut_up.groupBy("user_idx", "__chunk").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("r"))
    arrays = [F.col(f"r.{c}").alias(c) for c in extras]
    packed = listed.select("user_idx", F.col("r.item_idx").alias("items"), F.col("r.__own").alias("own"), *arrays)
    return cut(packed.withColumn("chunk", F.monotonically_increasing_id()))


def chunk_nodes(chunks: DataFrame, lists: list[str], edges_per_copy: int) -> tuple[DataFrame, DataFrame]:
    """(chunk, node, copy) for every different item of a chunk, and (node, copies); both written."""
    links = chunks.select("chunk", F.explode(F.array_distinct(F.concat(*lists))).alias("node"))
    counts = links.groupBy("node").agg(F.ceil(F.count("*") / edges_per_copy).cast("int").alias("copies"))
    nodes = cut(counts)
    return cut(spread(links, nodes, "node", "chunk")), nodes


def with_vectors(chunks: DataFrame, links: DataFrame, emb: DataFrame, d: int) -> DataFrame:
    """``chunks`` with ``ids`` (ascending) and ``mat``: the vectors of their items in a row."""
    sent = fan_out(emb.select("node", "copies", to_array(d).alias("v"))).drop("copies")
    listed = links.join(sent, ["node", "copy"]).groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("node", "v"))).alias("r"))
    return chunks.join(listed.select("chunk", F.col("r.node").alias("ids"), F.flatten("r.v").alias("mat")), "chunk")


def _by_chunk(run: Callable) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                found = run(row)
                if len(found):
                    yield found

    return over


def _windows(own: np.ndarray, max_len: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of own rows with a history, where their histories start)."""
    at = np.flatnonzero(own)
    at = at[at > 0]
    return at, np.maximum(at - max_len, 0)


def _per_node(ids: np.ndarray, local: np.ndarray, values: np.ndarray, loss: float) -> pd.DataFrame:
    total = np.zeros((len(ids), values.shape[1]))
    np.add.at(total, local, values)
    losses = np.zeros(len(ids))
    losses[0] = loss
    return pd.DataFrame({"node": ids, "v": list(total), "loss": losses})


def _summed(parts: DataFrame, d: int) -> DataFrame:
    """(node, e0.., loss): the vectors ``v`` added up per node."""
    return parts.groupBy("node").agg(*[F.sum(F.col("v")[j]).alias(f"e{j}") for j in range(d)], F.sum("loss").alias("loss"))


# -- pooled state, full softmax --------------------------------------------------------------


def pooled_states(found: DataFrame, max_len: int) -> DataFrame:
    """(row, target, h): half the mean of the last ``max_len`` vectors, half the last one."""

    def run(chunk) -> pd.DataFrame:
        items = np.asarray(chunk.items)
        at, low = _windows(np.asarray(chunk.own), max_len)
        e = np.asarray(chunk.mat).reshape(len(chunk.ids), -1)[np.searchsorted(chunk.ids, items)]
        sums = np.concatenate((np.zeros((1, e.shape[1])), np.cumsum(e, axis=0)))
        h = ((sums[at] - sums[low]) / (at - low)[:, None] + e[at - 1]) / 2
        return pd.DataFrame({"row": chunk.chunk * ROWS + at, "target": items[at], "h": list(h)})

    columns = found.select("chunk", "items", "own", "ids", "mat")
    return columns.mapInPandas(_by_chunk(run), "row bigint, target bigint, h array<double>")


def pooled_back(chunks: DataFrame, row_gradients: DataFrame, max_len: int) -> DataFrame:
    """(node, v, loss): gradients in the states (id, v) handed on to the items of the histories."""
    row = F.col("id")
    listed = row_gradients.groupBy(F.floor(row / ROWS).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct((row % ROWS).alias("at"), F.col("v").alias("g")))).alias("r")
    )
    joined = chunks.select("chunk", "items").join(listed.select("chunk", F.col("r.at").alias("at"), F.flatten("r.g").alias("g")), "chunk")

    def run(chunk) -> pd.DataFrame:
        items, at = np.asarray(chunk.items), np.asarray(chunk.at)
        g = np.asarray(chunk.g).reshape(len(at), -1)
        low = np.maximum(at - max_len, 0)
        share = g / (2.0 * (at - low)[:, None])
        steps = np.zeros((len(items) + 1, g.shape[1]))
        np.add.at(steps, low, share)
        np.add.at(steps, at, -share)
        got = np.cumsum(steps, axis=0)[:-1]
        got[at - 1] += g / 2
        ids, local = np.unique(items, return_inverse=True)
        return _per_node(ids, local, got, 0.0)

    return joined.mapInPandas(_by_chunk(run), "node bigint, v array<double>, loss double")


def pooled_softmax_gradient(
    chunks: DataFrame, links: DataFrame, emb: DataFrame, d: int, max_len: int, n: int, whole_bytes: int = WHOLE_BYTES
) -> DataFrame:
    """(node, e0.., loss): mean cross-entropy of the next item over all items of ``emb``, and its gradient.

    All rows meet all items. An item table of at most ``whole_bytes`` goes to parts of the chunks, where
    a row's scores are made once and nothing but sums per item leaves. A larger one takes two passes over blocks of
    states and items: the first gives every row's softmax denominator, the second the gradients of both sides.
    """
    if emb.count() * (d + 2) * 8 <= whole_bytes:
        return _summed(_pooled_whole(chunks, emb, d, max_len, n), d)
    states = cut(pooled_states(with_vectors(chunks, links, emb, d), max_len))
    items = cut(emb.select(F.col("node").alias("item_idx"), to_array(d).alias("ivec")))
    norms = blocked_logsumexp(states.select(F.col("row").alias("user_idx"), F.col("h").alias("uvec")), items)
    asked = states.join(norms, states["row"] == norms["user_idx"]).select("row", "target", "h", "lse")
    parts = cut(blocked_softmax_gradients(asked, items, d, n))
    rows = parts.filter("is_row").groupBy("id").agg(F.array(*[F.sum(F.col("v")[j]) for j in range(d)]).alias("v"))
    item_side = parts.filter("NOT is_row").select(F.col("id").alias("node"), "v", "loss")
    return _summed(item_side.unionByName(pooled_back(chunks, rows, max_len)), d)


def _pooled_whole(chunks: DataFrame, emb: DataFrame, d: int, max_len: int, n: int) -> DataFrame:
    """(node, v, loss) in parts to be added up, one for each item and part of the chunks."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({"node": np.zeros(0, np.int64), "v": np.zeros(0, object), "loss": np.zeros(0)})
        ids = np.concatenate([np.asarray(v) for v in right["ids"]])
        mat = np.concatenate([np.asarray(v, np.float64) for v in right["mat"]]).reshape(len(ids), d)
        order = np.argsort(ids)
        ids, mat = ids[order], mat[order]
        counted = np.concatenate((mat, np.ones((len(ids), 1))), axis=1)
        longest = np.sqrt((mat * mat).sum(axis=1).max())
        turned = np.ascontiguousarray(mat.T)
        total, loss = np.zeros((len(ids), d)), 0.0
        step = max(1, SCORES // len(ids))
        sizes = left["items"].map(len).to_numpy()
        batch = np.cumsum(sizes) // ROWS_AT_ONCE
        for number in np.unique(batch):
            some = left[batch == number]
            items = np.searchsorted(ids, np.concatenate(list(some["items"])))
            begin = np.repeat(np.cumsum(sizes[batch == number]) - sizes[batch == number], sizes[batch == number])
            at = np.flatnonzero(np.concatenate(list(some["own"])) & (np.arange(len(items)) > begin))
            low = np.maximum(at - max_len, begin[at])
            e = mat[items]
            sums = np.concatenate((np.zeros((1, d)), np.cumsum(e, axis=0)))
            h = ((sums[at] - sums[low]) / (at - low)[:, None] + e[at - 1]) / 2
            g = np.empty_like(h)
            for start in range(0, len(at), step):
                u, wanted = h[start : start + step], items[at[start : start + step]]
                scores = u @ turned
                loss -= scores[np.arange(len(u)), wanted].sum()
                if longest * np.sqrt((u * u).sum(axis=1).max()) > SAFE:
                    top = scores.max(axis=1)
                    scores -= top[:, None]
                    loss += top.sum()
                np.exp(scores, out=scores)
                mixed = scores @ counted
                loss += np.log(mixed[:, d]).sum()
                g[start : start + step] = mixed[:, :d] / mixed[:, d:] - mat[wanted]
                total += scores.T @ (u / mixed[:, d:])
            np.add.at(total, items[at], -h)
            # What a state gets goes on to the items of its history.
            share = g / (2.0 * (at - low)[:, None])
            steps = np.zeros((len(items) + 1, d))
            np.add.at(steps, low, share)
            np.add.at(steps, at, -share)
            got = np.cumsum(steps, axis=0)[:-1]
            got[at - 1] += g / 2
            np.add.at(total, items, got)
        losses = np.zeros(len(ids))
        losses[0] = loss / n
        return pd.DataFrame({"node": ids, "v": list(total / n), "loss": losses})

    parts = max(4 * cores(chunks.sparkSession), -(-n // PART_ROWS))
    left = chunks.select(F.pmod(F.xxhash64("chunk"), F.lit(parts)).alias("part"), "items", "own")
    listed = emb.groupBy(F.pmod(F.xxhash64("node"), F.lit(16))).agg(F.sort_array(F.collect_list(F.struct("node", to_array(d).alias("v")))).alias("r"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint")))
    packed = listed.select(every.alias("part"), F.col("r.node").alias("ids"), F.flatten("r.v").alias("mat"))
    both = left.repartition(parts, "part").groupBy("part").cogroup(packed.repartition(parts, "part").groupBy("part"))
    return both.applyInPandas(run, "node bigint, v array<double>, loss double")


# -- attention, pairwise loss ----------------------------------------------------------------


def attention_gradient(chunks: DataFrame, links: DataFrame, emb: DataFrame, d: int, max_len: int, n: int) -> DataFrame:
    """(node, e0.., loss): weighted pairwise loss of states mixed by attention, and its full gradient.

    The newest item of a history asks, all its items answer: weights are the softmax of inner
    products over sqrt(d). The gradient goes through the values, the keys and the query. Chunks
    carry ``negs`` and ``weights``.
    """
    scale = 1.0 / math.sqrt(d)

    def run(chunk) -> pd.DataFrame:
        ids, items = np.asarray(chunk.ids), np.asarray(chunk.items)
        mat = np.asarray(chunk.mat).reshape(len(ids), -1)
        local, negative = np.searchsorted(ids, items), np.searchsorted(ids, np.asarray(chunk.negs))
        weights = np.asarray(chunk.weights, np.float64)
        every, lows = _windows(np.asarray(chunk.own), max_len)
        total, loss = np.zeros_like(mat), 0.0
        step = max(1, STEP // (max_len * d))
        for start in range(0, len(every), step):
            at, low = every[start : start + step], lows[start : start + step]
            width = int((at - low).max())
            place = low[:, None] + np.arange(width)
            inside = place < at[:, None]
            who = local[np.where(inside, place, 0)]
            keys = mat[who]
            query = mat[local[at - 1]]
            logits = np.where(inside, np.einsum("rld,rd->rl", keys, query) * scale, -np.inf)
            x = np.exp(logits - logits.max(axis=1, keepdims=True))
            w = x / x.sum(axis=1, keepdims=True)
            h = np.einsum("rl,rld->rd", w, keys)
            good, bad = mat[local[at]], mat[negative[at]]
            gap = ((good - bad) * h).sum(axis=1)
            push = -weights[at] / (1.0 + np.exp(np.clip(gap, -700, 700))) / n
            loss += float((weights[at] * np.logaddexp(0.0, -gap)).sum()) / n
            gh = push[:, None] * (good - bad)
            np.add.at(total, local[at], push[:, None] * h)
            np.add.at(total, negative[at], -push[:, None] * h)
            # Softmax Jacobian: what a logit gets is its weight times its value's lead over the mix.
            lead = w * (np.einsum("rld,rd->rl", keys, gh) - (gh * h).sum(axis=1, keepdims=True)) * scale
            got = w[:, :, None] * gh[:, None, :] + lead[:, :, None] * query[:, None, :]
            np.add.at(total, who[inside], got[inside])
            np.add.at(total, local[at - 1], np.einsum("rl,rld->rd", lead, keys))
        losses = np.zeros(len(ids))
        losses[0] = loss
        return pd.DataFrame({"node": ids, "v": list(total), "loss": losses})

    found = with_vectors(chunks, links, emb, d).select("items", "own", "negs", "weights", "ids", "mat")
    return _summed(found.mapInPandas(_by_chunk(run), "node bigint, v array<double>, loss double"), d)


