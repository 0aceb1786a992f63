"""The user-item graph and message passing as joins and sums.

A node is one id: users keep theirs, items are shifted by the number of users.
A node table has ``node, copies, e0..e{d-1}``; a directed edge table has
``src, dst, w, copy``. A hot node's edges are split into ``copies`` groups by a hash
of the other end, and its vector is sent to each group, so no join group holds
more than about ``EDGES_PER_COPY`` edges whatever one node's degree.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrank.functions.vectors import names
from revrank.operators.aggregates import scalar
from revrank.session import cut

EDGES_PER_COPY = 200_000
LEAK = 0.2


def bidirectional_edges(edges: DataFrame, n_users: int) -> DataFrame:
    """Both directions of (user, item) edges in one node space."""
    item = F.col("item_idx") + F.lit(n_users)
    extra = [c for c in edges.columns if c not in ("user_idx", "item_idx")]
    forth = edges.select(F.col("user_idx").alias("src"), item.alias("dst"), *extra)
    back = edges.select(item.alias("src"), F.col("user_idx").alias("dst"), *extra)
    return forth.unionByName(back)


def node_degree(directed: DataFrame) -> DataFrame:
    return directed.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))


def node_copies(directed: DataFrame, edges_per_copy: int = EDGES_PER_COPY) -> DataFrame:
    """(node, degree, copies)."""
    return node_degree(directed).withColumn("copies", F.ceil(F.col("degree") / edges_per_copy).cast("int"))


def spread(df: DataFrame, nodes: DataFrame, key: str, other: str, copy: str = "copy") -> DataFrame:
    """Adds to each row which copy of node ``key`` it meets."""
    hot = nodes.filter(F.col("copies") > 1).select(F.col("node").alias(key), F.col("copies").alias("__copies"))
    return (
        df.join(hot, key, "left")
        .withColumn(copy, F.pmod(F.xxhash64(other), F.coalesce("__copies", F.lit(1))).cast("int"))
        .drop("__copies")
    )


def normalized_edges(
    directed: DataFrame, norm_scale: float = 1.0, self_loops: bool = False,
    edges_per_copy: int = EDGES_PER_COPY, nodes: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(edges with symmetric weight deg^-1/2 * deg^-1/2, node table).

    ``nodes`` keeps the copies of a known node table, for a graph with edges left out; self
    loops are then made for all its nodes, also those without an edge.
    """
    base = directed.select("src", "dst")
    if self_loops:
        every = base.select(F.col("src").alias("node")).distinct() if nodes is None else nodes.select("node")
        loops = every.select(F.col("node").alias("src"), F.col("node").alias("dst"))
        base = base.unionByName(loops)
    counted = node_copies(base, edges_per_copy)
    nodes = counted if nodes is None else nodes
    degree = counted.select("node", "degree")
    src = degree.select(F.col("node").alias("src"), F.col("degree").alias("__ds"))
    dst = degree.select(F.col("node").alias("dst"), F.col("degree").alias("__dd"))
    weighted = (
        base.join(src, "src")
        .join(dst, "dst")
        .select("src", "dst", (F.lit(norm_scale) / F.sqrt(F.col("__ds").cast("double") * F.col("__dd"))).alias("w"))
    )
    return spread(weighted, nodes, "src", "dst"), nodes.select("node", "copies")


def fan_out(emb: DataFrame) -> DataFrame:
    """One row per copy of a node (one row for all but the hottest)."""
    return emb.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))


def edges_to_nodes(edges: DataFrame, emb: DataFrame, d: int) -> DataFrame:
    """One hop: every node gets the weighted sum of its neighbours' vectors."""
    sent = fan_out(emb).withColumnRenamed("node", "src").drop("copies")
    cols = names(d)
    return (
        edges.join(sent, ["src", "copy"])
        .groupBy(F.col("dst").alias("node"))
        .agg(*[F.sum(F.col(c) * F.col("w")).alias(c) for c in cols])
    )


def _with_copies(layer: DataFrame, nodes: DataFrame) -> DataFrame:
    return layer.join(nodes, "node")


def _blend(layers: list[DataFrame], nodes: DataFrame, d: int) -> DataFrame:
    cols = names(d)
    stacked = reduce(lambda a, b: a.unionByName(b), [x.select("node", *cols) for x in layers])
    mean = stacked.groupBy("node").agg(*[(F.sum(c) / float(len(layers))).alias(c) for c in cols])
    return _with_copies(mean, nodes)


def lightgcn_propagate(emb: DataFrame, edges: DataFrame, nodes: DataFrame, d: int, layers: int = 2) -> DataFrame:
    """Mean of the layers E, AE, A(AE), ... with A given by the edge weights."""
    cols = names(d)
    parts = [emb]
    for _ in range(layers):
        parts.append(_with_copies(edges_to_nodes(edges, parts[-1], d), nodes).select("node", "copies", *cols))
    return _blend(parts, nodes, d)


def gcn_propagate(emb: DataFrame, edges: DataFrame, nodes: DataFrame, d: int, layers: int = 4) -> DataFrame:
    """The last of ``layers`` linear hops; the edges should carry self loops."""
    out = emb
    for _ in range(layers):
        out = _with_copies(edges_to_nodes(edges, out, d), nodes)
    return out


def leaky(x: Column) -> Column:
    return F.when(x > 0, x).otherwise(x * LEAK)


def elu(x: Column) -> Column:
    return F.when(x > 0, x).otherwise(F.exp(F.least(x, F.lit(0.0))) - 1.0)


def attention_scores(
    edges: DataFrame, emb: DataFrame, d: int, heads: int, left: list[float], right: list[float]
) -> DataFrame:
    """Edges with one softmax numerator per head (``x0 .. x{heads-1}``).

    The score of an edge is leaky(left . x_src + right . x_dst) on the head's slice of
    the vector. The largest source part over all nodes bounds the scores of a target
    from above; subtracting that bound keeps exp() in range without a pass per target.
    """
    size = d // heads
    cols = names(d)

    def part(h: int, coef: list[float]) -> Column:
        js = range(h * size, (h + 1) * size)
        return reduce(lambda a, b: a + b, [F.col(cols[j]) * F.lit(float(coef[j])) for j in js])

    ls, rs = [f"__l{h}" for h in range(heads)], [f"__r{h}" for h in range(heads)]
    tops = [scalar(emb, F.max(part(h, left))) for h in range(heads)]
    src = fan_out(emb.select("node", "copies", *[part(h, left).alias(ls[h]) for h in range(heads)]))
    # In-edges of a hot target meet its value in as many groups as its out-edges do.
    dst = fan_out(emb.select("node", "copies", *[part(h, right).alias(rs[h]) for h in range(heads)]))
    scored = edges.join(src.withColumnRenamed("node", "src").drop("copies"), ["src", "copy"]).join(
        dst.withColumnsRenamed({"node": "dst", "copy": "dcopy"}).drop("copies"), ["dst", "dcopy"]
    )
    exps = [
        F.exp(leaky(F.col(ls[h]) + F.col(rs[h])) - leaky(tops[h] + F.col(rs[h]))).alias(f"x{h}") for h in range(heads)
    ]
    return scored.select(*edges.columns, *exps)


def attention_weights(
    edges: DataFrame, emb: DataFrame, d: int, heads: int, left: list[float], right: list[float]
) -> DataFrame:
    """Edges with softmax weights ``a0 ..`` that sum to 1 over the edges into a node."""
    scored = cut(attention_scores(edges, emb, d, heads, left, right))
    sums = scored.groupBy("dst").agg(*[F.sum(f"x{h}").alias(f"__s{h}") for h in range(heads)])
    sums = fan_out(sums.join(emb.select(F.col("node").alias("dst"), "copies"), "dst")).withColumnRenamed("copy", "dcopy")
    weights = [(F.col(f"x{h}") / F.col(f"__s{h}")).alias(f"a{h}") for h in range(heads)]
    return scored.join(sums.drop("copies"), ["dst", "dcopy"]).select(*edges.columns, *weights)


def attend_once(
    edges: DataFrame, emb: DataFrame, nodes: DataFrame, d: int, heads: int, left: list[float], right: list[float]
) -> DataFrame:
    """One attention layer; numerator and denominator of the softmax in one aggregate."""
    size = d // heads
    scored = attention_scores(edges, emb, d, heads, left, right)
    sent = fan_out(emb).withColumnRenamed("node", "src").drop("copies")
    aggs = [
        (F.sum(F.col(f"e{j}") * F.col(f"x{j // size}")) / F.sum(f"x{j // size}")).alias(f"e{j}") for j in range(d)
    ]
    out = scored.join(sent, ["src", "copy"]).groupBy(F.col("dst").alias("node")).agg(*aggs)
    return _with_copies(out, nodes)


def attention_edges(directed: DataFrame, edges_per_copy: int = EDGES_PER_COPY) -> tuple[DataFrame, DataFrame]:
    """(edges with self loops and copy numbers for both ends, node table)."""
    loops = directed.select(F.col("src").alias("node")).distinct()
    base = directed.select("src", "dst").unionByName(
        loops.select(F.col("node").alias("src"), F.col("node").alias("dst"))
    )
    nodes = node_copies(base, edges_per_copy)
    out = spread(base, nodes, "src", "dst")
    return spread(out, nodes, "dst", "src", "dcopy"), nodes.select("node", "copies")


def attend(edges: DataFrame, emb: DataFrame, nodes: DataFrame, d: int, heads: int) -> DataFrame:
    """Weighted sum of neighbour vectors with the head's weight on the head's slice."""
    size = d // heads
    sent = fan_out(emb).withColumnRenamed("node", "src").drop("copies")
    aggs = [F.sum(F.col(f"e{j}") * F.col(f"a{j // size}")).alias(f"e{j}") for j in range(d)]
    out = edges.join(sent, ["src", "copy"]).groupBy(F.col("dst").alias("node")).agg(*aggs)
    return _with_copies(out, nodes)


def attend_back(edges: DataFrame, grad: DataFrame, nodes: DataFrame, d: int, heads: int) -> DataFrame:
    """The transpose of ``attend``: gradients flow from targets to sources."""
    turned = edges.select(
        F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("dcopy").alias("copy"),
        *[f"a{h}" for h in range(heads)],
    )
    return attend(turned, grad, nodes, d, heads)


def gat_propagate(
    emb: DataFrame, edges: DataFrame, nodes: DataFrame, d: int, heads: int = 4,
    coefs: list[tuple[list[float], list[float]]] | None = None,
) -> DataFrame:
    """Two attention layers: ``heads`` heads and ELU, then one head."""
    ones = [1.0] * d
    (l1, r1), (l2, r2) = coefs or [(ones, ones), (ones, ones)]
    first = attend_once(edges, emb, nodes, d, heads, l1, r1)
    hidden = cut(first.withColumns({c: elu(F.col(c)) for c in names(d)}))
    return attend_once(edges, hidden, nodes, d, 1, l2, r2)


# -- layers with parameters --------------------------------------------------------------


def _columns(batch: pa.RecordBatch, cols: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cols]) if batch.num_rows else np.zeros((0, len(cols)))


def times_matrix(emb: DataFrame, w: np.ndarray, bias: np.ndarray | None = None) -> DataFrame:
    """Every node's vector times ``w`` (a d x d parameter, sent with the task), plus ``bias``."""
    cols, out = names(w.shape[0]), names(w.shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _columns(batch, cols) @ w
            y = y if bias is None else y + bias
            arrays = [batch.column("node"), batch.column("copies"), *[pa.array(np.ascontiguousarray(y[:, j])) for j in range(y.shape[1])]]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "copies", *out])

    schema = "node bigint, copies int, " + ", ".join(f"{c} double" for c in out)
    return emb.select("node", F.col("copies").cast("int").alias("copies"), *cols).mapInArrow(run, schema)


def outer_sums(left: DataFrame, right: DataFrame, d: int) -> DataFrame:
    """(k, e0..): row k of the sum over nodes of left's vector (as a column) times right's; d rows.

    Each task adds its nodes up and hands on d rows.
    """
    cols = names(d)
    both = left.select("node", *cols).join(right.select("node", *[F.col(c).alias(f"r_{c}") for c in cols]), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            total += _columns(batch, cols).T @ _columns(batch, [f"r_{c}" for c in cols])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), *[pa.array(total[:, j].copy()) for j in range(d)]], names=["k", *cols])

    parts = both.mapInArrow(run, "k int, " + ", ".join(f"{c} double" for c in cols))
    return parts.groupBy("k").agg(*[F.sum(c).alias(c) for c in cols])


def gcn_layer_back(grad: DataFrame, edges: DataFrame, nodes: DataFrame, d: int, w: np.ndarray) -> DataFrame:
    """Gradient in a layer's input from that in its output, ``A x w``; A is symmetric."""
    return _with_copies(edges_to_nodes(edges, times_matrix(grad, w.T), d), nodes)


def attention_back(
    edges: DataFrame, x: DataFrame, out: DataFrame, grad: DataFrame, d: int, heads: int, left: list[float], right: list[float]
) -> DataFrame:
    """(node, e0.., l0.., r0..): gradient of an attention layer in its input vectors ``x``.

    ``edges`` carry the weights a0.. of the forward pass, ``out`` is its result and ``grad`` the
    gradient there. The softmax over a target's edges needs one number per target and head, the
    product of gradient and result, so each edge is met once. ``l``/``r`` are the sums of the score
    gradients by source and by target; with ``x`` they give the gradients of the coefficients.
    """
    size, hs = d // heads, range(heads)

    def part(h: int, value) -> Column:
        return reduce(lambda a, b: a + b, [value(j) for j in range(h * size, (h + 1) * size)])

    sent = fan_out(x.select("node", "copies", *[F.col(f"e{j}").alias(f"x{j}") for j in range(d)]))
    sent = sent.withColumnsRenamed({"node": "src"}).drop("copies")
    at = (
        grad.select("node", *[F.col(f"e{j}").alias(f"g{j}") for j in range(d)])
        .join(out.select("node", *[F.col(f"e{j}").alias(f"o{j}") for j in range(d)]), "node")
        .join(x.select("node", "copies", *names(d)), "node")
    )
    at = at.select(
        "node", "copies", *[f"g{j}" for j in range(d)],
        *[part(h, lambda j: F.col(f"g{j}") * F.col(f"o{j}")).alias(f"m{h}") for h in hs],
        *[part(h, lambda j: F.col(f"e{j}") * float(right[j])).alias(f"t{h}") for h in hs],
    )
    at = fan_out(at).withColumnsRenamed({"node": "dst", "copy": "dcopy"}).drop("copies")
    rows = edges.join(sent, ["src", "copy"]).join(at, ["dst", "dcopy"])
    slope = {}
    for h in hs:
        score = part(h, lambda j: F.col(f"x{j}") * float(left[j])) + F.col(f"t{h}")
        lead = part(h, lambda j: F.col(f"g{j}") * F.col(f"x{j}")) - F.col(f"m{h}")
        slope[f"z{h}"] = F.col(f"a{h}") * lead * F.when(score > 0, 1.0).otherwise(LEAK)
    rows = rows.withColumns(slope)
    z, none = [F.col(f"z{h}") for h in hs], F.lit(0.0)
    source = F.struct(
        F.col("src").alias("node"),
        *[(F.col(f"a{j // size}") * F.col(f"g{j}") + z[j // size] * float(left[j])).alias(f"e{j}") for j in range(d)],
        *[z[h].alias(f"l{h}") for h in hs], *[none.alias(f"r{h}") for h in hs],
    )
    target = F.struct(
        F.col("dst").alias("node"), *[(z[j // size] * float(right[j])).alias(f"e{j}") for j in range(d)],
        *[none.alias(f"l{h}") for h in hs], *[z[h].alias(f"r{h}") for h in hs],
    )
    sums = [*names(d), *[f"l{h}" for h in hs], *[f"r{h}" for h in hs]]
    return rows.select(F.inline(F.array(source, target))).groupBy("node").agg(*[F.sum(c).alias(c) for c in sums])


def coefficient_gradients(back: DataFrame, x: DataFrame, d: int, heads: int) -> DataFrame:
    """One row l0.. r0..: gradients of the attention coefficients, from ``attention_back`` and its ``x``."""
    size = d // heads
    both = back.select("node", *[f"{s}{h}" for s in "lr" for h in range(heads)]).join(x.select("node", *names(d)), "node")
    # Node by node first: one sum per head and component, taken in the map tasks.
    return both.agg(*[F.sum(F.col(f"{s}{j // size}") * F.col(f"e{j}")).alias(f"c{s}{j}") for s in "lr" for j in range(d)])
