"""One training step of the sequence and layered graph models from repeatable vectors."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.functions.vectors import names, seeded_vector
from revrank.operators import graph
from revrank.operators.graph import EDGES_PER_COPY
from revrank.operators.sequence_blocks import attention_gradient, chunk_nodes, pack_histories, pooled_softmax_gradient
from revrank.registry.base import q6, query, s6
from revrank.registry.graphs import GRAPH, LOOPS, WEIGHTS, _directed, _hop, _out, _rounded, _start
from revrank.session import cut
from revrank.sources import tables

D, L = 4, 5
HEADS = 2
_J = range(D)


def _sum(expr: str, js=_J, plus: str = " + ") -> str:
    return plus.join(expr.format(j=j) for j in js)


def _list(expr: str, js=_J) -> str:
    return ", ".join(expr.format(j=j) for j in js)


# -- next-item models ----------------------------------------------------------------------

SEQUENCES = """, vec AS (
  SELECT item_idx AS node, """ + ", ".join(f"sin(CAST(item_idx + 1 AS DOUBLE) * {j + 1}.0) AS e{j}" for j in _J) + """
  FROM (SELECT DISTINCT item_idx FROM elog)),
 seq AS (
  SELECT user_idx, item_idx, row_number() OVER o AS t, first_value(item_idx) OVER o AS neg,
         1.0::DOUBLE / (1 + item_idx % 7) AS weight, """ + _list("e{j}") + """
  FROM elog JOIN vec ON node = item_idx WINDOW o AS (PARTITION BY user_idx ORDER BY "timestamp", event_id))"""


def _sequences(spark, d, extras: list[str]):
    log = tables.event_log(spark, d).select("user_idx", "item_idx", *tables.EVENT_ORDER)
    first = log.groupBy("user_idx").agg(F.min_by("item_idx", F.struct(*tables.EVENT_ORDER)).alias("negs"))
    rows = log.join(first, "user_idx").withColumn("weights", 1.0 / (1 + F.col("item_idx") % 7))
    chunks = pack_histories(rows.select(*log.columns, *extras), tables.EVENT_ORDER, L, extras)
    links, nodes = chunk_nodes(chunks, ["items", *[c for c in extras if c == "negs"]], EDGES_PER_COPY)
    return chunks, links, cut(nodes.select("node", "copies", *seeded_vector("node", D)))


def _told(gradient: DataFrame) -> DataFrame:
    return gradient.select("node", *[q6(f"e{j}").alias(f"e{j}") for j in _J])


@query(
    "softmax_gradient",
    SEQUENCES + ", states AS (SELECT user_idx, t, item_idx AS target, least(t - 1, " + str(L) + ") AS m, "
    + _list("(avg(e{j}) OVER w + lag(e{j}) OVER o) / 2 AS h{j}")
    + f""" FROM seq WINDOW o AS (PARTITION BY user_idx ORDER BY t), w AS (PARTITION BY user_idx ORDER BY t ROWS BETWEEN {L} PRECEDING AND 1 PRECEDING)),
 live AS (SELECT * FROM states WHERE t > 1),
 logits AS (SELECT s.*, v.*, {_sum('s.h{j} * v.e{j}')} AS x FROM live s, vec v),
 norms AS (SELECT user_idx, t, ln(sum(exp(x))) AS lse FROM logits GROUP BY ALL),
 off AS (SELECT l.*, exp(x - lse) - CASE WHEN node = target THEN 1 ELSE 0 END AS c FROM logits l JOIN norms USING (user_idx, t)),
 pushed AS (SELECT user_idx, t, any_value(m) AS m, {_list('sum(c * e{j}) AS g{j}')} FROM off GROUP BY user_idx, t),
 parts AS (
  SELECT node, {_list('sum(c * h{j}) AS e{j}')} FROM off GROUP BY node
  UNION ALL
  SELECT s.item_idx, {_list('sum(p.g{j} / (2 * p.m) + CASE WHEN s.t = p.t - 1 THEN p.g{j} / 2 ELSE 0 END)')}
  FROM pushed p JOIN seq s ON s.user_idx = p.user_idx AND s.t BETWEEN p.t - {L} AND p.t - 1 GROUP BY s.item_idx)
 SELECT node, {_list(s6('sum(e{j})') + ' AS e{j}')} FROM parts GROUP BY node""",
)
def _(spark, d):
    chunks, links, emb = _sequences(spark, d, [])
    return _told(pooled_softmax_gradient(chunks, links, emb, D, L, 1))


@query(
    "attention_gradient",
    SEQUENCES + f""", keys AS (
  SELECT r.user_idx, r.t, k.item_idx AS node, q.item_idx AS asks, {_list('k.e{j} AS k{j}')}, {_list('q.e{j} AS q{j}')},
         {_list('r.e{j} - v.e{j} AS f{j}')}, r.item_idx AS target, r.neg, r.weight, ({_sum('k.e{j} * q.e{j}')}) / {math.sqrt(D)} AS x
  FROM seq r JOIN seq q ON q.user_idx = r.user_idx AND q.t = r.t - 1
  JOIN seq k ON k.user_idx = r.user_idx AND k.t BETWEEN r.t - {L} AND r.t - 1 JOIN vec v ON v.node = r.neg),
 mixed AS (SELECT *, exp(x) / sum(exp(x)) OVER (PARTITION BY user_idx, t) AS w FROM keys),
 states AS (
  SELECT user_idx, t, any_value(target) AS target, any_value(neg) AS neg, any_value(asks) AS asks, any_value(weight) AS weight,
         {_list('any_value(f{j}) AS f{j}')}, {_list('sum(w * k{j}) AS h{j}')} FROM mixed GROUP BY user_idx, t),
 pushed AS (SELECT *, -weight / (1 + exp({_sum('f{j} * h{j}')})) AS g FROM states),
 leads AS (
  SELECT m.*, p.g, w * p.g * ({_sum('p.f{j} * (m.k{j} - p.h{j})')}) / {math.sqrt(D)} AS z
  FROM mixed m JOIN pushed p USING (user_idx, t)),
 parts AS (
  SELECT target AS node, {_list('g * h{j} AS e{j}')} FROM pushed UNION ALL SELECT neg, {_list('-g * h{j}')} FROM pushed
  UNION ALL SELECT node, {_list('w * g * f{j} + z * q{j}')} FROM leads
  UNION ALL SELECT asks, {_list('z * k{j}')} FROM leads)
 SELECT node, {_list(s6('sum(e{j})') + ' AS e{j}')} FROM parts GROUP BY node""",
)
def _(spark, d):
    chunks, links, emb = _sequences(spark, d, ["negs", "weights"])
    return _told(attention_gradient(chunks, links, emb, D, L, 1))


# -- layered graph models ------------------------------------------------------------------

MATRIX = np.array([[math.cos(1.0 + k + 2 * j) for j in _J] for k in _J])
LEFT, RIGHT = [0.3 - 0.2 * j for j in _J], [0.1 + 0.15 * j for j in _J]
# A gradient in the layer's result for every node.
GRAD = ", grad AS (SELECT node, " + ", ".join(f"cos(CAST(node + 1 AS DOUBLE) * {j + 1}.0) AS g{j}" for j in _J) + " FROM deg)"


def _grad(nodes: DataFrame) -> DataFrame:
    return nodes.select("node", "copies", *[F.cos((F.col("node") + 1).cast("double") * float(j + 1)).alias(f"e{j}") for j in _J])


@query(
    "gcn_matrix_gradient",
    GRAPH + LOOPS + WEIGHTS + GRAD + _hop("l0", "l1") + ", joined AS (SELECT * FROM l1 JOIN grad USING (node)) "
    + " UNION ALL ".join(f"SELECT {k}::INTEGER AS k, " + _list(s6(f"sum(e{k} * g{{j}})") + " AS e{j}") + " FROM joined" for k in _J),
)
def _(spark, d):
    edges, nodes = graph.normalized_edges(_directed(spark, d), self_loops=True)
    hop = graph.gcn_propagate(_start(nodes), edges, nodes, D, 1)
    return graph.outer_sums(hop, _grad(nodes), D).select("k", *[q6(c).alias(c) for c in names(D)])


@query(
    "gcn_layer_gradient",
    GRAPH + LOOPS + WEIGHTS + GRAD + ", turned AS (SELECT node, "
    + ", ".join(" + ".join(f"g{j} * CAST({float(MATRIX[k, j])!r} AS DOUBLE)" for j in _J) + f" AS e{k}" for k in _J)
    + " FROM grad)" + _hop("turned", "back") + _out("back"),
)
def _(spark, d):
    edges, nodes = graph.normalized_edges(_directed(spark, d), self_loops=True)
    return _rounded(graph.gcn_layer_back(_grad(nodes), edges, nodes, D, MATRIX))


def _head(h: int) -> range:
    return range(h * D // HEADS, (h + 1) * D // HEADS)


def _with(coef: list[float], side: str, h: int) -> str:
    return " + ".join(f"{side}.e{j} * CAST({coef[j]!r} AS DOUBLE)" for j in _head(h))


_HS = range(HEADS)
GAT_BACK = (
    GRAPH + LOOPS + WEIGHTS + GRAD + f""", scored AS (
  SELECT base.src, base.dst, {_list('a.e{j} AS x{j}')}, {', '.join(f'{_with(LEFT, "a", h)} + {_with(RIGHT, "b", h)} AS s{h}' for h in _HS)}
  FROM base JOIN l0 a ON a.node = base.src JOIN l0 b ON b.node = base.dst),
 powers AS (SELECT *, {', '.join(f'exp(CASE WHEN s{h} > 0 THEN s{h} ELSE 0.2 * s{h} END) AS p{h}' for h in _HS)} FROM scored),
 weighted AS (SELECT *, {', '.join(f'p{h} / sum(p{h}) OVER (PARTITION BY dst) AS a{h}' for h in _HS)} FROM powers),
 led AS (SELECT w.*, {_list('g{j}')}, {', '.join(_sum('g{j} * x{j}', _head(h)) + f' AS c{h}' for h in _HS)} FROM weighted w JOIN grad ON grad.node = dst),
 means AS (SELECT dst, {', '.join(f'sum(a{h} * c{h}) AS m{h}' for h in _HS)} FROM led GROUP BY dst),
 sloped AS (
  SELECT led.*, {', '.join(f'a{h} * (c{h} - m{h}) * CASE WHEN s{h} > 0 THEN 1.0::DOUBLE ELSE 0.2::DOUBLE END AS z{h}' for h in _HS)}
  FROM led JOIN means USING (dst)),
 parts AS (
  SELECT src AS node, {', '.join(f'a{j * HEADS // D} * g{j} + z{j * HEADS // D} * CAST({LEFT[j]!r} AS DOUBLE) AS e{j}' for j in _J)},
         {', '.join(f'z{h} AS l{h}' for h in _HS)}, {', '.join(f'0.0::DOUBLE AS r{h}' for h in _HS)} FROM sloped
  UNION ALL
  SELECT dst, {', '.join(f'z{j * HEADS // D} * CAST({RIGHT[j]!r} AS DOUBLE)' for j in _J)}, {', '.join('0.0::DOUBLE' for _ in _HS)},
         {', '.join(f'z{h}' for h in _HS)} FROM sloped)"""
)


def _gat_back(spark, d) -> tuple[DataFrame, DataFrame]:
    edges, nodes = graph.attention_edges(_directed(spark, d))
    x = cut(_start(nodes))
    weights = cut(graph.attention_weights(edges, x, D, HEADS, LEFT, RIGHT))
    out = graph.attend(weights, x, nodes, D, HEADS)
    return graph.attention_back(weights, x, out, _grad(nodes), D, HEADS, LEFT, RIGHT), x


@query("gat_layer_gradient", GAT_BACK + f" SELECT node, {_list(s6('sum(e{j})') + ' AS e{j}')} FROM parts GROUP BY node")
def _(spark, d):
    return _told(_gat_back(spark, d)[0])


@query(
    "gat_coefficient_gradient",
    GAT_BACK + " SELECT " + ", ".join(s6(f"sum(p.{s}{j * HEADS // D} * x.e{j})") + f" AS c{s}{j}" for s in "lr" for j in _J)
    + " FROM parts p JOIN l0 x USING (node)",
)
def _(spark, d):
    back, x = _gat_back(spark, d)
    found = graph.coefficient_gradients(back, x, D, HEADS)
    return found.select(*[q6(c).alias(c) for c in found.columns])
