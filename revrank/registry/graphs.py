"""Graph queries with repeatable start vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.functions.vectors import names, seeded_vector
from revrank.operators import graph
from revrank.operators.sampling import distinct_edges
from revrank.registry.base import q6, query, s6
from revrank.sources import tables

D = 4
_ES = [f"e{j}" for j in range(D)]

# Users keep their id, items come after them.
GRAPH = """, edges AS (SELECT DISTINCT user_idx, item_idx FROM elog),
 nu AS (SELECT max(user_idx) + 1 AS n FROM elog),
 dir AS (SELECT user_idx AS src, item_idx + n AS dst FROM edges, nu UNION ALL SELECT item_idx + n, user_idx FROM edges, nu)"""
LOOPS = ", base AS (SELECT * FROM dir UNION ALL SELECT DISTINCT src, src FROM dir)"
PLAIN = ", base AS (SELECT * FROM dir)"
WEIGHTS = """, deg AS (SELECT src AS node, count(*) AS degree FROM base GROUP BY 1),
 wedge AS (SELECT src, dst, 1.0::DOUBLE / sqrt(CAST(a.degree AS DOUBLE) * b.degree) AS w FROM base JOIN deg a ON a.node = src JOIN deg b ON b.node = dst),
 l0 AS (SELECT node, """ + ", ".join(f"sin(CAST(node + 1 AS DOUBLE) * {j + 1}.0) AS e{j}" for j in range(D)) + " FROM deg)"


def _hop(src: str, dst: str) -> str:
    sums = ", ".join(f"sum(e{j} * w) AS e{j}" for j in range(D))
    return f", {dst} AS (SELECT dst AS node, {sums} FROM wedge JOIN {src} ON {src}.node = wedge.src GROUP BY 1)"


def _out(table: str) -> str:
    return f" SELECT node, {', '.join(f'{s6(c)} AS {c}' for c in _ES)} FROM {table}"


def _directed(spark, d) -> DataFrame:
    edges = distinct_edges(tables.event_log(spark, d))
    n_users = edges.agg(F.max("user_idx")).first()[0] + 1
    return graph.bidirectional_edges(edges, n_users)


def _start(nodes: DataFrame) -> DataFrame:
    return nodes.select("node", "copies", *seeded_vector("node", D))


def _rounded(emb: DataFrame) -> DataFrame:
    return emb.select("node", *[q6(c).alias(c) for c in names(D)])


@query("bidirectional_edges", GRAPH + " SELECT src, dst FROM dir")
def _(spark, d):
    return _directed(spark, d)


@query("node_degree", GRAPH + " SELECT src AS node, count(*) AS degree FROM dir GROUP BY 1")
def _(spark, d):
    return graph.node_degree(_directed(spark, d))


@query("edges_to_nodes", GRAPH + PLAIN + WEIGHTS + _hop("l0", "l1") + _out("l1"))
def _(spark, d):
    edges, nodes = graph.normalized_edges(_directed(spark, d))
    return _rounded(graph.edges_to_nodes(edges, _start(nodes), D))


_MEAN3 = ", ".join(f"(l0.e{j} + l1.e{j} + l2.e{j}) / 3 AS e{j}" for j in range(D))


@query(
    "lightgcn_propagate",
    GRAPH + PLAIN + WEIGHTS + _hop("l0", "l1") + _hop("l1", "l2")
    + f", f AS (SELECT l0.node, {_MEAN3} FROM l0 JOIN l1 USING (node) JOIN l2 USING (node))" + _out("f"),
)
def _(spark, d):
    edges, nodes = graph.normalized_edges(_directed(spark, d))
    return _rounded(graph.lightgcn_propagate(_start(nodes), edges, nodes, D, 2))


@query(
    "gcn_propagate",
    GRAPH + LOOPS + WEIGHTS + _hop("l0", "l1") + _hop("l1", "l2") + _hop("l2", "l3") + _hop("l3", "l4") + _out("l4"),
)
def _(spark, d):
    edges, nodes = graph.normalized_edges(_directed(spark, d), self_loops=True)
    return _rounded(graph.gcn_propagate(_start(nodes), edges, nodes, D, 4))


def _gat_layer(src: str, dst: str, heads: int) -> str:
    size = D // heads
    sl = [" + ".join(f"a.e{j}" for j in range(h * size, (h + 1) * size)) for h in range(heads)]
    sr = [" + ".join(f"b.e{j}" for j in range(h * size, (h + 1) * size)) for h in range(heads)]
    scores = ", ".join(
        f"exp(CASE WHEN {left} + {right} > 0 THEN {left} + {right} ELSE 0.2 * ({left} + {right}) END) AS x{h}"
        for h, (left, right) in enumerate(zip(sl, sr))
    )
    outs = ", ".join(f"sum(x{j // size} * e{j}) / sum(x{j // size}) AS e{j}" for j in range(D))
    return f""", {dst}_x AS (SELECT base.src, base.dst, {scores}, {', '.join(f'a.e{j}' for j in range(D))}
      FROM base JOIN {src} a ON a.node = base.src JOIN {src} b ON b.node = base.dst),
    {dst} AS (SELECT dst AS node, {outs} FROM {dst}_x GROUP BY 1)"""


_ELU = ", ".join(f"CASE WHEN e{j} > 0 THEN e{j} ELSE exp(e{j}) - 1 END AS e{j}" for j in range(D))


@query(
    "gat_propagate",
    GRAPH + LOOPS + WEIGHTS + _gat_layer("l0", "g1", 4) + f", h1 AS (SELECT node, {_ELU} FROM g1)" + _gat_layer("h1", "g2", 1) + _out("g2"),
)
def _(spark, d):
    edges, nodes = graph.attention_edges(_directed(spark, d))
    return _rounded(graph.gat_propagate(_start(nodes), edges, nodes, D, 4))
