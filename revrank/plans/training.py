"""Gradient steps on embedding tables, as joins, sums and column arithmetic.

A state table has ``node, copies, e0.. (vector), m0.. v0.. (moments)``. An epoch is a few
lazy joins that end in one checkpoint; nothing but the loss comes back to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrank.functions.hashing import draw
from revrank.functions.vectors import names
from revrank.operators.graph import fan_out

BETA1, BETA2, EPS = 0.9, 0.999, 1e-8


def start_state(nodes: DataFrame, d: int, seed: int, scale: float) -> DataFrame:
    """Uniform start values in (-scale, scale), drawn from the node id."""
    def value(j: int):
        return ((draw("node", F.lit(j), F.lit(seed)) / float(1 << 32)) * 2.0 - 1.0) * scale

    zero = F.lit(0.0)
    return nodes.select(
        "node", "copies",
        *[value(j).alias(f"e{j}") for j in range(d)],
        *[zero.alias(c) for c in names(d, "m") + names(d, "v")],
    )


def xavier(n: int, d: int) -> float:
    return math.sqrt(6.0 / (n + d))


def adam_step(
    state: DataFrame, grad: DataFrame, d: int, step: int, lr: float, weight_decay: float, decoupled: bool = True
) -> DataFrame:
    """One Adam step; ``decoupled`` decays the weights (AdamW), else the decay joins the gradient."""
    found = state.join(grad.select("node", *[F.col(f"e{j}").alias(f"g{j}") for j in range(d)]), "node", "left")
    new = {}
    for j in range(d):
        e, m, v = F.col(f"e{j}"), F.col(f"m{j}"), F.col(f"v{j}")
        g = F.coalesce(F.col(f"g{j}"), F.lit(0.0))
        if not decoupled:
            g = g + e * weight_decay
        m2, v2 = m * BETA1 + g * (1 - BETA1), v * BETA2 + g * g * (1 - BETA2)
        move = (m2 / (1 - BETA1**step)) / (F.sqrt(v2 / (1 - BETA2**step)) + EPS)
        kept = e * (1 - lr * weight_decay) if decoupled else e
        new |= {f"e{j}": kept - move * lr, f"m{j}": m2, f"v{j}": v2}
    return found.select("node", "copies", *[new[c].alias(c) for c in names(d) + names(d, "m") + names(d, "v")])


def unit_rows(state: DataFrame, d: int) -> DataFrame:
    size = F.sqrt(sum((F.col(c) * F.col(c) for c in names(d)), F.lit(0.0)))
    return state.withColumns({c: F.when(size > 0, F.col(c) / size).otherwise(F.col(c)) for c in names(d)})


def gather(rows: DataFrame, emb: DataFrame, key: str, prefix: str, d: int, copy: str | None = None) -> DataFrame:
    """Rows with the vector of node ``key`` as ``{prefix}0..``.

    With ``copy`` the row names which copy of a hot node it meets (see operators.graph).
    """
    renamed = [F.col(f"e{j}").alias(f"{prefix}{j}") for j in range(d)]
    if copy is None:
        return rows.join(emb.select(F.col("node").alias(key), *renamed), key)
    sent = fan_out(emb.select("node", "copies", *renamed)).withColumnsRenamed({"node": key, "copy": copy}).drop("copies")
    return rows.join(sent, [key, copy])


def sum_gradients(rows: DataFrame, roles: list[tuple[str, Callable[[int], Column]]], loss: Column, d: int) -> DataFrame:
    """(node, e0.., loss): every row gives a vector to the node of each role, summed per node.

    One pass over the rows; the sums start in the map tasks. The row's loss goes along with
    its first role, so the total loss is one small sum over the result.
    """
    parts = [
        F.struct(
            F.col(node).alias("node"),
            *[value(j).alias(f"e{j}") for j in range(d)],
            (loss if n == 0 else F.lit(0.0)).alias("loss"),
        )
        for n, (node, value) in enumerate(roles)
    ]
    return rows.select(F.inline(F.array(*parts))).groupBy("node").agg(*[F.sum(c).alias(c) for c in [*names(d), "loss"]])


class DenseAdam:
    """Adam for parameters of fixed size (layer matrices, coefficients), kept on the driver."""

    def __init__(self, lr: float, decay: float):
        self.lr, self.decay, self.steps = lr, decay, 0
        self.moments: list[tuple[np.ndarray, np.ndarray]] = []

    def step(self, values: list[np.ndarray], gradients: list[np.ndarray]) -> list[np.ndarray]:
        """New values; the decay joins the gradient."""
        self.moments = self.moments or [(np.zeros_like(v), np.zeros_like(v)) for v in values]
        self.steps += 1
        out = []
        for k, (value, gradient) in enumerate(zip(values, gradients)):
            g = gradient + self.decay * value
            m, v = self.moments[k]
            m, v = BETA1 * m + (1 - BETA1) * g, BETA2 * v + (1 - BETA2) * g * g
            self.moments[k] = (m, v)
            out.append(value - self.lr * (m / (1 - BETA1**self.steps)) / (np.sqrt(v / (1 - BETA2**self.steps)) + EPS))
        return out


def glorot(rng: np.random.Generator, rows: int, columns: int) -> np.ndarray:
    return rng.uniform(-1, 1, (rows, columns)) * xavier(rows, columns)
