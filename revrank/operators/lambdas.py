"""One round of pairwise lambda gradients (Burges 2010), without listing the pairs.

A pair of rows of one user counts when the labels differ and the better-placed row is
among the first ``truncation`` places. So a row only has to meet the first places of its
user: rows join at most ``truncation`` others, never all rows of the user. What they give
each other is summed in the map tasks before any shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrank.operators import positions
from revrank.operators.positions import with_position

TRUNCATION = 30
# Pairs worked on at once.
PAIRS = 1 << 20


def _discount(rank) -> Column:
    return 1.0 / F.log2(rank + F.lit(1.0))


def ideal_dcg(rows: DataFrame, k: int) -> DataFrame:
    """(user, ideal): DCG of all positives first, cut at k."""
    best = F.least(F.sum("label"), F.lit(k)).cast("int")
    ideal = F.when(F.col("__n") < 1, F.lit(0.0)).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.greatest("__n", F.lit(1))), F.lit(0.0), lambda s, r: s + _discount(r))
    )
    return rows.groupBy("user_idx").agg(best.alias("__n")).select("user_idx", ideal.alias("ideal"))


def lambda_gradients(
    rows: DataFrame, key: str, k: int = 10, truncation: int = TRUNCATION, sigma: float = 1.0,
    hot_rows: int | None = None,
) -> DataFrame:
    """(key, user_idx, lambda, hessian) for ``rows(key, user_idx, label 0/1, score)``.

    Ranks are by score, ties by ``key``. A positive lambda asks for a higher score.
    """
    cap = positions.HOT_ROWS if hot_rows is None else hot_rows
    ranked = with_position(rows, ["user_idx"], [F.col("score").desc(), F.col(key)], "__rank", cap)
    ranked = ranked.withColumn("__rank", F.col("__rank") + 1).withColumn("__disc", _discount(F.col("__rank")))
    # Users with one label only have no pairs; users without a positive have no ideal.
    tops = (
        ranked.filter(F.col("__rank") <= truncation)
        .join(ideal_dcg(rows, k).filter(F.col("ideal") > 0), "user_idx")
        .select(
            "user_idx", "ideal", F.col(key).alias("t_key"), F.col("label").alias("t_label"),
            F.col("score").alias("t_score"), F.col("__rank").alias("t_rank"), F.col("__disc").alias("t_disc"),
        )
    )
    # Every unordered pair once: the row meets the listed rows placed before it.
    met = ranked.join(tops, "user_idx").filter(
        (F.col("t_rank") < F.col("__rank")) & (F.col("t_label") != F.col("label"))
    )
    # One step per value that is used twice, so that nothing is worked out more than once.
    gain = met.select(
        "user_idx", key, "t_key",
        (F.col("label") > F.col("t_label")).alias("high"),
        (F.abs(F.col("__disc") - F.col("t_disc")) / F.col("ideal") * float(sigma)).alias("gap"),
        ((F.col("score") - F.col("t_score")) * float(sigma)).alias("diff"),
    )
    margin = F.when(F.col("high"), F.col("diff")).otherwise(-F.col("diff"))
    gain = gain.withColumn("miss", 1.0 / (1.0 + F.exp(margin))).withColumn("push", F.col("gap") * F.col("miss"))
    met = gain.select(
        "user_idx", key, "t_key",
        F.when(F.col("high"), F.col("push")).otherwise(-F.col("push")).alias("signed"),
        (F.col("push") * float(sigma) * (1.0 - F.col("miss"))).alias("curve"),
    )
    signed, curve = F.col("signed"), F.col("curve")
    both = met.select(
        "user_idx",
        F.inline(
            F.array(
                F.struct(F.col(key).alias(key), signed.alias("l"), curve.alias("h")),
                F.struct(F.col("t_key").alias(key), (-signed).alias("l"), curve.alias("h")),
            )
        ),
    )
    sums = both.groupBy(key, "user_idx").agg(F.sum("l").alias("lambda"), F.sum("h").alias("hessian"))
    zero = F.lit(0.0)
    return (
        rows.select(key, "user_idx")
        .join(sums.drop("user_idx"), key, "left")
        .select(key, "user_idx", F.coalesce("lambda", zero).alias("lambda"), F.coalesce("hessian", zero).alias("hessian"))
    )


def list_gradients(labels: Column, scores: Column, k: int = 10, truncation: int = TRUNCATION, sigma: float = 1.0) -> Column:
    """``lambda_gradients`` of users held as one row each: an array of (lambda, hessian).

    ``labels`` and ``scores`` are arrays, one entry per row of the user; ties of scores go to the earlier entry.
    """

    def run(labels: pa.Array, scores: pa.Array) -> pa.Array:
        sizes = np.diff(labels.offsets.to_numpy())
        label, score = labels.flatten().to_numpy(), scores.flatten().to_numpy()
        steepness, curve = list_sums(label, score, sizes, k, truncation, sigma)
        both = pa.StructArray.from_arrays([pa.array(steepness), pa.array(curve)], ["lambda", "hessian"])
        starts = np.concatenate(([0], np.cumsum(sizes)))
        return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), both)

    return F.arrow_udf(run, "array<struct<lambda:double,hessian:double>>")(labels, scores)


def list_sums(
    label: np.ndarray, score: np.ndarray, sizes: np.ndarray, k: int = 10, truncation: int = TRUNCATION, sigma: float = 1.0
) -> tuple[np.ndarray, np.ndarray]:
    """Lambdas and hessians of rows that lie user after user, ``sizes`` rows each."""
    starts = np.concatenate(([0], np.cumsum(sizes)))
    steepness, curve = np.zeros(len(label)), np.zeros(len(label))
    # Users of like sizes together, so that little of a table is empty.
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * int(sizes[order[end]]) * min(truncation, int(sizes[order[end]])) <= PAIRS:
            end += 1
        some = order[at:end]
        at = end
        if sizes[some[-1]] > 1:
            place = starts[some, None] + np.arange(sizes[some[-1]])
            inside = np.arange(sizes[some[-1]]) < sizes[some, None]
            place = np.where(inside, place, starts[some, None])
            got = _pair_sums(label[place], np.where(inside, score[place], -np.inf), inside, k, truncation, sigma)
            steepness[place[inside]], curve[place[inside]] = got[0][inside], got[1][inside]
    return steepness, curve


def _pair_sums(
    label: np.ndarray, score: np.ndarray, inside: np.ndarray, k: int, truncation: int, sigma: float
) -> tuple[np.ndarray, np.ndarray]:
    """Lambdas and hessians of a table of users (rows) and their entries; an entry not ``inside`` is no entry."""
    n = label.shape[1]
    order = np.argsort(-score, axis=1, kind="stable")
    y, s = np.take_along_axis(label, order, axis=1), np.take_along_axis(score, order, axis=1)
    live = np.take_along_axis(inside, order, axis=1)
    s = np.where(live, s, 0.0)
    disc = 1.0 / np.log2(np.arange(1, n + 1) + 1.0)
    best = np.minimum((y * live).sum(axis=1), k)
    ideal = np.concatenate(([0.0], np.cumsum(1.0 / np.log2(np.arange(1, k + 1) + 1.0))))[best.astype(np.int64)]
    steepness, curve = np.zeros(s.shape), np.zeros(s.shape)
    has = ideal > 0
    for t in range(min(truncation, n - 1)):
        # The entry at place t meets all placed after it.
        met = live[:, t + 1 :] & (y[:, t + 1 :] != y[:, t, None]) & has[:, None]
        row, col = np.nonzero(met)
        col += t + 1
        high = y[row, col] > y[row, t]
        diff = (s[row, col] - s[row, t]) * sigma
        with np.errstate(over="ignore"):
            miss = 1.0 / (1.0 + np.exp(np.where(high, diff, -diff)))
        push = np.abs(disc[col] - disc[t]) / ideal[row] * sigma * miss
        signed, bend = np.where(high, push, -push), push * sigma * (1.0 - miss)
        steepness[row, col] += signed
        curve[row, col] += bend
        steepness[:, t] -= np.bincount(row, signed, len(s))
        curve[:, t] += np.bincount(row, bend, len(s))
    out = np.zeros(s.shape), np.zeros(s.shape)
    np.put_along_axis(out[0], order, steepness, axis=1)
    np.put_along_axis(out[1], order, curve, axis=1)
    return out


def newton_leaves(rows: DataFrame, leaf: str, l2: float = 0.0) -> DataFrame:
    """(leaf, value) for ``rows(leaf, lambda, hessian, w)``: sum of w * lambda over sum of w * hessian plus ``l2``.

    The step that lowers a second-order loss most when all rows of a leaf move together. A
    leaf whose divisor is 0 gets 0.
    """
    sums = rows.groupBy(leaf).agg(
        F.sum(F.col("w") * F.col("lambda")).alias("__g"), (F.sum(F.col("w") * F.col("hessian")) + F.lit(float(l2))).alias("__h")
    )
    value = F.when(F.col("__h") > 0, F.col("__g") / F.col("__h")).otherwise(F.lit(0.0))
    return sums.select(leaf, value.alias("value"))
