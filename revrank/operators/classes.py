"""Exact top-k where many users, and many items, score alike.

A score is a share of a user class and an item class times a weight of the item's own. So pairs
of classes are scored, not pairs of rows. Inside an item class the order is that of the weights
(turned round where the share is negative, by id where it is zero), so its first items are made once for all.
A class of users gets a list of k and as many items as any of its users has seen; a user's
rows are the first k of it that the user has not seen. Classes and lists are tables, nothing is collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.operators.blocked import blocked_scores, blocked_topk
from revrank.operators.ranking import top_k
from revrank.session import cores, cut, cut_wide

# Users who have seen more than this get lists of their own, by powers of LEVEL_STEP times as many.
LEVEL_SEEN, LEVEL_STEP = 128, 16
# Numbers of one table of marks.
MARKS = 1 << 23

Score = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _marked(df: DataFrame, key: str, vector: str, marks: Callable[[np.ndarray], np.ndarray], weight: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Written rows (id, mark, w, v): equal marks are one class."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.array(batch["v"].tolist(), np.float64)
            found, start = [], 0
            step = len(x[:1]) and max(1, MARKS // max(1, marks(x[:1]).shape[1]))
            while start < len(x):
                bits = np.packbits(marks(x[start : start + step]), axis=1)
                found += [hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in bits]
                start += step
            with np.errstate(all="ignore"):
                yield pd.DataFrame({"id": batch["id"], "mark": found, "w": weight(x), "v": batch["v"]})

    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    spread = rows.repartition(cores(df.sparkSession), "id")
    return cut(spread.mapInPandas(run, "id bigint, mark binary, w double, v array<double>"))


def class_topk(
    users: DataFrame,
    items: DataFrame,
    k: int,
    share: Score,
    user_marks: Callable[[np.ndarray], np.ndarray],
    item_marks: Callable[[np.ndarray], np.ndarray],
    weight: Callable[[np.ndarray], np.ndarray],
    seen: DataFrame | None = None,
) -> DataFrame:
    """Top-k of ``share(u, i) * weight(i)`` over ``users(user_idx, uvec)`` x ``items(item_idx, ivec)``.

    ``share`` gives the same number for all pairs of rows with equal ``user_marks`` and equal
    ``item_marks`` (0/1 tables, one row per vector). Ids are unique in each table. Scores
    that are not finite are left out, ties go to the smaller item id; a user with fewer than k unseen items gets
    fewer rows. Weights so close that their scores round to the same number count as different.
    """
    asked = _marked(users, "user_idx", "uvec", user_marks, lambda x: np.ones(len(x)))
    offered = _marked(items, "item_idx", "ivec", item_marks, weight)
    offered = offered.filter(~F.isnan("w") & (F.abs("w") < float("inf")))
    # The best item of a class where its share is positive, negative, zero.
    last = F.struct(F.col("id"), F.col("w"), F.col("v"))
    named = offered.groupBy("mark").agg(
        F.min("id").alias("class"), F.max_by(last, F.struct("w", -F.col("id"))).alias("high"),
        F.min_by(last, F.struct("w", "id")).alias("low"), F.min_by(last, "id").alias("zero"),
    )
    named = cut(named)
    firsts = named.select("class", F.explode(F.array_distinct(F.array(*[F.struct(F.col(c)["id"].alias("id"), F.col(c)["w"].alias("w")) for c in ("high", "low", "zero")]))).alias("f"))
    firsts = cut(firsts.select("class", F.col("f.id").alias("item_idx"), F.col("f.w").alias("w")))
    vectors = named.select("class", F.col("zero.v").alias("v"))
    weighed = firsts.join(vectors, "class").select("item_idx", F.concat("v", F.array("w")).alias("ivec"))
    members = cut(offered.select("id", "mark", "w").join(named.select("mark", "class"), "mark").select("class", F.col("id").alias("item_idx"), "w"))

    if seen is None:
        known = asked.select("id", F.array().cast("array<bigint>").alias("seen"))
    else:
        pairs = seen.select(F.col("user_idx").cast("bigint").alias("id"), F.col("item_idx").cast("bigint").alias("i"))
        known = pairs.groupBy("id").agg(F.collect_set("i").alias("seen"))
    # The filter is kept in a table: its lists are read again for every level.
    users_known = asked.select("id", "mark").join(known, "id", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<bigint>")))
    beyond = F.greatest(F.size("seen"), F.lit(LEVEL_SEEN)) / F.lit(float(LEVEL_SEEN))
    users_known = cut(users_known.withColumn("level", F.ceil(F.log(beyond) / F.log(F.lit(float(LEVEL_STEP))))))
    classes = asked.join(users_known.select("id", "level"), "id").groupBy("level", "mark").agg(F.min("id").alias("class"), F.min_by("v", "id").alias("v"))
    classes = cut(classes)

    def weighed_share(u: np.ndarray, i: np.ndarray) -> np.ndarray:
        return share(u, i[:, :-1]) * i[:, -1][None, :]

    out = None
    for row in users_known.groupBy("level").agg(F.max(F.size("seen")).alias("most")).orderBy("level").collect():
        level, length = row["level"], k + row["most"]
        ask = classes.filter(F.col("level") == level).select(F.col("class").alias("user_idx"), F.col("v").alias("uvec"))
        # Up to three firsts of a class, so these hold the firsts of the ``length`` best classes.
        best = cut(blocked_topk(ask, weighed, 3 * length, weighed_share))
        reach = best.filter(F.col("rank") == length).select("user_idx", F.col("relevance").alias("reach"))
        best = best.join(reach, "user_idx", "left").filter(F.col("reach").isNull() | (F.col("relevance") >= F.col("reach")))
        wanted = cut(best.join(firsts.drop("w"), "item_idx").select("user_idx", "class", "reach").distinct())
        shares = blocked_scores(
            ask, vectors.select(F.col("class").alias("item_idx"), F.col("v").alias("ivec")),
            wanted.select("user_idx", F.col("class").alias("item_idx")), share,
        )
        shares = shares.select("user_idx", F.col("item_idx").alias("class"), F.col("score").alias("share"))
        shares = cut_wide(shares.join(wanted, ["user_idx", "class"]).withColumn("turn", F.signum("share").cast("int")))
        turns = [r["turn"] for r in shares.select("turn").distinct().collect()]
        order = {1: F.col("w"), -1: -F.col("w"), 0: F.lit(0.0)}
        heads = None
        for turn in turns:
            head = top_k(members.withColumn("by", order[turn]), length, by="class", score="by").select("class", "item_idx", "w", F.lit(turn).alias("turn"))
            heads = head if heads is None else heads.unionByName(head)
        if heads is None:
            continue
        scored = shares.join(cut(heads), ["class", "turn"]).withColumn("relevance", F.col("share") * F.col("w"))
        scored = scored.filter((F.abs("relevance") < float("inf")) & (F.col("reach").isNull() | (F.col("relevance") >= F.col("reach"))))
        ranked = top_k(scored.select("user_idx", "item_idx", "relevance"), length)
        lists = ranked.groupBy("user_idx").agg(F.array_sort(F.collect_list(F.struct("rank", "item_idx", "relevance"))).alias("l"))
        lists = cut(lists.select(F.col("user_idx").alias("class"), F.col("l.item_idx").alias("items"), F.col("l.relevance").alias("scores")))
        own = users_known.filter(F.col("level") == level).join(classes.filter(F.col("level") == level).select("mark", "class"), "mark")
        found = own.join(lists, "class").select("id", "items", "scores", F.slice(F.array_except("items", "seen"), 1, k).alias("first"))
        score = F.transform("first", lambda x: F.struct(x.alias("item_idx"), F.get("scores", F.array_position("items", x).cast("int") - 1).alias("relevance")))
        rows = found.select(F.col("id").alias("user_idx"), F.posexplode(score).alias("rank", "s"))
        rows = rows.select("user_idx", "s.item_idx", "s.relevance", (F.col("rank") + 1).alias("rank"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return users.sparkSession.createDataFrame([], "user_idx bigint, item_idx bigint, relevance double, rank int")
    return out
