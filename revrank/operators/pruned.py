"""Exact top-k that leaves out item blocks no user of a block can want.

Users and items are dealt to blocks of neighbouring vectors by a k-d tree over a sample of them; the
sample decides where to cut, never what is scored. Every block has the box of its own rows, and
a bound says how much a user box can score in an item box. A user block first meets the blocks of
highest bound, with as many items as its users have seen and k more, which gives each user a k-th best score.
Then it meets every block that can reach that score. Blocks meet by joins on the block number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.operators.ranking import top_k
from revrank.session import cores, cut

USER_BLOCK = 512
ITEM_BLOCK = 256
# Item blocks a user block meets first, at least.
FIRST_BLOCKS = 4
# Vectors that decide on the cuts, and how many of them a cell holds at least.
SAMPLE_ROWS = 100_000
CELL_SAMPLE = 8
# Scores of one matrix, kept pairs before they are cut to k a user, and user boxes x item boxes looked at one by one.
SCORES = 1 << 21
KEPT = 1 << 21
SINGLE_BOUNDS = 1 << 20
# Bounds and scores are rounded differently.
SLACK = 1e-9

OUT = "user_idx bigint, item_idx bigint, relevance double"


def _cuts(sample: np.ndarray, cells: int) -> list[tuple]:
    """Nodes (column, threshold, node if <=, node if >) of a k-d tree; a node of column -1 is cell ``threshold``."""
    scale = sample.std(axis=0) if len(sample) else np.zeros(0)
    scale = np.where(scale > 0, scale, 1.0)
    nodes: list[tuple] = []
    n_cells = 0

    def grow(rows: np.ndarray, wanted: int) -> int:
        nonlocal n_cells
        at = len(nodes)
        nodes.append(())
        width = np.ptp(rows, axis=0) / scale if len(rows) else np.zeros(0)
        if wanted < 2 or len(rows) < 2 * CELL_SAMPLE or not width.any():
            nodes[at] = (-1, float(n_cells), 0, 0)
            n_cells += 1
            return at
        column = int(width.argmax())
        values = np.sort(rows[:, column])
        threshold = values[(len(values) - 1) // 2]
        if threshold == values[-1]:
            threshold = values[np.searchsorted(values, threshold) - 1]
        low = rows[:, column] <= threshold
        left = min(wanted - 1, max(1, round(wanted * low.mean())))
        nodes[at] = (column, float(threshold), grow(rows[low], left), grow(rows[~low], wanted - left))
        return at

    grow(sample, cells)
    return nodes


def _cell_of(x: np.ndarray, nodes: list[tuple]) -> np.ndarray:
    """Cell of each row; -1 where a component is not finite."""
    columns, thresholds = np.array([n[0] for n in nodes]), np.array([n[1] for n in nodes])
    below, above = np.array([n[2] for n in nodes]), np.array([n[3] for n in nodes])
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while (inner := columns[at] >= 0).any():
        here = rows[inner]
        now = at[here]
        at[here] = np.where(x[here, columns[now]] <= thresholds[now], below[now], above[now])
    return np.where(np.isfinite(x).all(axis=1), thresholds[at].astype(np.int64), -1)


def _stack(vectors: pd.Series, width: int) -> np.ndarray:
    if not len(vectors):
        return np.zeros((0, width))
    return np.array([np.full(width, np.nan) if v is None else v for v in vectors], dtype=np.float64).reshape(-1, width)


def _blocked(df: DataFrame, key: str, vector: str, block: int) -> tuple[DataFrame, DataFrame]:
    """Written (block, id) of all rows, and (block, ids, mat): the rows packed, ids ascending."""
    df = cut(df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")))
    n, width = df.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(1, width or 1)
    drawn = df.sample(min(1.0, SAMPLE_ROWS / max(1, n)), seed=7).select("v").toPandas()
    sample = _stack(drawn["v"], width)
    cells = max(1, -(-n // block))
    nodes = _cuts(sample[np.isfinite(sample).all(axis=1)], cells)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _stack(batch["v"], width)
            yield pd.DataFrame({"cell": _cell_of(x, nodes), "id": batch["id"], "v": batch["v"]})

    spread = df.repartition(max(cores(df.sparkSession), -(-n // 100_000)), "id")
    dealt = cut(spread.mapInPandas(deal, "cell bigint, id bigint, v array<double>"))
    # A cell of more rows than a block, say of equal vectors, is several blocks of about that size.
    parts = dealt.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(block)).alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    dealt = cut(dealt.join(cut(parts), "cell").select(F.xxhash64("cell", part).alias("block"), "id", "v"))
    rows = F.sort_array(F.collect_list(F.struct("id", "v")))
    packed = dealt.groupBy("block").agg(rows.alias("r")).select("block", F.col("r.id").alias("ids"), F.flatten("r.v").alias("mat"))
    return dealt.select("block", "id"), cut(packed)


def _reduced(k: int, at: np.ndarray, ids: np.ndarray, scores: np.ndarray, seen: np.ndarray, seen_ids: np.ndarray):
    """The k best unseen pairs of each user number, best first, ties to the smaller item id."""
    if len(seen) and len(at):
        # Numbers of the items at hand make one number of a pair.
        known, place = np.unique(ids, return_inverse=True)
        where = np.minimum(np.searchsorted(known, seen_ids), len(known) - 1)
        here = known[where] == seen_ids
        open_ = ~np.isin(at * len(known) + place, seen[here] * len(known) + where[here])
        at, ids, scores = at[open_], ids[open_], scores[open_]
    order = np.lexsort((ids, -scores, at))
    at, ids, scores = at[order], ids[order], scores[order]
    first = np.searchsorted(at, at)
    kept = np.arange(len(at)) - first < k
    return at[kept], ids[kept], scores[kept]


def _best_pairs(scorer: Callable, k: int, left: pd.DataFrame, right: pd.DataFrame):
    """(user ids, user numbers, item ids, scores, reached): best pairs of one user block in some item blocks."""
    row = left.iloc[0]
    uids = np.asarray(row["ids"])
    u = np.asarray(row["mat"], np.float64).reshape(len(uids), -1)
    seen_u, seen_i = np.asarray(row["seen_u"], np.int64), np.asarray(row["seen_i"], np.int64)
    seen = np.searchsorted(uids, seen_u)
    reached = np.full(len(uids), -np.inf) if row["reached"] is None else np.array(row["reached"], np.float64)
    at, ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    held: list[tuple] = []
    size = 0
    beyond = k + (int(np.bincount(seen).max()) if len(seen) else 0)

    def settle() -> None:
        nonlocal at, ids, scores, size, reached
        parts = [(at, ids, scores), *held]
        at, ids, scores = _reduced(k, *[np.concatenate([p[n] for p in parts]) for n in range(3)], seen, seen_i)
        held.clear()
        size = 0
        last = np.flatnonzero(np.bincount(at, minlength=len(uids)) >= k)
        ends = np.searchsorted(at, last, side="right") - 1
        reached[last] = np.maximum(reached[last], scores[ends])

    iids = np.concatenate([np.asarray(v) for v in right["iids"]]) if len(right) else np.zeros(0, np.int64)
    if len(iids):
        i = np.concatenate([np.asarray(v, np.float64) for v in right["imat"]]).reshape(len(iids), -1)
        step = max(1, SCORES // len(uids))
        for start in range(0, len(iids), step):
            s = np.array(scorer(u, i[start : start + step]), dtype=np.float64)
            s[~np.isfinite(s)] = -np.inf
            if s.shape[1] > beyond:
                # Among so many scores k are unseen, whatever the user has seen.
                reached = np.maximum(reached, np.partition(s, s.shape[1] - beyond, axis=1)[:, s.shape[1] - beyond])
            rows, cols = np.nonzero((s >= reached[:, None]) & (s > -np.inf))
            held.append((rows, iids[start + cols], s[rows, cols]))
            size += len(rows)
            if size > KEPT:
                settle()
    settle()
    return uids, at, ids, scores, reached


def pruned_topk(
    users: DataFrame,
    items: DataFrame,
    k: int,
    scorer: Callable[[np.ndarray, np.ndarray], np.ndarray],
    bound: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    seen: DataFrame | None = None,
    user_block: int = USER_BLOCK,
    item_block: int = ITEM_BLOCK,
) -> DataFrame:
    """``blocked_topk`` with a bound; ids are unique in ``users`` and in ``items``."""
    spark = users.sparkSession
    user_rows, user_blocks = _blocked(users, "user_idx", "uvec", user_block)
    _item_rows, item_blocks = _blocked(items, "item_idx", "ivec", item_block)
    if seen is None:
        blocks = user_blocks.withColumns(
            {"seen_u": F.array().cast("array<bigint>"), "seen_i": F.array().cast("array<bigint>"), "most_seen": F.lit(0).cast("bigint")}
        )
    else:
        pairs = seen.select(F.col("user_idx").cast("bigint").alias("id"), F.col("item_idx").cast("bigint").alias("i"))
        by_user = pairs.groupBy("id").agg(F.collect_list("i").alias("i")).join(user_rows, "id")
        one = F.struct(F.col("id").alias("u"), F.col("i"))
        by_block = by_user.groupBy("block").agg(F.collect_list(one).alias("s"), F.max(F.size("i")).cast("bigint").alias("most_seen"))
        by_block = by_block.select(
            "block", F.flatten(F.transform("s", lambda p: F.array_repeat(p["u"], F.size(p["i"])))).alias("seen_u"),
            F.flatten("s.i").alias("seen_i"), "most_seen",
        )
        none = F.array().cast("array<bigint>")
        blocks = user_blocks.join(by_block, "block", "left").withColumns({
            "seen_u": F.coalesce("seen_u", none), "seen_i": F.coalesce("seen_i", none), "most_seen": F.coalesce("most_seen", F.lit(0)),
        })
    tasks = max(8 * cores(spark), 1)
    blocks = cut(blocks.repartition(tasks, "block"))

    def box(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, mat, name in zip(batch["ids"], batch["mat"], batch["block"]):
                x = np.asarray(mat, np.float64).reshape(len(ids), -1)
                yield pd.DataFrame({"block": [name], "n": [len(ids)], "lo": [x.min(axis=0)], "hi": [x.max(axis=0)]})

    # One row per item block: what the choice of blocks needs of the items.
    boxes = item_blocks.mapInPandas(box, "block bigint, n bigint, lo array<double>, hi array<double>").toPandas()
    shared = spark.sparkContext.broadcast(
        (boxes["block"].to_numpy(np.int64), boxes["n"].to_numpy(np.int64),
         np.array(boxes["lo"].tolist(), np.float64), np.array(boxes["hi"].tolist(), np.float64))
    )

    def limits(ulo: np.ndarray, uhi: np.ndarray, ilo: np.ndarray, ihi: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            most = np.asarray(bound(ulo, uhi, ilo, ihi), np.float64)
        return np.where(np.isnan(most), np.inf, most + SLACK * (1.0 + np.abs(most)))

    def chosen(first: bool) -> Callable:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names, counts, ilo, ihi = shared.value
            for batch in batches:
                for row in batch.itertuples(index=False):
                    u = np.asarray(row.mat, np.float64).reshape(len(row.ids), -1)
                    if not len(names):
                        continue
                    most = limits(u.min(axis=0)[None], u.max(axis=0)[None], ilo, ihi)[0]
                    if first:
                        order = np.argsort(-most, kind="stable")
                        enough = max(FIRST_BLOCKS, int(np.searchsorted(np.cumsum(counts[order]), k + row.most_seen)) + 1)
                        yield pd.DataFrame({"block": row.block, "ib": names[order[:enough]]})
                        continue
                    reached = np.asarray(row.reached, np.float64)
                    wanted = np.flatnonzero(most >= reached.min())
                    points, number = np.unique(u, axis=0, return_inverse=True)
                    if 1 < len(points) and len(points) * len(wanted) <= SINGLE_BOUNDS:
                        least = np.full(len(points), np.inf)
                        np.minimum.at(least, number.reshape(-1), reached)
                        single = limits(points, points, ilo[wanted], ihi[wanted])
                        wanted = wanted[(single >= least[:, None]).any(axis=0)]
                    yield pd.DataFrame({"block": row.block, "ib": names[wanted]})

        return run

    right = item_blocks.select(F.col("block").alias("ib"), F.col("ids").alias("iids"), F.col("mat").alias("imat"))

    def met(asked: DataFrame, first: bool, fn: Callable, out: str) -> DataFrame:
        pairs = asked.mapInPandas(chosen(first), "block bigint, ib bigint")
        brought = pairs.join(right, "ib").drop("ib").repartition(tasks, "block")
        return asked.repartition(tasks, "block").groupBy("block").cogroup(brought.groupBy("block")).applyInPandas(fn, out)

    def reach(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({"block": [], "reached": []})
        reached = _best_pairs(scorer, k, left, right)[4]
        return pd.DataFrame({"block": [left["block"].iloc[0]], "reached": [reached]})

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({"user_idx": [], "item_idx": [], "relevance": []})
        uids, at, ids, scores, _ = _best_pairs(scorer, k, left, right)
        return pd.DataFrame({"user_idx": uids[at], "item_idx": ids, "relevance": scores})

    unknown = blocks.withColumn("reached", F.lit(None).cast("array<double>"))
    reached = cut(met(unknown, True, reach, "block bigint, reached array<double>"))
    return top_k(met(blocks.join(reached, "block"), False, best, OUT), k)
