"""Exact top-k over all user-item pairs without a row per pair.

Users and items are packed into blocks of rows by a hash of the id. A task holds the
matrix of one user block and lets item blocks pass by: it multiplies, masks what was seen and
keeps the best k items of each user so far, so k rows per user leave it. Where user blocks are
fewer than cores, each is dealt out over slices of the item blocks. User vectors are shuffled
once (per slice), as rows; an item table whose size was measured to be small is broadcast. A larger
one meets the written user blocks in parts that are broadcast one after the other (``blocked_topk``) or
is shuffled once per group of user blocks. All users x items scores are computed,
unless the caller gives a bound of a block's scores. Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revrank.operators.ranking import top_k
from revrank.session import cut

USER_BLOCK = 512
ITEM_BLOCK = 4096
BROADCAST_BYTES = 64 << 20
USER_BLOCKS_PER_GROUP = 64

OUT = "user_idx bigint, item_idx bigint, relevance double"
_PAIR = ["ub", "slice", "uids", "umat", "iids", "imat", "seen_u", "seen_i"]


def dot_scores(u: np.ndarray, i: np.ndarray) -> np.ndarray:
    return u @ i.T


def best_of_row(scores: np.ndarray, item_ids: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of the k best finite scores, ties to the smaller item id.

    ``item_ids`` is ascending, so a stable sort keeps ties in id order.
    """
    if scores.size > k:
        kth = np.partition(scores, scores.size - k)[scores.size - k]
        cols = np.flatnonzero(scores >= kth)
    else:
        cols = np.arange(scores.size)
    cols = cols[np.isfinite(scores[cols])]
    return cols[np.argsort(-scores[cols], kind="stable")][:k]


def dot_bound(ulo: np.ndarray, uhi: np.ndarray, ilo: np.ndarray, ihi: np.ndarray) -> np.ndarray:
    """Largest inner product of any vector of a user box with any of an item box, (users, items)."""
    total = np.zeros((len(ulo), len(ilo)))
    for j in range(ulo.shape[1]):
        total += product_range(ulo[:, j, None], uhi[:, j, None], ilo[None, :, j], ihi[None, :, j])
    return total


def product_range(alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> np.ndarray:
    """Largest product of a number of [alo, ahi] and one of [blo, bhi]."""
    return np.maximum(np.maximum(alo * blo, alo * bhi), np.maximum(ahi * blo, ahi * bhi))


class _Best:
    """The k best items so far of each user of one block."""

    def __init__(self, key, uids: np.ndarray):
        self.key, self.uids = key, uids
        self.scores = np.zeros((len(uids), 0))
        self.items = np.zeros((len(uids), 0), np.int64)

    def add(self, scores: np.ndarray, iids: np.ndarray, k: int) -> None:
        together = np.concatenate((self.scores, scores), axis=1)
        ids = np.concatenate((self.items, np.broadcast_to(iids, scores.shape)), axis=1)
        kept_scores = np.full((len(self.uids), k), -np.inf)
        kept_items = np.full((len(self.uids), k), -1, np.int64)
        for n in range(len(self.uids)):
            order = np.argsort(ids[n], kind="stable")
            picks = order[best_of_row(together[n][order], ids[n][order], k)] if self.scores.shape[1] else best_of_row(
                scores[n], iids, k
            )
            kept_scores[n, : len(picks)], kept_items[n, : len(picks)] = together[n, picks], ids[n, picks]
        self.scores, self.items = kept_scores, kept_items

    def frame(self) -> pd.DataFrame:
        rows, places = np.nonzero(np.isfinite(self.scores))
        return pd.DataFrame(
            {"user_idx": self.uids[rows], "item_idx": self.items[rows, places], "relevance": self.scores[rows, places]}
        )


def _matrix(ids, values) -> tuple[np.ndarray, np.ndarray]:
    ids = np.asarray(ids)
    return ids, np.asarray(values, dtype=np.float64).reshape(len(ids), -1)


def _mask(scores: np.ndarray, uids: np.ndarray, iids: np.ndarray, seen_u: np.ndarray, seen_i: np.ndarray) -> None:
    at_u, at_i, here = _places(uids, iids, seen_u, seen_i)
    scores[at_u[here], at_i[here]] = -np.inf


def _places(uids: np.ndarray, iids: np.ndarray, us: np.ndarray, its: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and column of each pair in a block, and whether the block holds it."""
    at_u, at_i = np.searchsorted(uids, us), np.searchsorted(iids, its)
    at_u[at_u == len(uids)], at_i[at_i == len(iids)] = 0, 0
    return at_u, at_i, (uids[at_u] == us) & (iids[at_i] == its)


def _score_blocks(scorer: Callable, k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for batch in batches:
            for row in batch.itertuples(index=False):
                uids, u = _matrix(row.uids, row.umat)
                iids, i = _matrix(row.iids, row.imat)
                scores = np.array(scorer(u, i), dtype=np.float64)
                if len(row.seen_u):
                    _mask(scores, uids, iids, np.asarray(row.seen_u), np.asarray(row.seen_i))
                if best is None or best.key != (row.ub, row.slice):
                    if best is not None:
                        yield best.frame()
                    best = _Best((row.ub, row.slice), uids)
                best.add(scores, iids, k)
        if best is not None:
            yield best.frame()

    return run


def _block_pairs(
    users: DataFrame, items: DataFrame, seen: DataFrame | None, user_block: int, item_block: int, broadcast_bytes: int,
    counted: tuple[int, int | None] | None = None,
) -> DataFrame:
    """Rows (ub, slice, uids, umat, seen_u, seen_i, iids, imat): a user block and one of its item blocks."""
    cores = _cores(users)
    n_users = users.agg(F.count("*")).first()[0]
    n_items, width = counted or _counted(items)
    item_blocks = max(1, -(-n_items // item_block))
    small = n_items * ((width or 0) + 1) * 8 <= broadcast_bytes
    if small:
        user_blocks, slices = _dealt(n_users, user_block, item_blocks, cores)
    else:
        user_blocks, slices = max(1, -(-n_users // user_block)), item_blocks
    packed = _packed_users(users, seen, user_blocks, item_blocks, slices, cores)
    right = _packed_items(items, item_blocks, slices).drop("ib")
    if small:
        return packed.join(F.broadcast(right), "slice")
    groups = -(-user_blocks // USER_BLOCKS_PER_GROUP)
    spread = right.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return packed.withColumn("grp", F.pmod("ub", F.lit(groups))).join(spread, ["slice", "grp"]).drop("grp")


def _counted(items: DataFrame) -> tuple[int, int | None]:
    """Rows, and numbers of the longest vector."""
    n, width = items.agg(F.count("*"), F.max(F.size("ivec"))).first()
    return n, width


def _cores(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _dealt(n_users: int, user_block: int, item_blocks: int, cores: int) -> tuple[int, int]:
    """Numbers of user blocks and of slices of the item blocks that give every core something."""
    user_blocks = max(1, -(-n_users // user_block))
    slices = min(item_blocks, -(-2 * cores // user_blocks))
    if user_blocks < 2 * cores:
        # Few users: smaller user blocks give every core something, at the cost of more products.
        user_blocks = min(max(1, n_users), max(user_blocks, -(-2 * cores // slices)))
    return user_blocks, slices


def _hashed(column: str, n: int):
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def _packed_users(users: DataFrame, seen: DataFrame | None, user_blocks: int, item_blocks: int, slices: int, cores: int) -> DataFrame:
    """(ub, slice, uids, umat, seen_u, seen_i): a block's vectors and its seen pairs of a slice."""
    left = users.select(
        _hashed("user_idx", user_blocks).alias("ub"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
        F.struct(F.col("user_idx").alias("id"), F.col("uvec").alias("v")).alias("vec"),
        F.lit(None).cast("struct<u:bigint,i:bigint>").alias("pair"),
    )
    if seen is not None:
        known = seen.select(
            _hashed("user_idx", user_blocks).alias("ub"), F.pmod(_hashed("item_idx", item_blocks), F.lit(slices)).alias("slice"),
            F.lit(None).cast(left.schema["vec"].dataType).alias("vec"),
            F.struct(F.col("user_idx").cast("bigint").alias("u"), F.col("item_idx").cast("bigint").alias("i")).alias("pair"),
        )
        left = left.unionByName(known)
    # One exchange brings a block's vectors and its seen pairs together; its number of partitions
    # is given, so that adaptive execution does not merge blocks of few bytes into one task.
    dealt = left.repartition(min(user_blocks * slices, 8 * cores), "ub", "slice")
    packed = dealt.groupBy("ub", "slice").agg(
        F.sort_array(F.collect_list("vec")).alias("__rows"), F.collect_list("pair").alias("__seen")
    ).filter(F.size("__rows") > 0)
    return packed.select(
        "ub", "slice", F.col("__rows.id").alias("uids"), F.flatten("__rows.v").alias("umat"),
        F.col("__seen.u").alias("seen_u"), F.col("__seen.i").alias("seen_i"),
    )


def _packed_items(items: DataFrame, item_blocks: int, slices: int) -> DataFrame:
    """(ib, slice, iids, imat)."""
    return (
        items.select(_hashed("item_idx", item_blocks).alias("ib"), F.struct(F.col("item_idx").alias("id"), F.col("ivec").alias("v")).alias("vec"))
        .groupBy("ib").agg(F.sort_array(F.collect_list("vec")).alias("__rows"))
        .select("ib", F.pmod("ib", F.lit(slices)).alias("slice"), F.col("__rows.id").alias("iids"), F.flatten("__rows.v").alias("imat"))
    )


def _best_by_parts(
    users: DataFrame, items: DataFrame, k: int, scorer: Callable, seen: DataFrame | None,
    user_block: int, item_block: int, broadcast_bytes: int, n_items: int, width: int,
) -> DataFrame:
    """Best k of each user and part of an item table too large to broadcast whole.

    User blocks are written once and read for every part, so neither they nor the items are copied in a shuffle.
    """
    cores, n_users = _cores(users), users.agg(F.count("*")).first()[0]
    item_blocks = -(-n_items // item_block)
    # Blocks of items, by hash of the id, that are broadcast together.
    together = max(1, broadcast_bytes // (item_block * (width + 1) * 8))
    user_blocks, slices = _dealt(n_users, user_block, min(item_blocks, together), cores)
    packed = cut(_packed_users(users, seen, user_blocks, item_blocks, slices, cores))
    right = cut(_packed_items(items, item_blocks, slices))
    out = None
    for start in range(0, item_blocks, together):
        part = right.filter((F.col("ib") >= start) & (F.col("ib") < start + together)).drop("ib")
        found = cut(packed.join(F.broadcast(part), "slice").select(*_PAIR).mapInPandas(_score_blocks(scorer, k), OUT))
        out = found if out is None else out.unionByName(found)
    return out


def blocked_topk(
    users: DataFrame,
    items: DataFrame,
    k: int,
    scorer: Callable[[np.ndarray, np.ndarray], np.ndarray] = dot_scores,
    seen: DataFrame | None = None,
    user_block: int = USER_BLOCK,
    item_block: int = ITEM_BLOCK,
    broadcast_bytes: int = BROADCAST_BYTES,
    bound: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """Top-k of ``scorer`` over ``users(user_idx, uvec)`` x ``items(item_idx, ivec)``.

    ``scorer`` gets a (users, d) and an (items, d') matrix and returns the score
    matrix. Seen pairs are masked before the cut; a user with fewer than k items left gets
    fewer rows.

    ``bound(ulo, uhi, ilo, ihi)`` gives a (user boxes, item boxes) matrix that no score of the
    boxes' rows exceeds, rounding aside. With it, blocks hold neighbouring vectors and only blocks that can
    reach a user's k-th best score are multiplied (``revrank.operators.pruned``); the rows are the same.
    """
    if bound is not None:
        from revrank.operators.pruned import pruned_topk

        return pruned_topk(users, items, k, scorer, bound, seen)
    n_items, width = _counted(items)
    if n_items * ((width or 0) + 1) * 8 > broadcast_bytes:
        return top_k(_best_by_parts(users, items, k, scorer, seen, user_block, item_block, broadcast_bytes, n_items, width or 0), k)
    pairs = _block_pairs(users, items, seen, user_block, item_block, broadcast_bytes, (n_items, width))
    return top_k(pairs.select(*_PAIR).mapInPandas(_score_blocks(scorer, k), OUT), k)


def blocked_scores(
    users: DataFrame, items: DataFrame, pairs: DataFrame, scorer: Callable[[np.ndarray, np.ndarray], np.ndarray] = dot_scores
) -> DataFrame:
    """(user_idx, item_idx, score) of distinct ``pairs``. Blocks that hold one are multiplied whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                if not len(row.seen_u):
                    continue
                uids, u = _matrix(row.uids, row.umat)
                iids, i = _matrix(row.iids, row.imat)
                at_u, at_i, here = _places(uids, iids, np.asarray(row.seen_u), np.asarray(row.seen_i))
                if here.any():
                    scores = np.asarray(scorer(u, i), dtype=np.float64)[at_u[here], at_i[here]]
                    yield pd.DataFrame({"user_idx": uids[at_u[here]], "item_idx": iids[at_i[here]], "score": scores})

    blocks = _block_pairs(users, items, pairs, USER_BLOCK, ITEM_BLOCK, BROADCAST_BYTES)
    return blocks.select("uids", "umat", "iids", "imat", "seen_u", "seen_i").mapInPandas(run, "user_idx bigint, item_idx bigint, score double")


def blocked_logsumexp(
    users: DataFrame,
    items: DataFrame,
    scorer: Callable[[np.ndarray, np.ndarray], np.ndarray] = dot_scores,
    user_block: int = USER_BLOCK,
    item_block: int = ITEM_BLOCK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(user_idx, lse): log of the summed exp(score) over all items, the softmax denominator."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                u = np.asarray(row.umat, dtype=np.float64).reshape(len(row.uids), -1)
                i = np.asarray(row.imat, dtype=np.float64).reshape(len(row.iids), -1)
                scores = scorer(u, i)
                top = scores.max(axis=1)
                yield pd.DataFrame(
                    {"user_idx": row.uids, "top": top, "total": np.exp(scores - top[:, None]).sum(axis=1)}
                )

    pairs = _block_pairs(users, items, None, user_block, item_block, broadcast_bytes)
    parts = pairs.select("uids", "umat", "iids", "imat").mapInPandas(run, "user_idx bigint, top double, total double")
    peak = F.max("top")
    scaled = F.collect_list(F.struct("top", "total"))
    # One entry per item block and user.
    return parts.groupBy("user_idx").agg(peak.alias("top"), scaled.alias("parts")).select(
        "user_idx",
        (
            F.col("top")
            + F.log(F.aggregate("parts", F.lit(0.0), lambda s, p: s + p["total"] * F.exp(p["top"] - F.col("top"))))
        ).alias("lse"),
    )


def blocked_softmax_gradients(
    states: DataFrame,
    items: DataFrame,
    d: int,
    n: int,
    user_block: int = USER_BLOCK,
    item_block: int = ITEM_BLOCK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, is_row, v, loss): gradients of the mean cross-entropy over ``n`` rows, in parts to be added up.

    ``states``: row, target (an item), h, lse (log of the softmax denominator). A row's part is
    the gradient in its h, an item's part that in its vector; an item's parts are summed over all
    states of a task. A task holds sums for ``broadcast_bytes`` of items and hands them on beyond.
    """
    most = max(1, broadcast_bytes // (8 * d * item_block))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, list] = {}
        key, uids, own, loss = None, None, None, 0.0

        def rows() -> pd.DataFrame:
            return pd.DataFrame({"id": uids, "is_row": True, "v": list(own), "loss": 0.0})

        def item_sums() -> Iterator[pd.DataFrame]:
            for iids, total, part in sums.values():
                losses = np.zeros(len(iids))
                losses[0] = part
                yield pd.DataFrame({"id": iids, "is_row": False, "v": list(total), "loss": losses})
            sums.clear()

        for batch in batches:
            for row in batch.itertuples(index=False):
                ids, u = _matrix(row.uids, row.umat)
                iids, i = _matrix(row.iids, row.imat)
                h, lse, target = u[:, :d], u[:, d], u[:, d + 1].astype(np.int64)
                logits = h @ i.T
                p = np.exp(logits - lse[:, None])
                at = np.minimum(np.searchsorted(iids, target), len(iids) - 1)
                hit = np.flatnonzero(iids[at] == target)
                p[hit, at[hit]] -= 1.0
                p /= n
                loss = float((lse[hit] - logits[hit, at[hit]]).sum()) / n
                if key != (row.ub, row.slice):
                    if key is not None:
                        yield rows()
                    key, uids, own = (row.ub, row.slice), ids, np.zeros((len(ids), d))
                own += p @ i
                name = (int(iids[0]), len(iids))
                if name not in sums:
                    if len(sums) >= most:
                        yield from item_sums()
                    sums[name] = [iids, np.zeros((len(iids), d)), 0.0]
                sums[name][1] += p.T @ h
                sums[name][2] += loss
        if key is not None:
            yield rows()
        yield from item_sums()

    packed = states.select(
        F.col("row").alias("user_idx"), F.concat("h", F.array("lse", F.col("target").cast("double"))).alias("uvec")
    )
    pairs = _block_pairs(packed, items, None, user_block, item_block, broadcast_bytes)
    columns = "id bigint, is_row boolean, v array<double>, loss double"
    return pairs.select("ub", "slice", "uids", "umat", "iids", "imat").mapInPandas(run, columns)
