"""Exact top-k inner products with buckets of similar length.

Vectors are grouped by length. For a query and a bucket, the k-th best score so far gives
the cosine a candidate of the bucket must reach: above 1 the bucket is skipped; a high one
is checked on single coordinates, a low one by length alone. What is left is multiplied out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revrank.session import cut

# A bucket's lengths differ by at most this factor.
LENGTH_STEP = 1.1
BLOCK_ROWS = 2048
# From this cosine on, coordinates prune; below, lengths do.
COORDINATES_FROM = 0.5
FOCUS = 4
# Scores are 64-bit integers; these two values stand for those beyond.
BELOW, ABOVE = -(1 << 63), (1 << 63) - 1


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, x array of whole doubles, norm) of the vectors that take part; exact copies of a row once."""

    def whole(v):
        # From 2^53 on every double is a whole number; floor() gives a bigint.
        return F.when(F.abs(v) < 2.0**62, F.floor(v).cast("double")).otherwise(v)

    scaled = F.transform(F.col(vector), lambda v: whole(v.cast("double") * scale))
    # NaN compares as larger than every number.
    usable = F.col(vector).isNotNull() & F.forall(
        F.col(vector), lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf"))
    )
    rows = vectors.filter(F.coalesce(usable, F.lit(False)) & F.col(key).isNotNull())
    rows = rows.select(F.col(key).alias("vec_id"), scaled.alias("x")).distinct()
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
    too_long = F.raise_error(F.lit("a vector's length is beyond double")).cast("double")
    return rows.withColumn("norm", F.when(norm < float("inf"), norm).otherwise(too_long))


def _blocks(rows: DataFrame, name: str, bucketed: bool) -> DataFrame:
    """Rows packed into matrices of about BLOCK_ROWS rows: (name, top, n, dims, ids, norms, matrix).

    A bucket with many rows, as when all lengths are equal, is split by a digest of the id
    into as many blocks as its count asks for.
    """
    bucket = F.floor(F.log(F.greatest("norm", F.lit(1.0))) / float(np.log(LENGTH_STEP))).cast("int") if bucketed else F.lit(0)
    rows = rows.withColumn("bucket", bucket)
    counts = cut(rows.groupBy("bucket").agg(F.count("*").alias("rows")))
    part = F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("rows") / BLOCK_ROWS))
    parts = rows.join(counts, "bucket").withColumn("part", part).drop("rows")

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["norm", "vec_id"], ascending=[False, True], kind="stable")
        dims = int(frame["x"].map(len).max())
        matrix = np.zeros((len(frame), dims))
        for i, x in enumerate(frame["x"]):
            matrix[i, : len(x)] = x
        top = float(frame["norm"].max())
        return pd.DataFrame({
            "id": [f"{frame['bucket'].iat[0]}/{frame['part'].iat[0]}"], "top": [top], "n": [len(frame)], "dims": [dims],
            "ids": [frame["vec_id"].to_numpy(np.int64).tobytes()], "norms": [frame["norm"].to_numpy(np.float64).tobytes()],
            "matrix": [matrix.tobytes()],
        })

    packed = parts.groupBy("bucket", "part").applyInPandas(
        pack, "id string, top double, n int, dims int, ids binary, norms binary, matrix binary"
    )
    return cut(packed.select([F.col(c).alias(f"{name}_{c}") for c in packed.columns]))


def _matrix(row, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, dims = getattr(row, f"{name}_n"), getattr(row, f"{name}_dims")
    matrix = np.frombuffer(getattr(row, f"{name}_matrix"), np.float64).reshape(n, dims)
    return np.frombuffer(getattr(row, f"{name}_ids"), np.int64), np.frombuffer(getattr(row, f"{name}_norms"), np.float64), matrix


def _products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Exact products of whole numbers, as BELOW or ABOVE where they leave 64 bits.

    ``bound``, the product of the largest lengths, limits every partial sum. Doubles do below
    2^52. Above, 64-bit sums are right but for multiples of 2^64, and rounded sums tell where
    those may be missing; there Python's integers decide.
    """
    rough = a @ b.T
    if bound < 2.0**52:
        return rough.astype(np.int64)
    error = bound * (a.shape[1] + 8) * 2.0**-52
    sure = np.abs(rough) + error < 2.0**63
    scores = np.where(rough > 0, ABOVE, BELOW)
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < 2.0**63:
        scores[sure] = (a.astype(np.int64) @ b.astype(np.int64).T)[sure]
    else:
        sure[:] = False
    for i, j in zip(*np.nonzero(~sure & (np.abs(rough) - error < 2.0**63))):
        scores[i, j] = min(max(sum(int(x) * int(y) for x, y in zip(a[i], b[j])), BELOW), ABOVE)
    return scores


def search_block(query, candidate, least: dict[int, float], k: int) -> list[tuple[int, int, int]]:
    """(query, candidate, score) that may be among the best k, from one pair of blocks."""
    q_ids, q_norms, q = _matrix(query, "q")
    c_ids, c_norms, c = _matrix(candidate, "c")
    dims = max(q.shape[1], c.shape[1])
    q = np.pad(q, ((0, 0), (0, dims - q.shape[1])))
    c = np.pad(c, ((0, 0), (0, dims - c.shape[1])))
    if not dims:
        q, c = np.zeros((len(q_ids), 1)), np.zeros((len(c_ids), 1))
    bound = np.array([least.get(int(i), -np.inf) for i in q_ids])
    top = float(c_norms[0])
    reach = q_norms * top
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(reach > 0, bound / np.where(reach > 0, reach, 1), np.where(bound > 0, 2.0, -1.0))
    # Rounding must never prune: everything gets a little room.
    cosine = cosine - 1e-9
    found: list[tuple[int, int, int]] = []

    def keep(i: int, at: np.ndarray, scores: np.ndarray) -> None:
        right = (c_ids[at] != q_ids[i]) & (scores >= bound[i])
        at, scores = at[right], scores[right]
        if len(at) and scores.max() == ABOVE:
            raise OverflowError(f"a best score of vector {q_ids[i]} does not fit bigint")
        if len(at) > k:
            # All that tie with the k-th stay for the order by id.
            least_kept = np.partition(scores, len(scores) - k)[len(scores) - k]
            at, scores = at[scores >= least_kept], scores[scores >= least_kept]
        order = np.lexsort((c_ids[at], ~scores))[:k]
        found.extend((int(q_ids[i]), int(c_ids[at[j]]), int(scores[j])) for j in order)

    by_length = np.flatnonzero((cosine <= 1) & (cosine < COORDINATES_FROM))
    for start in range(0, len(by_length), 256):
        mine = by_length[start : start + 256]
        with np.errstate(divide="ignore", invalid="ignore"):
            shortest = np.where(bound[mine] > 0, bound[mine] / q_norms[mine] * (1 - 1e-9), 0.0).min()
        prefix = int(np.searchsorted(-c_norms, -shortest, side="right"))
        scores = _products(q[mine], c[:prefix], float(q_norms[mine].max() * top))
        for row, i in enumerate(mine):
            keep(i, np.arange(prefix), scores[row])

    by_coordinate = np.flatnonzero((cosine <= 1) & (cosine >= COORDINATES_FROM))
    if len(by_coordinate):
        unit = c / np.where(c_norms > 0, c_norms, 1)[:, None]
        columns = np.ascontiguousarray(unit.T)
        for i in by_coordinate:
            own = q[i] / q_norms[i]
            t = cosine[i]
            at = None
            for f in np.argsort(-np.abs(own))[:FOCUS]:
                middle = own[f] * t
                room = np.sqrt(max(0.0, (1 - own[f] ** 2) * (1 - t * t))) + 1e-9
                # A candidate at cosine >= t lies in this range, or beyond it on the query's side.
                low = -1.0 if own[f] <= -t else middle - room
                high = 1.0 if own[f] >= t else middle + room
                values = columns[f] if at is None else columns[f][at]
                inside = np.flatnonzero((values >= low) & (values <= high))
                at = inside if at is None else at[inside]
            if len(at):
                keep(i, at, _products(q[i : i + 1], c[at], float(q_norms[i] * top))[0])
    return found


FOUND = "query_id bigint, vec_id bigint, score bigint"


def _search(pairs: DataFrame, k: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                least = dict(zip(np.frombuffer(row.least_ids, np.int64).tolist(), np.frombuffer(row.least, np.float64).tolist()))
                yield pd.DataFrame(search_block(row, row, least, k), columns=["query_id", "vec_id", "score"])

    return pairs.mapInPandas(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, k: int = 5, scale: int = 256, every: int = 50, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` the best k others.

    Components become floor(scale * x); the score is their inner product, exact at any length.
    A score among the best k that does not fit bigint is an error. Vectors that are null or hold
    null, NaN or infinite components take no part, nor do rows with a null id. Vectors of different length are compared as if padded with zeros.
    Rows equal in id and vector count once; a row with the query's id is never its result.
    Ties go to the smaller id. Fewer than k others give fewer rows, an empty table none.

    Blocks of queries meet blocks of candidates, never row with row: first each block of
    queries meets the longest block, whose scores bound what the other blocks must reach.
    Then only pairs of blocks are joined in which some query can still improve.
    """
    rows = cut(quantised(vectors, key, vector, scale))
    candidates = _blocks(rows, "c", bucketed=True)
    queries = _blocks(rows.filter(F.col("vec_id") % every == 0), "q", bucketed=False)
    no_bounds = [F.lit(b"").alias("least_ids"), F.lit(b"").alias("least")]

    # Names and lengths of the candidate blocks: one small row per BLOCK_ROWS vectors.
    heads = candidates.select("c_id", "c_top")
    longest = heads.orderBy(F.desc("c_top"), "c_id").limit(1)
    seeds = [r["c_id"] for r in longest.collect()]
    if not seeds:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    seed = candidates.filter(F.col("c_id") == seeds[0])
    first_pairs = queries.withColumn("c_id", F.lit(seeds[0])).join(seed, "c_id").select("*", *no_bounds)
    first = cut(_best(_search(first_pairs, k), k))

    bounds = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).filter(F.col("n") == k)
    asked = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "norm")
    counted = asked.agg(F.count("*")).first()[0]
    part = F.pmod(F.xxhash64("query_id"), F.ceil(F.lit(counted) / BLOCK_ROWS))
    limits = asked.join(bounds, "query_id", "left").withColumn("q_id", F.concat(F.lit("0/"), part.cast("string")))
    # The least length with which a candidate can still matter to some query of the block.
    need = F.when(F.col("least").isNull(), -1.0).when(F.col("least") > 0, F.col("least") / F.greatest("norm", F.lit(1e-9)) * (1 - 1e-9)).otherwise(-1.0)

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        known = frame.dropna(subset=["least"])
        return pd.DataFrame({
            "q_id": [frame["q_id"].iat[0]], "need": [float(frame["need"].min())],
            "least_ids": [known["query_id"].to_numpy(np.int64).tobytes()], "least": [known["least"].to_numpy(np.float64).tobytes()],
        })

    packed = cut(
        limits.withColumn("need", need).groupBy("q_id").applyInPandas(pack, "q_id string, need double, least_ids binary, least binary")
    )
    # A stated query set against all rows, by blocks: ids only are paired here.
    rest = heads.filter(F.col("c_id") != seeds[0]).select("c_id", "c_top")
    ids = packed.select("q_id", "need").join(rest, F.col("c_top") >= F.col("need"))
    pairs = ids.select("q_id", "c_id").join(queries, "q_id").join(packed.drop("need"), "q_id").join(candidates, "c_id")
    found = first.drop("rank").unionByName(_search(pairs.repartition("q_id", "c_id"), k))
    best = _best(found, k)
    unfit = F.raise_error(F.lit("a best score does not fit bigint")).cast("bigint")
    score = F.when(F.col("score") > BELOW, F.col("score")).otherwise(unfit)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))
