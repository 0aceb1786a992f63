"""Per-user sequences and the training rows cut from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revrank.operators import positions
from revrank.operators.positions import sliding, with_position

MAX_SEQ_LEN = 100


def last_n_history(log: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Newest ``n`` rows per user; ``recency`` is 1 for the newest."""
    window = Window.partitionBy("user_idx").orderBy(*[F.col(c).desc() for c in order])
    return log.withColumn("recency", F.row_number().over(window)).filter(F.col("recency") <= n)


def user_sequences(log: DataFrame, order: list[str], max_len: int = MAX_SEQ_LEN) -> DataFrame:
    """Items in time order, the newest ``max_len`` of each user."""
    kept = last_n_history(log, max_len, order)
    ordered = F.sort_array(F.collect_list(F.struct(*order, F.col("item_idx").alias("__item"))))
    return kept.groupBy("user_idx").agg(F.transform(ordered, lambda r: r["__item"]).alias("items"))


def current_context(log: DataFrame, size: int, order: list[str]) -> DataFrame:
    """The newest ``size`` items of each user, oldest first; shorter if there are fewer."""
    return user_sequences(log, order, size).withColumnRenamed("items", "ctx")


def context_rows(log: DataFrame, size: int, order: list[str], max_len: int = MAX_SEQ_LEN) -> DataFrame:
    """(user, prev, item): each kept row with the up to ``size`` items before it."""
    columns = list(dict.fromkeys(["user_idx", "item_idx", *order]))
    kept = last_n_history(log.select(*columns), max_len, order)
    window = Window.partitionBy("user_idx").orderBy(*order).rowsBetween(-size, -1)
    return kept.select(*columns, F.collect_list("item_idx").over(window).alias("prev"))


def ngram_windows(log: DataFrame, n: int, order: list[str], max_len: int = MAX_SEQ_LEN) -> DataFrame:
    """``n`` consecutive items and the one after them."""
    rows = context_rows(log, n, order, max_len).filter(F.size("prev") == n)
    return rows.withColumnRenamed("prev", "ctx")


def prefix_target_samples(
    log: DataFrame, length: int, order: list[str], hot_rows: int | None = None, chunk: int | None = None
) -> DataFrame:
    """Every row but a user's first, with the up to ``length`` items before it."""
    rows = sliding(
        log,
        ["user_idx"],
        order,
        before=length,
        after=0,
        build=lambda w: {"prefix": F.collect_list("item_idx").over(w.rowsBetween(-length, -1))},
        hot_rows=positions.HOT_ROWS if hot_rows is None else hot_rows,
        chunk=positions.CHUNK_ROWS if chunk is None else chunk,
    )
    return rows.filter(F.size("prefix") > 0)


def fresh_samples_only(
    history: DataFrame, fresh: DataFrame, length: int, cap: int, order: list[str]
) -> DataFrame:
    """Training rows for the new slice only, with prefixes that reach into the history.

    The stored history is capped at the newest ``cap`` rows per user.
    """
    both = append_log(history.withColumn("is_new", F.lit(False)), fresh.withColumn("is_new", F.lit(True)))
    kept = last_n_history(both, cap, order).drop("recency")
    window = Window.partitionBy("user_idx").orderBy(*order).rowsBetween(-length, -1)
    rows = kept.withColumn("prefix", F.collect_list("item_idx").over(window))
    return rows.filter(F.col("is_new") & (F.size("prefix") > 0)).drop("is_new")


def append_log(history: DataFrame, fresh: DataFrame) -> DataFrame:
    return history.unionByName(fresh)


def vocabulary(log: DataFrame, order: list[str]) -> DataFrame:
    """Dense item index from 1 by first appearance; 0 stays free."""
    first = log.groupBy("item_idx").agg(F.min(F.struct(*order)).alias("__first"))
    return with_position(first, [], ["__first", "item_idx"], "index").select(
        "item_idx", (F.col("index") + 1).alias("index")
    )


def encode_items(log: DataFrame, vocab: DataFrame) -> DataFrame:
    return log.join(vocab, "item_idx").withColumnRenamed("index", "token")
