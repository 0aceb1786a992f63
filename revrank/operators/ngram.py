"""Counts and probabilities of what follows what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrank.operators.sequences import MAX_SEQ_LEN, context_rows

# Probability of a pair no context explains.
BACKOFF_FLOOR = 1e-6


def suffix(ctx: str, n) -> Column:
    """The last ``n`` items of a context (n may be a column)."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.slice(F.col(ctx), F.size(ctx) - n + 1, n)


def ngram_counts(log: DataFrame, order: int, by: list[str], max_len: int = MAX_SEQ_LEN) -> DataFrame:
    """(ctx, item, c) for contexts of 1..order items, from one window per user."""
    rows = context_rows(log, order, by, max_len).filter(F.size("prev") > 0)
    grams = rows.withColumn("n", F.explode(F.sequence(F.lit(1), F.size("prev"))))
    return (
        grams.select(suffix("prev", F.col("n")).alias("ctx"), "item_idx")
        .groupBy("ctx", "item_idx")
        .agg(F.count("*").alias("c"))
    )


def ngram_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("ctx").agg(F.sum("c").alias("total"))


def backoff_probabilities(counts: DataFrame) -> DataFrame:
    return counts.join(ngram_totals(counts), "ctx").withColumn("p", F.col("c") / F.col("total"))


def addk_probabilities(counts: DataFrame, k: float, vocabulary_size: Column) -> DataFrame:
    """Probability of the counted pairs; the rest of the vocabulary shares one value per context."""
    spread = F.col("total") + F.lit(float(k)) * vocabulary_size
    return (
        counts.join(ngram_totals(counts), "ctx")
        .withColumn("p", (F.col("c") + F.lit(float(k))) / spread)
        .withColumn("p_default", F.lit(float(k)) / spread)
    )


def lookup_ngram_prob(pairs: DataFrame, contexts: DataFrame, probs: DataFrame, order: int) -> DataFrame:
    """Back-off probability of (user, item) pairs: the longest context that has the item wins."""
    asked = pairs.join(contexts, "user_idx", "left").withColumn("ctx", F.coalesce("ctx", F.array().cast("array<bigint>")))
    levels = asked.withColumn(
        "n", F.explode_outer(F.when(F.size("ctx") > 0, F.sequence(F.lit(1), F.least(F.size("ctx"), F.lit(order)))))
    )
    keyed = levels.withColumn("ctx", F.when(F.col("n").isNotNull(), suffix("ctx", F.col("n"))))
    found = keyed.join(probs.select("ctx", "item_idx", "p"), ["ctx", "item_idx"], "left")
    best = F.max_by("p", F.when(F.col("p").isNotNull(), F.col("n")))
    return found.groupBy(*pairs.columns).agg(F.coalesce(best, F.lit(BACKOFF_FLOOR)).alias("p"))
