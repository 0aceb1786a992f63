"""Aggregations over the log, users and items."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar(df: DataFrame, agg: Column) -> Column:
    """One number over a whole table, as a scalar subquery (no join, no collect)."""
    return df.select(agg).scalar()


def user_stats(log: DataFrame) -> DataFrame:
    return log.groupBy("user_idx").agg(
        F.avg("price").alias("user_price_mean"), F.avg("relevance").alias("user_ctr")
    )


def item_stats(log: DataFrame) -> DataFrame:
    return log.groupBy("item_idx").agg(
        F.avg("relevance").alias("item_buy_rate"), F.log1p(F.count("*")).alias("item_log_views")
    )


def item_popularity(log: DataFrame, alpha: float = 1.0) -> DataFrame:
    gain = F.col("relevance") if alpha == 1.0 else F.pow("relevance", F.lit(float(alpha)))
    return log.groupBy("item_idx").agg(F.sum(gain).alias("score"))


def category_share(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / scalar(counts, F.sum("n")))


def interaction_density(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    n_users, n_items = scalar(users, F.count("*")), scalar(items, F.count("*"))
    one = log.agg(F.count("*").alias("interactions"))
    return one.withColumns({"users": n_users, "items": n_items}).withColumn(
        "density_pct", F.col("interactions") * 100.0 / (F.col("users").cast("double") * F.col("items"))
    )


def coverage(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    one = log.agg(
        F.count_distinct("user_idx").alias("active_users"), F.count_distinct("item_idx").alias("active_items")
    )
    return one.withColumns(
        {
            "user_pct": F.col("active_users") * 100.0 / scalar(users, F.count("*")),
            "item_pct": F.col("active_items") * 100.0 / scalar(items, F.count("*")),
        }
    )


def interactions_per(log: DataFrame, column: str) -> DataFrame:
    return log.groupBy(column).agg(F.count("*").alias("n"))


def relevance_distribution(log: DataFrame) -> DataFrame:
    return log.groupBy("relevance").agg(F.count("*").alias("n"))


def _bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    width = (high - low) / bins
    return F.when(width == 0, 0).otherwise(F.least(F.floor((x - low) / width), F.lit(bins - 1))).cast("int")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest value."""
    x = F.col(column)
    low, high = scalar(df, F.min(x)), scalar(df, F.max(x))
    return (
        df.filter(x.isNotNull())
        .select(_bin(x, low, high, bins).alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
    )


def histogram_by(df: DataFrame, column: str, group: str, bins: int = 20) -> DataFrame:
    """Equal-width bins inside every group."""
    x = F.col(column)
    ranges = df.groupBy(group).agg(F.min(x).alias("__low"), F.max(x).alias("__high"))
    return (
        df.filter(x.isNotNull())
        .join(ranges, group)
        .withColumn("bin", _bin(x, F.col("__low"), F.col("__high"), bins))
        .groupBy(group, "bin")
        .agg(F.count("*").alias("n"))
    )


def attribute_histograms(df: DataFrame, group: str, prefix: str, bins: int = 20) -> DataFrame:
    """``histogram_by`` for every numeric attribute column, from one unpivoted table."""
    columns = [c for c in df.columns if c.startswith(prefix)]
    values = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("double").alias("x")) for c in columns])
    long = df.select(group, F.inline(values)).filter(F.col("x").isNotNull())
    ranges = long.groupBy("attribute", group).agg(F.min("x").alias("__low"), F.max("x").alias("__high"))
    return (
        long.join(ranges, ["attribute", group])
        .withColumn("bin", _bin(F.col("x"), F.col("__low"), F.col("__high"), bins))
        .groupBy("attribute", group, "bin")
        .agg(F.count("*").alias("n"))
    )


def segment_category_pivot(log: DataFrame, users: DataFrame, items: DataFrame, categories: list[str]) -> DataFrame:
    """Interactions per segment (rows) and category (columns).

    Rows are counted per id pair first: the joins then carry one row per pair.
    """
    pairs = log.groupBy("user_idx", "item_idx").agg(F.count("*").alias("__n"))
    joined = pairs.join(users.select("user_idx", "segment"), "user_idx").join(
        items.select("item_idx", "category"), "item_idx"
    )
    return joined.groupBy("segment").pivot("category", categories).agg(F.sum("__n")).fillna(0)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, lower triangle, from one pass."""
    pairs = [(b, a) for a, b in combinations(columns, 2)]
    one = df.agg(*[F.corr(a, b).alias(f"__{n}") for n, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), F.col(f"__{n}").alias("corr"))
            for n, (a, b) in enumerate(pairs)
        ]
    )
    return one.select(F.inline(rows))


def id_space(log: DataFrame) -> DataFrame:
    return log.agg((F.max("user_idx") + 1).alias("n_users"), (F.max("item_idx") + 1).alias("n_items"))


def query_group_sizes(log: DataFrame) -> DataFrame:
    return log.groupBy("user_idx").agg(F.count("*").alias("group_size"))


def last_price_per_item(log: DataFrame, order: list[str]) -> DataFrame:
    return log.groupBy("item_idx").agg(F.max_by("price", F.struct(*order)).alias("price"))


def first_price_per_item(log: DataFrame, order: list[str]) -> DataFrame:
    return log.groupBy("item_idx").agg(F.min_by("price", F.struct(*order)).alias("price"))


def max_price(log: DataFrame) -> DataFrame:
    return log.agg(F.max("price").alias("max_price"))


def collect_ranked_lists(recs: DataFrame, k: int) -> DataFrame:
    """Relevances of a user's first ``k`` ranks, in rank order (at most k values)."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "relevance")))
    return (
        recs.filter(F.col("rank") <= k)
        .groupBy("user_idx")
        .agg(F.transform(ranked, lambda r: r["relevance"]).alias("relevances"))
    )


def global_mean_label(log: DataFrame) -> DataFrame:
    return log.agg(F.avg((F.col("relevance") > 0).cast("int")).alias("global_mean"))


NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, distinct) for each column; nulls do not count, -0 is 0.

    Columns become (column, value) rows that the map tasks thin out to different ones, so
    one aggregate on two levels serves all columns and none is a task of its own.
    """
    return _count_values([_values(df, columns)], df, columns)


def joined_distinct_counts(log: DataFrame, users: DataFrame, items: DataFrame, columns: list[str]) -> DataFrame:
    """``distinct_counts`` of ``enrich_interactions(log, users, items)`` without making that join.

    A user column is counted on the users with rows in the log, an item column on the items;
    only columns of the log itself are read row by row.
    """
    used = log.join(users, "user_idx", "left_semi").join(items, "item_idx", "left_semi")
    own = [c for c in columns if c in log.columns and (c == "item_idx" or c not in items.columns)]
    parts = []
    if own:
        parts.append(_values(used, own))
    for side, key in ((users, "user_idx"), (items, "item_idx")):
        mine = [c for c in columns if c in side.columns and c not in own]
        if mine:
            parts.append(_values(side.join(used.select(key).distinct(), key, "left_semi"), mine))
    return _count_values(parts, log, columns)


def _values(df: DataFrame, columns: list[str]) -> DataFrame:
    types = dict(df.dtypes)

    def value(c: str):
        v = F.col(c)
        if types[c] in ("float", "double"):
            v = F.when(v == 0, F.lit(0.0)).otherwise(v)
        return F.struct(F.lit(c).alias("column"), v.cast("string").alias("value"))

    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string")
    return df.select(F.inline(F.array(*[value(c) for c in columns]))).filter(F.col("value").isNotNull())


def _count_values(parts: list[DataFrame], any_df: DataFrame, columns: list[str]) -> DataFrame:
    named = any_df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    values = named.withColumn("value", F.lit(None).cast("string"))
    for part in parts:
        values = values.unionByName(part)
    return values.distinct().groupBy("column").agg(F.count("value").alias("distinct"))


def numeric_columns(df: DataFrame, min_distinct: int = 10) -> DataFrame:
    """Numeric columns with more than ``min_distinct`` values: the ones to scale."""
    numeric = [c for c, t in df.dtypes if t in NUMBERS]
    return distinct_counts(df, numeric).filter(F.col("distinct") > min_distinct)


def high_cardinality(df: DataFrame, threshold: int = 30, rsd: float | None = None) -> DataFrame:
    """String columns with at least ``threshold`` values: the ones to target-encode."""
    text = [c for c, t in df.dtypes if t == "string"]
    if rsd is None:
        counted = distinct_counts(df, text)
    else:
        one = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in text])
        counted = one.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct")) for c in text]))
        )
    return counted.filter(F.col("distinct") >= threshold)


def joined_numeric_columns(log: DataFrame, users: DataFrame, items: DataFrame, min_distinct: int = 10) -> DataFrame:
    """``numeric_columns`` of the log with its user and item features, without the join."""
    numeric = _columns_of([log, users, items], NUMBERS)
    return joined_distinct_counts(log, users, items, numeric).filter(F.col("distinct") > min_distinct)


def joined_high_cardinality(log: DataFrame, users: DataFrame, items: DataFrame, threshold: int = 30) -> DataFrame:
    """``high_cardinality`` of the log with its user and item features, without the join."""
    text = _columns_of([log, users, items], ("string",))
    return joined_distinct_counts(log, users, items, text).filter(F.col("distinct") >= threshold)


def _columns_of(tables: list[DataFrame], types: tuple[str, ...]) -> list[str]:
    return list(dict.fromkeys(c for df in tables for c, t in df.dtypes if t in types))
