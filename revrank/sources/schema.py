"""Schema repair on the way in, fixed schema on the way out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revrank.operators.positions import with_position

ID_COLUMNS = ["user_idx", "item_idx"]
TECHNICAL = ["user_idx", "item_idx", "__iter"]
DEFAULTS = {"timestamp": 0, "price": 1.0}


def with_default_columns(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Add the columns that are missing, leave the others alone."""
    wanted = DEFAULTS if defaults is None else defaults
    missing = {c: v if isinstance(v, Column) else F.lit(v) for c, v in wanted.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def price_from_items(log: DataFrame, items: DataFrame | None, default: float = 1.0) -> DataFrame:
    """Price of each row from the item table; the log's own price wins when it has one."""
    if "price" in log.columns:
        return log
    if items is None or "price" not in items.columns:
        return log.withColumn("price", F.lit(float(default)))
    return lookup_price(log, items, default)


def lookup_price(df: DataFrame, items: DataFrame, default: float = 1.0) -> DataFrame:
    prices = items.select("item_idx", F.col("price").alias("__p"))
    return (
        df.join(prices, "item_idx", "left")
        .withColumn("price", F.coalesce("__p", F.lit(float(default))))
        .drop("__p")
    )


def assign_arrival_timestamp(log: DataFrame, order: list) -> DataFrame:
    """Running row number as time, over an order the caller spells out."""
    if "timestamp" in log.columns:
        return log
    return with_position(log, [], order, name="timestamp")


def rename_ids(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"user_idx": "user_id", "item_idx": "item_id"})


def drop_technical_columns(df: DataFrame) -> DataFrame:
    return df.drop(*TECHNICAL)


def as_recommendations(recs: DataFrame) -> DataFrame:
    """The result schema: long, long, float (and rank when there is one)."""
    cols = [
        F.col("user_idx").cast("bigint").alias("user_idx"),
        F.col("item_idx").cast("bigint").alias("item_idx"),
        F.col("relevance").cast("float").alias("relevance"),
    ]
    if "rank" in recs.columns:
        cols.append(F.col("rank").cast("int").alias("rank"))
    return recs.select(*cols)


def write_recommendations(recs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    as_recommendations(recs).write.mode(mode).parquet(path)


def attribute_columns(df: DataFrame, prefix: str) -> list[str]:
    """Names of ``user_attr_*`` / ``item_attr_*`` columns, in table order."""
    return [c for c in df.columns if c.startswith(prefix)]
