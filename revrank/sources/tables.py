"""The three input tables, read from two stored layouts.

``star``   orders and their lines: long-tailed items, user and item features.
``events`` a click stream: short vocabulary, exact time order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_ORDER_YEAR = 1995
EVENTS_START = "2024-01-01"
EVENT_DAYS_PER_ITER = 5


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def star_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").cast("bigint").alias("user_idx"),
        F.col("o_orderdate").alias("timestamp"),
    )
    lines = _read(spark, sf_dir, "lineitem")
    return lines.join(orders, "l_orderkey").select(
        "user_idx",
        F.col("l_partkey").cast("bigint").alias("item_idx"),
        F.when(F.col("l_returnflag") == "A", 1.0).otherwise(0.0).alias("relevance"),
        "timestamp",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        (F.year("timestamp") - FIRST_ORDER_YEAR).alias("__iter"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_shipdate", "l_returnflag",
    )


# Columns that order the star log totally (line keys repeat in the data).
STAR_ORDER = [
    "timestamp", "l_orderkey", "l_linenumber", "item_idx", "l_suppkey",
    "l_extendedprice", "l_quantity", "l_shipdate", "l_returnflag",
]
STAR_KEY = ["user_idx", *STAR_ORDER]
LOG_COLUMNS = ["user_idx", "item_idx", "relevance", "timestamp", "price", "__iter"]


def star_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("bigint").alias("user_idx"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").cast("double").alias("user_attr_0"),
        F.col("c_nationkey").cast("double").alias("user_attr_1"),
    )


def star_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("bigint").alias("item_idx"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("double").alias("price"),
        F.col("p_size").cast("double").alias("item_attr_0"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("name"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_log(_read(spark, sf_dir, "events"))


def events_as_log(events: DataFrame) -> DataFrame:
    """Same mapping for a batch or a streaming ``events`` table."""
    return events.select(
        F.col("user_id").cast("bigint").alias("user_idx"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item_idx"),
        F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0).alias("relevance"),
        F.col("ts").alias("timestamp"),
        F.col("value").cast("double").alias("price"),
        F.floor(F.datediff("ts", F.lit(EVENTS_START)) / EVENT_DAYS_PER_ITER).cast("int").alias("__iter"),
        "event_id",
    )


EVENT_ORDER = ["timestamp", "event_id"]


def event_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select("user_idx").distinct()


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item price = mean event value, summed in whole cents so the order of rows cannot matter."""
    cents = F.sum(F.round(F.col("price") * 100).cast("bigint"))
    return event_log(spark, sf_dir).groupBy("item_idx").agg(
        (cents / (F.lit(100.0) * F.count("*"))).alias("price")
    )
