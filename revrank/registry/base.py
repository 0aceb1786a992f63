"""Registration and the SQL text every check query starts with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The adapters of revrank.sources.tables as SQL.
PRELUDE = """
WITH slog AS (
  SELECT o_custkey AS user_idx, l_partkey AS item_idx,
         CAST(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS DOUBLE) AS relevance,
         o_orderdate AS "timestamp", l_extendedprice / l_quantity AS price,
         CAST(year(o_orderdate) - 1995 AS INTEGER) AS "__iter",
         l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_returnflag
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
susers AS (
  SELECT c_custkey AS user_idx, c_mktsegment AS segment, c_acctbal AS user_attr_0,
         CAST(c_nationkey AS DOUBLE) AS user_attr_1 FROM customer),
sitems AS (
  SELECT p_partkey AS item_idx, p_type AS category, p_retailprice AS price,
         CAST(p_size AS DOUBLE) AS item_attr_0, p_brand AS brand, p_name AS name FROM part),
elog AS (
  SELECT user_id AS user_idx, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS item_idx,
         CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS DOUBLE) AS relevance,
         ts AS "timestamp", value AS price,
         CAST(floor(date_diff('day', TIMESTAMP '2024-01-01', ts) / 5.0) AS INTEGER) AS "__iter", event_id
  FROM events),
eusers AS (SELECT DISTINCT user_idx FROM elog),
eitems AS (
  SELECT item_idx, CAST(sum(CAST(round(price * 100) AS BIGINT)) AS BIGINT)
                   / (CAST(100.0 AS DOUBLE) * count(*)) AS price
  FROM elog GROUP BY item_idx)
"""


def query(name: str, sql: str | None = None, ints: tuple[str, ...] = ()):
    """Register a query; ``sql`` goes on after the shared WITH clause.

    ``ints`` names the columns that are 32-bit in Spark (row numbers).
    """

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            full = PRELUDE + sql
            if ints:
                casts = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in ints)
                full = f"SELECT * REPLACE ({casts}) FROM ({full})"
            ORACLES[name] = full
        return fn

    return register


def q6(x) -> Column:
    """Six digits for comparing two engines.

    Sums differ in the last bits by the order of rows; the small shift keeps such noise from
    deciding a value that lies exactly between two six-digit numbers.
    """
    x = F.col(x) if isinstance(x, str) else x
    return F.floor(x.cast("double") * 1e6 + 0.50001) / 1e6


def s6(expr: str) -> str:
    return f"(floor(CAST(({expr}) AS DOUBLE) * 1e6 + CAST(0.50001 AS DOUBLE)) / 1e6)"


def text(array) -> Column:
    """A whole-number array as comma text, so that both engines compare alike."""
    array = F.col(array) if isinstance(array, str) else array
    return F.array_join(array.cast("array<string>"), ",")


def draw_sql(*parts: str) -> str:
    """The seeded draw of revrank.functions.hashing as SQL."""
    joined = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5(concat_ws('|', {joined})), 1, 8)) AS BIGINT)"


def md5_sql(*parts: str) -> str:
    joined = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"md5(concat_ws('|', {joined}))"
