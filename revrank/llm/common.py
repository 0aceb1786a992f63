"""Small helpers of the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: str) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the columns a result is about to add, whatever their case."""
    lower = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in lower])


def running_totals(sums: DataFrame, keys: list[str], index: str, value: str, fan: int = 256) -> DataFrame:
    """``before``: the sum of ``value`` over smaller ``index`` of the same keys.

    ``sums`` has one row per keys and index. Windows hold at most ``fan`` rows: beyond
    that, the totals of groups of ``fan`` indexes are summed first, in the same way.
    """
    top = sums.agg(F.max(index)).first()[0] or 0
    own = Window.orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(own.partitionBy(*keys)), F.lit(0))
    if top < fan:
        return sums.withColumn("before", inside)
    group = f"{index}_up"
    grouped = sums.withColumn(group, F.floor(F.col(index) / fan).cast("bigint"))
    upper = grouped.groupBy(*keys, group).agg(F.sum(value).alias(value))
    upper = running_totals(upper, keys, group, value, fan).withColumnRenamed("before", "__above").drop(value)
    inside = F.coalesce(F.sum(value).over(own.partitionBy(*keys, group)), F.lit(0))
    lower = grouped.withColumn("before", inside)
    return (
        lower.join(upper, [*keys, group])
        .withColumn("before", F.col("before") + F.col("__above"))
        .drop("__above", group)
    )


def small_batches(batches: Iterator[pa.RecordBatch], text: int, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``limit`` bytes of column ``text`` (one row at least)."""
    for batch in batches:
        start, size = 0, 0
        for row, value in enumerate(batch.column(text)):
            size += value.as_buffer().size if value.is_valid else 0
            if size >= limit:
                yield batch.slice(start, row + 1 - start)
                start, size = row + 1, 0
        if start < batch.num_rows or not batch.num_rows:
            yield batch.slice(start)
    # A worker lives on after its task, next to others: what Arrow and the C library hold for later goes back.
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def bit_table(hashes: DataFrame, bits: int = 1 << 24) -> np.ndarray:
    """Bloom filter of a one-column table of 64-bit hashes: ``bits`` bits, whatever its number of rows.

    ``maybe_in`` tells rows that are surely not in the table. Too many rows make it say "maybe"
    always, which costs time only: an exact join follows.
    """
    h = F.col(hashes.columns[0])
    places = F.array(h.bitwiseAND(bits - 1), F.shiftrightunsigned(h, 32).bitwiseAND(bits - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(63).cast("int"))
    words = hashes.select(F.explode(places).alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(bit).alias("mask"))
    found = words.toPandas()
    table = np.zeros(bits // 64, np.int64)
    table[found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64)
    return table.view(np.uint8)


def maybe_in(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """True for the 64-bit hashes that may be in the table."""
    h, low = hashes.view(np.uint64), np.uint64(len(table) * 8 - 1)
    hit = np.ones(len(h), bool)
    for p in (h & low, (h >> np.uint64(32)) & low):
        hit &= (table[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return hit
