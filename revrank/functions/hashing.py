"""Seeded draws from row keys.

``rand()`` gives other values when a lost task is run again on rows in another
order. A digest of the row's key gives the same draw always and everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_RANGE = 1 << 32


def digest(*keys) -> Column:
    parts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    return F.md5(F.concat_ws("|", *parts))


def draw(*keys) -> Column:
    """Uniform whole number in [0, 2^32) from the key."""
    return F.conv(F.substring(digest(*keys), 1, 8), 16, 10).cast("bigint")


def keep_share(share: float, *keys) -> Column:
    """True for about ``share`` of the keys."""
    return draw(*keys) < F.lit(int(share * DRAW_RANGE))


def with_row_id(df, name: str = "row_id"):
    """``df`` with an id that depends on the row's content only, whatever the order of rows.

    Equal rows are counted and listed again with a number, so their ids differ, too.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("__copies"))
    numbered = counted.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in df.columns]
    return numbered.withColumn(name, F.md5(F.concat_ws("|", *parts, F.col("__copy").cast("string")))).drop("__copies", "__copy")
