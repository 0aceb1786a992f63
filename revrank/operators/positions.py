"""Row numbers and sliding windows that survive a user with a third of the log.

A window over ``partitionBy(user)`` puts all rows of a user in one task. That is
right for most users and wrong for the hottest. Both helpers here count rows per
key first (a map-side combined aggregate). If no key is above ``hot_rows`` the
plain window is used. Hot keys take another way: their rows are range-sorted by
(key, order), so the rows of a key spread over many tasks, and numbers are made
from the position inside the task plus the rows in the tasks before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from revrank.session import cut

HOT_ROWS = 2_000_000
CHUNK_ROWS = 65_536


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_hot(df: DataFrame, by: list[str], hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys or None)."""
    hot = df.groupBy(*by).agg(F.count("*").alias("__n")).filter(F.col("__n") > hot_rows).select(*by)
    if hot.isEmpty():
        return df, None
    hot = cut(hot)
    return df.join(hot, by, "left_anti"), df.join(hot, by, "left_semi")


def range_position(df: DataFrame, by: list[str], order: list, name: str = "pos") -> DataFrame:
    """0-based position inside each key from a distributed sort, one task per range."""
    keys = [F.col(c) for c in by] + [_col(o) for o in order]
    ranged = cut(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__mid", F.monotonically_increasing_id())
    )
    # The high bits of the id are the task number, the low 33 bits count inside it.
    ranged = ranged.withColumn("__task", F.shiftright("__mid", 33))
    group = by or [F.lit(0).alias("__all")]
    runs = ranged.groupBy(*group, "__task").agg(F.min("__mid").alias("__start"), F.count("*").alias("__rows"))
    key_names = by or ["__all"]
    earlier = Window.partitionBy(*key_names).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *by, "__task", "__start", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before")
    )
    return (
        ranged.join(runs, [*by, "__task"])
        .withColumn(name, F.col("__mid") - F.col("__start") + F.col("__before"))
        .drop("__mid", "__task", "__start", "__before")
    )


def with_position(
    df: DataFrame, by: list[str], order: list, name: str = "pos", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """0-based row number inside each key, in a total order. No key = whole table."""
    if not by:
        return range_position(df, by, order, name)
    plain, hot = split_hot(df, by, hot_rows)
    window = Window.partitionBy(*by).orderBy(*[_col(o) for o in order])
    out = plain.withColumn(name, (F.row_number().over(window) - 1).cast("bigint"))
    if hot is None:
        return out
    return out.unionByName(range_position(hot, by, order, name))


def chunk_rows(
    df: DataFrame,
    by: list[str],
    order: list,
    before: int,
    after: int,
    hot_rows: int = HOT_ROWS,
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Rows with ``__chunk`` and ``__own``, ready for windows over (by, __chunk).

    An ordinary key is one chunk. A hot key is cut into chunks of ``chunk`` rows; rows
    that a neighbour chunk can see (``before`` rows back, ``after`` ahead) are copied to it
    with ``__own`` false, to be dropped after the window.
    """
    plain, hot = split_hot(df, by, hot_rows)
    out = plain.withColumns({"__chunk": F.lit(0).cast("bigint"), "__own": F.lit(True)})
    if hot is None:
        return out
    if max(before, after) > chunk:
        raise ValueError("a chunk must be at least as long as the window")
    placed = range_position(hot, by, order, "__pos")
    own, inside = F.floor(F.col("__pos") / chunk), F.col("__pos") % chunk
    copies = F.array_compact(
        F.array(F.when(inside < after, own - 1), own, F.when(inside >= chunk - before, own + 1))
    )
    chunked = placed.withColumn("__chunk", F.explode(copies)).withColumn("__own", F.col("__chunk") == own)
    return out.unionByName(chunked.drop("__pos"))


def sliding(
    df: DataFrame,
    by: list[str],
    order: list,
    before: int,
    after: int,
    build: Callable[[WindowSpec], dict[str, Column]],
    hot_rows: int = HOT_ROWS,
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Window columns that look at most ``before`` rows back and ``after`` ahead.

    ``build`` gets the ordered window and returns the new columns.
    """
    rows = chunk_rows(df, by, order, before, after, hot_rows, chunk)
    window = Window.partitionBy(*by, "__chunk").orderBy(*[_col(o) for o in order])
    return rows.withColumns(build(window)).filter("__own").drop("__own", "__chunk")
