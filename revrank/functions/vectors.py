"""Vectors as wide columns (``e0 .. e{d-1}``) and as arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def names(d: int, prefix: str = "e") -> list[str]:
    return [f"{prefix}{j}" for j in range(d)]


def dot_wide(a: str, b: str, d: int) -> Column:
    return reduce(lambda x, y: x + y, [F.col(f"{a}{j}") * F.col(f"{b}{j}") for j in range(d)])


def squares_wide(a: str, d: int) -> Column:
    return dot_wide(a, a, d)


def dot(a, b) -> Column:
    """Inner product of two array columns."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def l2_normalize(a) -> Column:
    """Array scaled to unit length; a zero vector stays zero."""
    a = F.col(a) if isinstance(a, str) else a
    # The length is repeated as an array, so that it is worked out once and not for each place.
    sizes = F.array_repeat(F.sqrt(dot(a, a)), F.size(a))
    return F.zip_with(a, sizes, lambda x, size: F.when(size > 0, x / size).otherwise(F.lit(0.0)))


def to_array(d: int, prefix: str = "e") -> Column:
    return F.array(*[F.col(c) for c in names(d, prefix)])


def seeded_vector(node, d: int, scale: float = 1.0) -> list[Column]:
    """Repeatable start values ``sin((id+1)*(j+1)) * scale``."""
    node = F.col(node) if isinstance(node, str) else node
    return [(F.sin((node + 1).cast("double") * float(j + 1)) * float(scale)).alias(f"e{j}") for j in range(d)]


def left_pad(a, size: int, pad) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    missing = F.greatest(F.lit(0), F.lit(size) - F.size(a))
    kept = F.slice(a, F.greatest(F.lit(1), F.size(a) - F.lit(size - 1)), F.lit(size))
    return F.concat(F.array_repeat(F.lit(pad).cast("bigint"), missing), kept)


def right_pad(a, size: int, pad) -> Column:
    """Keeps the newest ``size`` values and pads at the end."""
    a = F.col(a) if isinstance(a, str) else a
    missing = F.greatest(F.lit(0), F.lit(size) - F.size(a))
    kept = F.slice(a, F.greatest(F.lit(1), F.size(a) - F.lit(size - 1)), F.lit(size))
    return F.concat(kept, F.array_repeat(F.lit(pad).cast("bigint"), missing))
