"""Feature columns: one-hot, scaling, target encoding, weights, folds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from revrank.functions.hashing import digest
from revrank.operators.aggregates import scalar
from revrank.operators.positions import with_position
from revrank.session import cut, cut_wide


def _slug(value: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in str(value))


def one_hot(df: DataFrame, levels: dict[str, list[str]], drop: bool = True) -> DataFrame:
    """0/1 column per known value; a value not in the list gives zeros everywhere."""
    added = {
        f"{c}_{_slug(v)}": F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))
        for c, values in levels.items()
        for v in values
    }
    out = df.withColumns(added)
    return out.drop(*levels) if drop else out


def levels_of(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted distinct values of columns known to be narrow; others take ``level_table``."""
    found = {}
    for c in columns:
        rows = df.select(c).distinct().collect()
        found[c] = sorted(r[0] for r in rows if r[0] is not None)
    return found


def level_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, level): all values of the text columns, numbered from 0 over the table.

    A range sort gives the numbers and nothing is collected, so a column may have any number
    of values. A null is no value; without columns or rows the table is empty.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, level bigint")
    named = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
    pairs = df.select(F.inline(F.array(*named))).filter(F.col("value").isNotNull()).distinct()
    return with_position(pairs, [], ["column", "value"], "level").select("column", "value", "level")


def lookup_levels(df: DataFrame, table: DataFrame, columns: list[str], wanted: str, prefix: str) -> DataFrame:
    """``df`` and, per text column, ``wanted`` of the row's value as ``prefix`` + place of the column.

    Null for a null value or one the table does not hold. One join per column, broadcast by
    Spark while the written table is small; no row of ``df`` is multiplied.
    """
    out = df
    for n, c in enumerate(columns):
        own = table.filter(F.col("column") == c).select(F.col("value").alias("__v"), F.col(wanted).alias(f"{prefix}{n}"))
        out = out.join(own, F.col(c) == F.col("__v"), "left").drop("__v")
    return out


def sparse_parts(
    df: DataFrame, key: str, numbers: list[Column], columns: list[str], levels: DataFrame, first: int, name: str
) -> DataFrame:
    """(key, ``name`` = places and values): numbers at ``first`` on, then a 1 at each level of the row.

    A null number counts as 0, a null or unknown text value sets no place.
    """
    marked = lookup_levels(df, levels, columns, "level", "__level")
    begin = first + len(numbers)
    hot = F.array(*[F.col(f"__level{n}") for n in range(len(columns))]).cast("array<bigint>")
    places = F.transform(F.array_sort(F.array_compact(hot)), lambda v: (v + begin).cast("int"))
    fixed = F.array(*[F.lit(first + n) for n in range(len(numbers))]).cast("array<int>")
    values = F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in numbers]).cast("array<double>")
    part = F.struct(
        F.concat(fixed, places).alias("at"),
        F.concat(values, F.array_repeat(F.lit(1.0), F.size(places))).alias("x"),
    )
    return marked.select(key, part.alias(name))


def written_vectors(df: DataFrame, parts: list[str], size: int, name: str = "features") -> DataFrame:
    """``df`` written with the sparse parts put together as one vector column of ``size`` places.

    The vector's fields are made by expressions and read back under the vector type, so no row
    passes through Python.
    """
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        F.concat(*[F.col(f"{p}.at") for p in parts]).alias("indices"),
        F.concat(*[F.col(f"{p}.x") for p in parts]).alias("values"),
    )
    made = df.select(*[c for c in df.columns if c not in parts], vector.alias(name))
    read_as = StructType([StructField(f.name, VectorUDT()) if f.name == name else f for f in made.schema])
    return cut_wide(made, read_as)


def align_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly ``columns`` in that order; what is missing becomes 0."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in columns])


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column; a constant column divides by 1."""

    mean: dict[str, float]
    std: dict[str, float]

    def column(self, c: str) -> Column:
        return (F.col(c) - F.lit(self.mean[c])) / F.lit(self.std[c])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.column(c) for c in self.mean if c in df.columns})


def fit_scaler(df: DataFrame, columns: list[str]) -> Scaler:
    stats = [F.avg(c).alias(f"m_{c}") for c in columns] + [F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    row = df.agg(*stats).first()
    return Scaler({c: row[f"m_{c}"] or 0.0 for c in columns}, {c: row[f"s_{c}"] or 1.0 for c in columns})


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    return fit_scaler(df, columns).transform(df)


def target_encoding(df: DataFrame, column: str, label: Column, prior: float = 10.0) -> DataFrame:
    """(value, encoded): the value's mean label drawn towards the global mean."""
    overall = scalar(df, F.avg(label))
    per = df.groupBy(column).agg(F.avg(label).alias("__m"), F.count("*").alias("__n"))
    encoded = (F.col("__m") * F.col("__n") + F.lit(prior) * overall) / (F.col("__n") + F.lit(prior))
    return per.select(column, encoded.alias(f"{column}_te"))


def apply_encoding(df: DataFrame, encoding: DataFrame, column: str, unseen: Column | float) -> DataFrame:
    name = f"{column}_te"
    fallback = unseen if isinstance(unseen, Column) else F.lit(float(unseen))
    return df.join(encoding, column, "left").withColumn(name, F.coalesce(name, fallback))


def out_of_fold_encoding(
    df: DataFrame, column: str, label: str, fold: str, prior: float = 10.0
) -> DataFrame:
    """Target encoding of each row from the other folds only, so no row sees its own label.

    Sums per (value, fold) and per value are aggregates; the row's own fold is subtracted.
    """
    own = df.groupBy(column, fold).agg(F.sum(label).alias("__fs"), F.count("*").alias("__fn"))
    every = own.groupBy(column).agg(F.sum("__fs").alias("__s"), F.sum("__fn").alias("__n"))
    folds = df.groupBy(fold).agg(F.sum(label).alias("__gs"), F.count("*").alias("__gn"))
    total_s, total_n = scalar(folds, F.sum("__gs")), scalar(folds, F.sum("__gn"))
    overall = (total_s - F.col("__gs")) / (total_n - F.col("__gn"))
    s, n = F.col("__s") - F.col("__fs"), F.col("__n") - F.col("__fn")
    table = own.join(every, column).join(folds, fold).select(
        column, fold, ((s + F.lit(prior) * overall) / (n + F.lit(prior))).alias(f"{column}_te")
    )
    return df.join(table, [column, fold], "left")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, weight) with weight n / (2 * n_class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("__n"))
    total = scalar(counts, F.sum("__n"))
    return counts.select(label, (total / (2.0 * F.col("__n"))).alias("weight"))


def hash_rank(df: DataFrame, strata: list[str], key: list, seed: int, name: str = "__rank") -> DataFrame:
    """1-based rank of each row by the digest of its key, inside each stratum.

    A window over a stratum would be one task for half the table. The first three
    hex digits of the digest split a stratum into 4096 even buckets that are ranked
    apart; a running sum of the bucket sizes turns that into the exact rank.
    """
    from pyspark.sql.window import Window

    marked = df.withColumn("__digest", digest(*key, F.lit(seed))).withColumn("__bucket", F.substring("__digest", 1, 3))
    sizes = marked.groupBy(*strata, "__bucket").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*strata).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*strata, "__bucket", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*strata, "__bucket").orderBy("__digest")
    return (
        marked.withColumn("__in", F.row_number().over(inside))
        .join(offsets, [*strata, "__bucket"])
        .withColumn(name, F.col("__before") + F.col("__in"))
        .drop("__digest", "__bucket", "__before", "__in")
    )


def undersample_negatives(df: DataFrame, label: str, key: list, seed: int = 42) -> DataFrame:
    """All positives and as many negatives, chosen by seeded hash rank of the row key.

    Sizes of the digest's 4096 buckets tell which buckets are kept whole; only the rows of the one
    bucket that the limit falls in are ranked, and no other row is shuffled.
    """
    from pyspark.sql.window import Window

    positives = scalar(df, F.sum(F.when(F.col(label) == 1, 1).otherwise(0)))
    marked = df.filter(F.col(label) == 0).withColumn("__digest", digest(*key, F.lit(seed)))
    marked = marked.withColumn("__bucket", F.substring("__digest", 1, 3))
    earlier = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = marked.groupBy("__bucket").agg(F.count("*").alias("__n"))
    sizes = sizes.select("__bucket", (positives - F.coalesce(F.sum("__n").over(earlier), F.lit(0))).alias("__room"), "__n")
    # A written table of at most 4096 rows, so that Spark brings it to the rows.
    sizes = cut(sizes.filter(F.col("__room") > 0))
    whole = marked.join(sizes.filter(F.col("__n") <= F.col("__room")), "__bucket", "left_semi")
    ranked = marked.join(sizes.filter(F.col("__n") > F.col("__room")), "__bucket").withColumn(
        "__rank", F.row_number().over(Window.partitionBy("__bucket").orderBy("__digest"))
    )
    last = ranked.filter(F.col("__rank") <= F.col("__room"))
    kept = whole.select(*df.columns).unionByName(last.select(*df.columns))
    return union_pos_neg(df.filter(F.col(label) == 1), kept)


def union_pos_neg(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    return positives.unionByName(negatives)


def stratified_folds(df: DataFrame, label: str, key: list, folds: int = 5, seed: int = 42) -> DataFrame:
    """``fold`` 0..folds-1, as even as can be inside each label."""
    ranked = hash_rank(df, [label], key, seed)
    return ranked.withColumn("fold", ((F.col("__rank") - 1) % folds).cast("int")).drop("__rank")
