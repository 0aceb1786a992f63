"""Document fingerprints by Order MinHash: likeness that follows edit distance, not only content.

Every k-mer of words gets its occurrence number, so repeats count, and a hash. The hashes
fall into bins; of each bin the two smallest k-mers are taken, put back in text order and
hashed as a pair. Two texts agree in a bin if they share both k-mers in the same order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A packed k-mer: 6 bits bin, 31 bits more of its hash, 26 bits place in the text.
PLACE_BITS = 26
HASH_BITS = 37
BIN_BITS = 6
PLACE_MASK = (1 << PLACE_BITS) - 1
HASH_MASK = (1 << HASH_BITS) - 1
BIN_SHIFT = PLACE_BITS + HASH_BITS - BIN_BITS
PAIR_BITS = 31 - BIN_BITS
# Words longer than this go by characters.
LONG_WORD = 24


def _pack(h: Column, place: Column) -> Column:
    place = F.least(place.cast("bigint"), F.lit(PLACE_MASK).cast("bigint"))
    return F.shiftleft(h.bitwiseAND(F.lit(HASH_MASK)), PLACE_BITS).bitwiseOR(place)


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _bin(packed: Column) -> Column:
    return F.shiftright(packed, BIN_SHIFT)


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = 3) -> DataFrame:
    """``name``: array of ints, one per used bin in bin order, of the non-null ``text``.

    Symbols are words between ASCII white space; words of more than ``LONG_WORD`` characters
    (scripts without spaces, base64) are cut into single characters, in any text. A text of fewer than ``k`` symbols is one k-mer, one
    without symbols is its own k-mer. Each array stands in a column of its own that several
    expressions read, so that Catalyst does not compute it anew for every element.
    """
    tmp = f"__{name}"
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    df = df.withColumn(f"{tmp}_w", words)
    cut = F.flatten(F.transform(f"{tmp}_w", lambda w: F.when(F.length(w) > LONG_WORD, F.split(w, "")).otherwise(F.array(w))))
    has_long = F.col(text).rlike(r"[^\x20\x09-\x0D]{%d}" % (LONG_WORD + 1))
    df = df.withColumn(f"{tmp}_s", F.when(has_long, cut).otherwise(F.col(f"{tmp}_w"))).drop(f"{tmp}_w")

    symbols = F.col(f"{tmp}_s")
    starts = F.slice(symbols, F.lit(1), F.greatest(F.size(symbols) - (k - 1), F.lit(1)))
    hashes = F.transform(starts, lambda x, i: _pack(F.xxhash64(x, *[F.get(symbols, i + j) for j in range(1, k)]), i))
    alone = F.array(_pack(F.xxhash64(text), F.lit(0)))
    df = df.withColumn(f"{tmp}_k", F.sort_array(F.when(F.size(symbols) > 0, hashes).otherwise(alone))).drop(f"{tmp}_s")

    # Equal k-mers are neighbours now, in text order: number them inside their runs.
    kmers = F.col(f"{tmp}_k")
    index = F.sequence(F.lit(0), F.size(kmers) - 1)
    first = F.filter(index, lambda i: (i == 0) | (_hash_of(F.get(kmers, i)) != _hash_of(F.get(kmers, i - 1))))
    df = df.withColumn(f"{tmp}_r", first)
    runs = F.col(f"{tmp}_r")
    run_ends = F.concat(F.slice(runs, F.lit(2), F.greatest(F.size(runs) - 1, F.lit(0))), F.array(F.size(kmers)))
    numbers = F.flatten(F.transform(F.arrays_zip(runs.alias("a"), run_ends.alias("b")), lambda r: F.sequence(F.lit(0), r["b"] - r["a"] - 1)))
    df = df.withColumn(f"{tmp}_o", F.when(F.size(runs) == F.size(kmers), F.array().cast("array<int>")).otherwise(numbers)).drop(f"{tmp}_r")
    number = F.col(f"{tmp}_o")
    some = F.size(number) > 0
    plain = F.transform(kmers, lambda x: _pack(F.xxhash64(_hash_of(x), F.lit(0)), x.bitwiseAND(F.lit(PLACE_MASK))))
    counted = F.transform(
        kmers, lambda x, i: _pack(F.xxhash64(_hash_of(x), F.get(number, i)), x.bitwiseAND(F.lit(PLACE_MASK)))
    )
    df = df.withColumn(f"{tmp}_t", F.sort_array(F.when(some, counted).otherwise(plain))).drop(f"{tmp}_k", f"{tmp}_o")

    # The two smallest of each bin.
    ordered = F.col(f"{tmp}_t")
    least = F.filter(ordered, lambda x, i: (i < 2) | (_bin(F.get(ordered, i - 2)) != _bin(x)))
    df = df.withColumn(f"{tmp}_m", least).drop(f"{tmp}_t")
    chosen = F.col(f"{tmp}_m")
    heads = F.filter(
        F.sequence(F.lit(0), F.size(chosen) - 1), lambda i: (i == 0) | (_bin(F.get(chosen, i - 1)) != _bin(F.get(chosen, i)))
    )

    def pair(i: Column) -> Column:
        # A k-mer alone in its bin is paired with the first of the next bin, so order counts in short texts, too.
        one, two = F.get(chosen, i), F.get(chosen, F.pmod(i + 1, F.size(chosen)))
        a, b = _hash_of(one), _hash_of(two)
        together = F.when(one.bitwiseAND(F.lit(PLACE_MASK)) < two.bitwiseAND(F.lit(PLACE_MASK)), F.xxhash64(a, b)).otherwise(
            F.xxhash64(b, a)
        )
        h = F.when(F.size(chosen) > 1, together).otherwise(F.xxhash64(a))
        return F.shiftleft(_bin(one), PAIR_BITS).bitwiseOR(h.bitwiseAND(F.lit((1 << PAIR_BITS) - 1))).cast("int")

    return df.withColumn(name, F.transform(heads, pair)).drop(f"{tmp}_m")


def likeness(a: str, b: str) -> Column:
    """Share of the bins used by either text in which both have the same pair."""
    bins = [F.transform(F.col(c), lambda x: F.shiftright(x, PAIR_BITS)) for c in (a, b)]
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(*bins))


def as_text(name: str) -> Column:
    return F.array_join(F.transform(F.col(name), lambda x: F.lpad(F.hex(x), 8, "0")), "")


def _id_ranges(docs: DataFrame) -> Column:
    """Number of the id range a row is in, from quantiles of the ids (a list of bounded length)."""
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * parts))).first()[0]
    bounds = sorted(set(found or []))
    if not bounds:
        return F.lit(0)
    # Two short searches instead of one long one.
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    rest = F.array(*[F.array(*[F.lit(x) for x in g]) for g in groups])
    group = F.size(F.filter(heads, lambda b: b <= F.col("doc_id")))
    inside = F.size(F.filter(F.get(rest, group - 1), lambda b: b <= F.col("doc_id")))
    return F.when(F.col("doc_id").isNull() | (group == 0), 0).otherwise((group - 1) * step + inside)


def with_next(docs: DataFrame, columns: list[str], prepare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` with ``next_<column>``: the values of the next row by doc_id, after the last the first.

    Rows are shuffled once, by id range. The first row of every range also goes to the end of
    the range before it, so that windows over single ranges find each row's next one.
    ``prepare`` adds columns to all of them before that shuffle.
    """
    ranged = docs.withColumn("__range", _id_ranges(docs))
    first = ranged.groupBy("__range").agg(F.min(F.struct("doc_id")).alias("f"))
    # As many rows as there are ranges.
    before = F.coalesce(F.lag("__range").over(Window.orderBy("__range")), F.max("__range").over(Window.partitionBy()))
    moved = first.select(F.col("f.doc_id").alias("__first"), before.alias("__to"))
    guests = ranged.join(F.broadcast(moved), F.col("doc_id").eqNullSafe(F.col("__first"))).withColumn("__range", F.col("__to"))
    rows = ranged.withColumn("__guest", F.lit(0)).unionByName(guests.drop("__first", "__to").withColumn("__guest", F.lit(1)))
    rows = prepare(rows)
    order = Window.partitionBy("__range").orderBy("__guest", "doc_id", "__tie")
    for c in columns:
        rows = rows.withColumn(f"next_{c}", F.lead(c).over(order))
    return rows.filter("__guest = 0").drop("__range", "__guest")


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n / 2) code points replaced by the first
    as many of the next row's text, by doc_id, after the last the first; rows of one id follow
    each other by a digest of the text, null ids come first. Null text counts as empty. Equal
    texts have equal fingerprints and likeness 1, which holds for two empty texts. A single
    row is its own next one; an empty table gives an empty one. Extra columns are not looked
    at. Texts are read whole; order among k-mers past place 2^26 of a text is not told apart.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("__tie", F.xxhash64("text"))
    rows = with_next(own, ["text", "print"], lambda r: with_fingerprint(r, "text", "print", k))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("bigint").alias("n_chars"), "print", "next_print", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    rows = with_fingerprint(rows, "edited", "edited_print", k)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        as_text("print").alias("fingerprint"), as_text("edited_print").alias("edited_fingerprint"),
        likeness("print", "edited_print").alias("near_edited"), likeness("print", "next_print").alias("near_next"),
    )
