"""Mixing sources to target weights.

Documents get hash-random keys and lie in that order inside their source. Prefix sums of
their sizes say where each one starts; a source gives what lies before its budget, after as
many whole rounds over all of it as the budget holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revrank.llm.common import running_totals, without, word_count
from revrank.operators.ranking import global_rank
from revrank.session import cut

KEY_BITS = 52
ADDED = ["size", "source_size", "target", "taken"]


def random_key(seed: str) -> Column:
    """A whole number below 2^52 from the document's id: reruns agree."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")


def source_targets(totals: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """Targets per source: shares by weight, none above ``cap`` times its own size.

    ``totals``: source (null is one source), source_size. The sum of all sizes is shared by
    weight; what a source cannot take goes to the others by weight. With a common level L
    the answer is min(cap * size, L * weight), so only L is searched: the capped set grows
    from round to round, and each round reads three sums of this small table.
    """
    ranked = global_rank(
        totals.withColumn("__null", F.col("source").isNull()).withColumn("__name", F.coalesce("source", F.lit(""))),
        ["__null", "__name"],
    )
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    weighted = cut(ranked.select("source", "source_size", "n_docs", weight.cast("bigint").alias("weight")))
    most = F.col("source_size") * cap
    whole = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    total, level = whole[0] or 0, 0.0
    if total > 0:
        level, before = total / whole[1], None
        while True:
            full = most <= F.lit(level) * F.col("weight")
            capped, n, open_weight = weighted.agg(
                F.coalesce(F.sum(F.when(full, most)), F.lit(0)),
                F.count(F.when(full, 1)),
                F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            ).first()
            if n == before or open_weight == 0:
                break
            before, level = n, (total - capped) / open_weight
    target = F.least(most.cast("double"), F.lit(float(level)) * F.col("weight"))
    return weighted.withColumn("target", target)


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
    seed: str = "mix",
    rows_per_bucket: int = 256,
) -> DataFrame:
    """Every document with ``size, source_size, target, taken``.

    ``weights`` repeat over the sources in code point order, null last. ``taken`` counts the
    words the mix takes from a document: whole rounds over the source first, then the
    documents before the budget's end in key order; the document at the end gives only the
    words that still fit, so a source's sum is its target rounded to a whole word, and no
    document gives more than ``cap`` times its size.

    Null or empty text: size 0, taken 0. Null source: a source of its own. Null or repeated
    ids: rows with one key follow each other by size, then digest of the text; equal rows
    share the places between them. Result names replace input columns of those names. An
    empty table gives an empty one. A hot source is many buckets of ``rows_per_bucket`` rows
    each, since keys are even; no window sees more than a bucket.
    """
    sized = without(docs, ADDED).withColumn("size", word_count("text"))
    totals = cut(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")))
    targets = cut(source_targets(totals, weights, cap))
    plan = targets.select(F.col("source").alias("__source"), "source_size", "n_docs", "target")
    bucket = F.floor(F.col("__key") / F.lit(float(1 << KEY_BITS)) * F.ceil(F.col("n_docs") / rows_per_bucket))
    keyed = (
        sized.withColumn("__key", random_key(seed))
        .join(plan, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("__bucket", bucket.cast("bigint"))
        .withColumn("__tie", F.xxhash64("text"))
        .drop("n_docs", "__source")
        # A null source must meet itself in joins and windows.
        .withColumn("__group", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")))
    )
    sums = cut(keyed.groupBy("__group", "__bucket").agg(F.sum("size").alias("words")))
    starts = running_totals(sums, ["__group"], "__bucket", "words").drop("words")
    order = Window.partitionBy("__group", "__bucket").orderBy("__key", "doc_id", "size", "__tie")
    inside = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = keyed.withColumn("__inside", inside).join(starts, ["__group", "__bucket"])
    start = F.col("before") + F.col("__inside")
    budget = F.floor(F.col("target") + 0.5).cast("bigint")
    rounds = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = F.greatest(F.lit(0), F.least(F.col("size"), budget - rounds * F.col("source_size") - start))
    taken = (rounds * F.col("size") + rest).cast("bigint")
    return placed.withColumn("taken", taken).drop(
        "__key", "__bucket", "__tie", "__group", "__inside", "before"
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as rows of ``docs``: one row per round a document is in, none if it is in none.

    The one document per source at the budget's end comes last with its first words only.
    """
    mixed = mix_sources(docs, **settings)
    pieces = F.split("text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    part = (F.col("taken") % F.col("size")).cast("int")
    lead = F.when(F.regexp_like("text", F.lit(r"^[\x20\x09-\x0D]")), 1).otherwise(0)
    cut_text = F.array_join(F.slice(pieces, F.lit(1), part + lead), "")
    whole = F.array_repeat(F.col("text"), F.floor(F.col("taken") / F.col("size")).cast("int"))
    copies = F.when(part > 0, F.concat(whole, F.array(cut_text))).otherwise(whole)
    kept = mixed.filter(F.col("taken") > 0).withColumn("__copy", F.explode(copies))
    columns = [F.col("__copy").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns)
