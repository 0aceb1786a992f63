"""Ranking and revenue metrics, and the tables that compare models over time."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revrank.functions.scores import LOG_FLOOR, rank_discount, sigmoid
from revrank.operators.aggregates import scalar
from revrank.operators.joins import PAIR
from revrank.operators.positions import with_position

METRICS = ["precision_at_k", "ndcg_at_k", "mrr", "hit_rate", "revenue", "discounted_revenue"]
# Columns of the summary table, in print order; the ones that exist are shown.
SUMMARY = [
    "train_total_revenue", "test_total_revenue", "train_avg_revenue", "test_avg_revenue",
    "train_precision_at_k", "test_precision_at_k", "train_ndcg_at_k", "test_ndcg_at_k",
    "train_mrr", "test_mrr", "train_discounted_revenue", "test_discounted_revenue",
]


def dcg_geometric(recs: DataFrame, k: int = 5, factor: float = 0.85) -> DataFrame:
    """Mean over users of relevance * factor^(position - 1) for the first k ranks."""
    window = Window.partitionBy("user_idx").orderBy("rank")
    placed = recs.withColumn("__pos", F.row_number().over(window)).filter(F.col("__pos") <= k)
    per_user = placed.groupBy("user_idx").agg(
        F.sum(F.col("relevance") * F.pow(F.lit(float(factor)), F.col("__pos") - 1)).alias("__dcg")
    )
    return per_user.agg(F.coalesce(F.avg("__dcg"), F.lit(0.0)).alias("dcg"))


def dcg_revenue(recs: DataFrame, held_out: DataFrame, items: DataFrame) -> DataFrame:
    """Mean over held-out edges of the item's price / log2(rank + 1); a miss counts 0."""
    edges = held_out.select(*PAIR).join(items.select("item_idx", "price"), "item_idx")
    gain = F.coalesce(F.col("price") * rank_discount(), F.lit(0.0))
    return edges.join(recs.select(*PAIR, "rank"), PAIR, "left").agg(F.avg(gain).alias("dcg_revenue"))


def user_metrics(recs: DataFrame, test: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Metrics per user who has at least one positive in the test slice.

    Positives are distinct pairs with relevance > 0. The ideal DCG is a sum over the first
    min(k, positives) positions.
    """
    positives = test.filter(F.col("relevance") > 0).select(*PAIR).distinct()
    wanted = positives.groupBy("user_idx").agg(F.count("*").alias("n_pos"))
    prices = items.select("item_idx", "price")
    hits = (
        recs.filter(F.col("rank") <= k)
        .select(*PAIR, "rank")
        .join(positives, PAIR)
        .join(prices, "item_idx")
        .groupBy("user_idx")
        .agg(
            F.count("*").alias("n_hit"),
            F.min("rank").alias("first"),
            F.sum(rank_discount()).alias("dcg"),
            F.sum("price").alias("revenue"),
            F.sum(F.col("price") * rank_discount()).alias("discounted_revenue"),
        )
    )
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.least(F.col("n_pos"), F.lit(k)).cast("int")),
        F.lit(0.0),
        lambda s, r: s + 1.0 / F.log2(r + 1.0),
    )
    zero = F.lit(0.0)
    return wanted.join(hits, "user_idx", "left").select(
        "user_idx",
        (F.coalesce("n_hit", F.lit(0)) / float(k)).alias("precision_at_k"),
        F.coalesce(F.col("dcg") / ideal, zero).alias("ndcg_at_k"),
        F.coalesce(1.0 / F.col("first"), zero).alias("mrr"),
        F.when(F.col("n_hit") > 0, 1.0).otherwise(0.0).alias("hit_rate"),
        F.coalesce("revenue", zero).alias("revenue"),
        F.coalesce("discounted_revenue", zero).alias("discounted_revenue"),
    )


def ranking_metrics(recs: DataFrame, test: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """One row: user means of the rank metrics, sums of the revenue metrics."""
    per = user_metrics(recs, test, items, k)
    means = [F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in METRICS[:4]]
    sums = [F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in METRICS[4:]]
    return per.agg(*means, *sums)


def metric_rows(recs: DataFrame, log: DataFrame, items: DataFrame, k: int, last_train: int, model: str) -> DataFrame:
    """(model, phase, iter, metric, value): the lists against every iteration of the log."""
    positives = log.filter(F.col("relevance") > 0).select(*PAIR, "__iter").distinct()
    wanted = positives.groupBy("__iter", "user_idx").agg(F.count("*").alias("n_pos"))
    hits = (
        recs.filter(F.col("rank") <= k)
        .select(*PAIR, "rank")
        .join(positives, PAIR)
        .join(items.select("item_idx", "price"), "item_idx")
        .groupBy("__iter", "user_idx")
        .agg(
            F.count("*").alias("n_hit"),
            F.min("rank").alias("first"),
            F.sum(rank_discount()).alias("dcg"),
            F.sum("price").alias("rev"),
            F.sum(F.col("price") * rank_discount()).alias("drev"),
        )
    )
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.least(F.col("n_pos"), F.lit(k)).cast("int")),
        F.lit(0.0),
        lambda s, r: s + 1.0 / F.log2(r + 1.0),
    )
    zero = F.lit(0.0)
    wide = wanted.join(hits, ["__iter", "user_idx"], "left").groupBy("__iter").agg(
        F.avg(F.coalesce("n_hit", F.lit(0)) / float(k)).alias("precision_at_k"),
        F.avg(F.coalesce(F.col("dcg") / ideal, zero)).alias("ndcg_at_k"),
        F.avg(F.coalesce(1.0 / F.col("first"), zero)).alias("mrr"),
        F.avg(F.when(F.col("n_hit") > 0, 1.0).otherwise(0.0)).alias("hit_rate"),
        F.sum(F.coalesce("rev", zero)).alias("revenue"),
        F.sum(F.coalesce("drev", zero)).alias("discounted_revenue"),
    )
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])
    phase = F.when(F.col("__iter") <= last_train, "train").otherwise("test")
    return wide.select(
        F.lit(model).alias("model"), phase.alias("phase"), F.col("__iter").alias("iter"), F.inline(rows)
    )


def phase_averages(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("model", "phase", "metric").agg(F.avg("value").alias("value"))


def revenue_totals(metrics: DataFrame) -> DataFrame:
    return (
        metrics.filter(F.col("metric") == "revenue")
        .groupBy("model", "phase")
        .agg(F.sum("value").alias("total_revenue"), F.avg("value").alias("avg_revenue"))
    )


def performance_change(metrics: DataFrame) -> DataFrame:
    """Percent change of the mean revenue from the train to the test phase."""
    by = revenue_totals(metrics).groupBy("model").agg(
        F.max(F.when(F.col("phase") == "train", F.col("avg_revenue"))).alias("tr"),
        F.max(F.when(F.col("phase") == "test", F.col("avg_revenue"))).alias("te"),
    )
    return by.select("model", ((F.try_divide("te", "tr") - 1.0) * 100.0).alias("change_pct"))


def leaderboard_table(metrics: DataFrame) -> DataFrame:
    """One row per model: revenue sums and phase means, best test revenue first."""
    present = [(p, m) for p in ("train", "test") for m in METRICS if m != "revenue"]
    rev = F.col("metric") == "revenue"

    def pick(phase: str, cond: Column) -> Column:
        return F.when((F.col("phase") == phase) & cond, F.col("value"))

    aggs = [F.sum(pick(p, rev)).alias(f"{p}_total_revenue") for p in ("train", "test")]
    aggs += [F.avg(pick(p, rev)).alias(f"{p}_avg_revenue") for p in ("train", "test")]
    aggs += [F.avg(pick(p, F.col("metric") == m)).alias(f"{p}_{m}") for p, m in present]
    wide = metrics.groupBy("model").agg(*aggs)
    shown = [c for c in SUMMARY if c in wide.columns]
    return wide.select("model", *shown).orderBy(F.col("test_total_revenue").desc(), "model")


def model_leaderboard(metrics: DataFrame) -> DataFrame:
    """Models with their rank by total test revenue. There are as many rows as models."""
    totals = revenue_totals(metrics).filter(F.col("phase") == "test").select("model", "total_revenue")
    window = Window.orderBy(F.col("total_revenue").desc(), "model")
    return totals.withColumn("rank", F.row_number().over(window))


def concat_phases(metrics: DataFrame) -> DataFrame:
    """Train then test on one axis: ``step`` goes on counting in the test phase."""
    lengths = metrics.groupBy("model", "phase").agg(F.count_distinct("iter").alias("__n"))
    train = lengths.filter(F.col("phase") == "train").select("model", F.col("__n").alias("__shift"))
    window = Window.partitionBy("model", "phase", "metric").orderBy("iter")
    shift = F.when(F.col("phase") == "test", F.coalesce("__shift", F.lit(0))).otherwise(0)
    return (
        metrics.withColumn("__pos", F.row_number().over(window) - 1)
        .join(train, "model", "left")
        .withColumn("step", F.col("__pos") + shift)
        .drop("__pos", "__shift")
    )


def metric_trajectory(metrics: DataFrame, metric: str) -> DataFrame:
    return concat_phases(metrics.filter(F.col("metric") == metric)).select("model", "phase", "step", "value")


def metric_correlation(metrics: DataFrame) -> DataFrame:
    """Pearson correlation over models of the ``{phase}_{metric}`` means, without revenue columns."""
    columns = [f"{p}_{m}" for p in ("train", "test") for m in METRICS if not m.endswith("revenue")]
    means = phase_averages(metrics).withColumn("column", F.concat_ws("_", "phase", "metric"))
    wide = means.groupBy("model").pivot("column", columns).agg(F.max("value"))
    pairs = [(b, a) for a, b in combinations(columns, 2)]
    one = wide.agg(*[F.corr(a, b).alias(f"__{n}") for n, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), F.col(f"__{n}").alias("corr"))
        for n, (a, b) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*rows)))


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.agg(F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("accuracy"))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve from rank sums, ties counted half.

    Equal scores are grouped first. The running count over the groups is made from
    the distributed position, not from one window over the whole table.
    """
    groups = scored.groupBy(score).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("__p"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("__n"),
    )
    # Score ranges of bounded size: running sums inside a range plus totals of the ranges before.
    placed = with_position(groups, [], [score, "__p"], "__pos").withColumn("__range", F.floor(F.col("__pos") / 65_536))
    inner = Window.partitionBy("__range").orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("__range").agg(F.sum("__n").alias("__rn"))
    totals = totals.select("__range", F.coalesce(F.sum("__rn").over(outer), F.lit(0)).alias("__earlier"))
    below = F.coalesce(F.sum("__n").over(inner), F.lit(0))
    wins = placed.withColumn("__below", below).join(totals, "__range").agg(
        F.sum(F.col("__p") * (F.col("__below") + F.col("__earlier") + F.col("__n") / 2.0)).alias("__wins"),
        F.sum("__p").alias("__tp"),
        F.sum("__n").alias("__tn"),
    )
    return wins.select((F.col("__wins") / (F.col("__tp").cast("double") * F.col("__tn"))).alias("auc"))


def pseudo_revenue(scored: DataFrame, alpha: float, score: str = "score") -> DataFrame:
    from revrank.functions.scores import price_power

    return scored.agg(F.avg(F.col(score) * price_power("price", alpha)).alias("pseudo_revenue"))


def bce_loss(scored: DataFrame, label: str = "label", logit: str = "logit") -> DataFrame:
    """Mean loss of the positives plus mean loss of the negatives."""
    def term(sign: float, keep: int) -> Column:
        chance = F.greatest(sigmoid(F.col(logit) * sign), F.lit(LOG_FLOOR))
        return F.avg(F.when(F.col(label) == keep, -F.log(chance)))

    return scored.agg((term(1.0, 1) + term(-1.0, 0)).alias("bce"))


def relative_log_price(items: DataFrame) -> DataFrame:
    """log1p(price) over its mean, and the square root of that as a loss weight."""
    mean = scalar(items, F.avg(F.log1p("price")))
    rel = F.log1p("price") / mean
    return items.select("item_idx", "price", rel.alias("rel_price"), F.sqrt(rel).alias("loss_weight"))


def fill_missing_price(items: DataFrame) -> DataFrame:
    return items.withColumn("price", F.coalesce("price", scalar(items, F.avg("price"))))
