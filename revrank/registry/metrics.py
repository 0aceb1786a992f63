"""Metrics, losses and model comparison tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from revrank.functions.hashing import draw
from revrank.functions.scores import bpr_term
from revrank.functions.vectors import dot_wide, names, seeded_vector, squares_wide
from revrank.operators import evaluate, ranking, sampling
from revrank.operators.lambdas import lambda_gradients, newton_leaves
from revrank.plans.baselines import PopularityRecommender
from revrank.plans.ngram import NGramRecommender
from revrank.registry.base import draw_sql, q6, query, s6
from revrank.registry.rows import PAIR_SCORES, PAIRS, SPLIT, pair_scores
from revrank.session import cut
from revrank.sources import tables

K = 10
LAST_TRAIN = 3

_TOP = ", r AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM pairs)"


@query(
    "dcg_geometric",
    PAIR_SCORES + _TOP
    + f", u AS (SELECT user_idx, sum(relevance * pow(0.85, rank - 1)) AS g FROM r WHERE rank <= 5 GROUP BY 1) SELECT {s6('avg(g)')} AS dcg FROM u",
)
def _(spark, d):
    out = evaluate.dcg_geometric(ranking.top_k(pair_scores(spark, d), K))
    return out.select(q6("dcg").alias("dcg"))


# Two models learnt from the early iterations, lists not filtered by what was seen.
RECS = SPLIT + """, pop AS (SELECT i.item_idx, row_number() OVER (ORDER BY coalesce(s, 0) DESC, i.item_idx) AS rank FROM sitems i
   LEFT JOIN (SELECT item_idx, sum(relevance) AS s FROM tr GROUP BY 1) USING (item_idx)),
 dear AS (SELECT item_idx, row_number() OVER (ORDER BY price DESC, item_idx) AS rank FROM sitems),
 recs AS (SELECT 'popularity' AS model, user_idx, item_idx, rank FROM susers CROSS JOIN pop WHERE rank <= 10
   UNION ALL SELECT 'price', user_idx, item_idx, rank FROM susers CROSS JOIN dear WHERE rank <= 10),
 pos AS (SELECT DISTINCT user_idx, item_idx, "__iter" AS iter FROM slog WHERE relevance > 0)"""

_IDEAL = "list_sum(list_transform(range(1, CAST(least(n_pos, 10) AS BIGINT) + 1), lambda x: 1.0::DOUBLE / log2(x + 1)))"

METRICS = RECS + f""", hits AS (SELECT model, iter, user_idx, count(*) AS n_hit, min(rank) AS first, sum(1.0::DOUBLE / log2(rank + 1)) AS dcg,
   sum(price) AS rev, sum(price / log2(rank + 1)) AS drev FROM recs JOIN pos USING (user_idx, item_idx) JOIN sitems USING (item_idx) GROUP BY ALL),
 wanted AS (SELECT iter, user_idx, count(*) AS n_pos FROM pos GROUP BY ALL),
 wide AS (SELECT model, iter, avg(coalesce(n_hit, 0) / 10.0) AS precision_at_k, avg(coalesce(dcg / {_IDEAL}, 0)) AS ndcg_at_k,
   avg(coalesce(1.0::DOUBLE / first, 0)) AS mrr, avg(CASE WHEN n_hit > 0 THEN 1.0 ELSE 0.0 END) AS hit_rate,
   sum(coalesce(rev, 0)) AS revenue, sum(coalesce(drev, 0)) AS discounted_revenue
   FROM wanted CROSS JOIN (VALUES ('popularity'), ('price')) m(model) LEFT JOIN hits USING (model, iter, user_idx) GROUP BY ALL),
 metrics AS ({' UNION ALL '.join(f"SELECT model, CASE WHEN iter <= 3 THEN 'train' ELSE 'test' END AS phase, iter, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM wide" for m in evaluate.METRICS)})"""


def model_lists(spark, d):
    train, _test = sampling.temporal_split(tables.star_log(spark, d), LAST_TRAIN)
    users, items = tables.star_users(spark, d), tables.star_items(spark, d)
    models = {"popularity": PopularityRecommender(), "price": NGramRecommender()}
    return {
        name: m.fit(train).predict(train, K, users, items, filter_seen_items=False) for name, m in models.items()
    }


def metrics_table(spark, d):
    log, items = tables.star_log(spark, d), tables.star_items(spark, d)
    out = None
    for name, recs in model_lists(spark, d).items():
        rows = evaluate.metric_rows(recs, log, items, K, LAST_TRAIN, name)
        out = rows if out is None else out.unionByName(rows)
    return cut(out)


@query("metric_rows", METRICS + f" SELECT model, phase, iter, metric, {s6('value')} AS value FROM metrics")
def _(spark, d):
    return metrics_table(spark, d).withColumn("value", q6("value"))


@query("phase_averages", METRICS + f" SELECT model, phase, metric, {s6('avg(value)')} AS value FROM metrics GROUP BY ALL")
def _(spark, d):
    return evaluate.phase_averages(metrics_table(spark, d)).withColumn("value", q6("value"))


_REV = METRICS + ", rv AS (SELECT model, phase, sum(value) AS total_revenue, avg(value) AS avg_revenue FROM metrics WHERE metric = 'revenue' GROUP BY ALL)"


@query("revenue_totals", _REV + f" SELECT model, phase, {s6('total_revenue')} AS total_revenue, {s6('avg_revenue')} AS avg_revenue FROM rv")
def _(spark, d):
    out = evaluate.revenue_totals(metrics_table(spark, d))
    return out.withColumns({"total_revenue": q6("total_revenue"), "avg_revenue": q6("avg_revenue")})


@query(
    "performance_change",
    _REV + f""" SELECT a.model, {s6('(b.avg_revenue / nullif(a.avg_revenue, 0) - 1) * 100')} AS change_pct
    FROM rv a JOIN rv b ON a.model = b.model AND a.phase = 'train' AND b.phase = 'test'""",
)
def _(spark, d):
    return evaluate.performance_change(metrics_table(spark, d)).withColumn("change_pct", q6("change_pct"))


def _lead(phase, metric, fn):
    return f"{fn}(CASE WHEN phase = '{phase}' AND metric = '{metric}' THEN value END)"


_LEADS = ", ".join(
    f"{s6(_lead(c.split('_')[0], 'revenue' if c.endswith(('total_revenue', 'avg_revenue')) else c.split('_', 1)[1], 'sum' if 'total' in c else 'avg'))} AS {c}"
    for c in evaluate.SUMMARY
)


@query("leaderboard_table", METRICS + f" SELECT model, {_LEADS} FROM metrics GROUP BY 1")
def _(spark, d):
    out = evaluate.leaderboard_table(metrics_table(spark, d))
    return out.withColumns({c: q6(c) for c in out.columns if c != "model"})


@query(
    "model_leaderboard",
    _REV + f" SELECT model, {s6('total_revenue')} AS total_revenue, row_number() OVER (ORDER BY total_revenue DESC, model) AS rank FROM rv WHERE phase = 'test'",
    ints=("rank",),
)
def _(spark, d):
    return evaluate.model_leaderboard(metrics_table(spark, d)).withColumn("total_revenue", q6("total_revenue"))


_STEPS = METRICS + """, n AS (SELECT model, count(DISTINCT iter) AS n FROM metrics WHERE phase = 'train' GROUP BY 1),
 steps AS (SELECT m.*, row_number() OVER (PARTITION BY m.model, phase, metric ORDER BY iter) - 1 + CASE WHEN phase = 'test' THEN coalesce(n, 0) ELSE 0 END AS step
 FROM metrics m LEFT JOIN n USING (model))"""


@query("concat_phases", _STEPS + f" SELECT model, phase, iter, metric, {s6('value')} AS value, step FROM steps")
def _(spark, d):
    return evaluate.concat_phases(metrics_table(spark, d)).withColumn("value", q6("value"))


@query("metric_trajectory", _STEPS + f" SELECT model, phase, step, {s6('value')} AS value FROM steps WHERE metric = 'discounted_revenue'")
def _(spark, d):
    return evaluate.metric_trajectory(metrics_table(spark, d), "discounted_revenue").withColumn("value", q6("value"))


_CC = [f"{p}_{m}" for p in ("train", "test") for m in evaluate.METRICS if not m.endswith("revenue")]
_CWIDE = ", ".join(
    f"avg(CASE WHEN phase = '{c.split('_')[0]}' AND metric = '{c.split('_', 1)[1]}' THEN value END) AS {c}" for c in _CC
)
_CPAIRS = " UNION ALL ".join(
    f"SELECT '{_CC[b]}' AS \"row\", '{_CC[a]}' AS col, CAST(round(corr({_CC[b]}, {_CC[a]}), 6) AS DOUBLE) AS corr FROM cw"
    for a in range(len(_CC)) for b in range(a + 1, len(_CC))
)


@query("metric_correlation", METRICS + f", cw AS (SELECT model, {_CWIDE} FROM metrics GROUP BY 1) {_CPAIRS}")
def _(spark, d):
    out = evaluate.metric_correlation(metrics_table(spark, d))
    return out.withColumn("corr", F.round("corr", 6))


_RM = RECS + f""", tpos AS (SELECT DISTINCT user_idx, item_idx FROM te WHERE relevance > 0),
 hits AS (SELECT user_idx, count(*) AS n_hit, min(rank) AS first, sum(1.0::DOUBLE / log2(rank + 1)) AS dcg, sum(price) AS rev,
   sum(price / log2(rank + 1)) AS drev FROM recs JOIN tpos USING (user_idx, item_idx) JOIN sitems USING (item_idx) WHERE model = 'popularity' GROUP BY 1),
 wanted AS (SELECT user_idx, count(*) AS n_pos FROM tpos GROUP BY 1), j AS (SELECT * FROM wanted LEFT JOIN hits USING (user_idx))"""
_RM_EXPR = {
    "precision_at_k": "avg(coalesce(n_hit, 0) / 10.0)",
    "ndcg_at_k": f"avg(coalesce(dcg / {_IDEAL}, 0))",
    "mrr": "avg(coalesce(1.0::DOUBLE / first, 0))",
    "hit_rate": "avg(CASE WHEN n_hit > 0 THEN 1.0 ELSE 0.0 END)",
    "revenue": "sum(coalesce(rev, 0))",
    "discounted_revenue": "sum(coalesce(drev, 0))",
}


def _metric_query(metric):
    @query(metric, _RM + f" SELECT {s6(_RM_EXPR[metric])} AS {metric} FROM j")
    def _(spark, d):
        recs = model_lists(spark, d)["popularity"]
        _train, test = sampling.temporal_split(tables.star_log(spark, d), LAST_TRAIN)
        out = evaluate.ranking_metrics(recs, test, tables.star_items(spark, d), K)
        return out.select(q6(metric).alias(metric))


for _m in evaluate.METRICS:
    _metric_query(_m)


@query(
    "dcg_revenue",
    RECS + f""", held AS (SELECT DISTINCT user_idx, item_idx FROM te)
    SELECT {s6("avg(coalesce(price / log2(rank + 1), 0))")} AS dcg_revenue FROM held JOIN sitems USING (item_idx)
    LEFT JOIN (SELECT * FROM recs WHERE model = 'popularity') USING (user_idx, item_idx)""",
)
def _(spark, d):
    recs = model_lists(spark, d)["popularity"]
    _train, test = sampling.temporal_split(tables.star_log(spark, d), LAST_TRAIN)
    out = evaluate.dcg_revenue(recs, sampling.distinct_edges(test), tables.star_items(spark, d))
    return out.select(q6("dcg_revenue").alias("dcg_revenue"))


_RATED = SPLIT + """, p AS (SELECT item_idx, avg(relevance) AS rate FROM tr GROUP BY 1),
 s AS (SELECT coalesce(rate, 0) AS score, CAST(coalesce(rate, 0) >= 0.4 AS INTEGER) AS prediction, CAST(relevance > 0 AS INTEGER) AS label, i.price
   FROM te LEFT JOIN p USING (item_idx) JOIN sitems i USING (item_idx))"""


def _rated(spark, d):
    train, test = sampling.temporal_split(tables.star_log(spark, d), LAST_TRAIN)
    rates = train.groupBy("item_idx").agg(F.avg("relevance").alias("rate"))
    items = tables.star_items(spark, d).select("item_idx", "price")
    scored = test.drop("price").join(rates, "item_idx", "left").join(items, "item_idx")
    rate = F.coalesce("rate", F.lit(0.0))
    return scored.select(
        rate.alias("score"), (rate >= 0.4).cast("int").alias("prediction"), (F.col("relevance") > 0).cast("int").alias("label"), "price"
    )


@query("accuracy", _RATED + f" SELECT {s6('avg(CAST(label = prediction AS INTEGER))')} AS accuracy FROM s")
def _(spark, d):
    return evaluate.accuracy(_rated(spark, d)).select(q6("accuracy").alias("accuracy"))


@query("pseudo_revenue", _RATED + f" SELECT {s6('avg(score * pow(price, 0.8))')} AS pseudo_revenue FROM s")
def _(spark, d):
    return evaluate.pseudo_revenue(_rated(spark, d), 0.8).select(q6("pseudo_revenue").alias("pseudo_revenue"))


@query(
    "bce_loss",
    _RATED + f" SELECT {s6('avg(CASE WHEN label = 1 THEN ln(1 + exp(-score)) END) + avg(CASE WHEN label = 0 THEN ln(1 + exp(score)) END)')} AS bce FROM s",
)
def _(spark, d):
    return evaluate.bce_loss(_rated(spark, d), logit="score").select(q6("bce").alias("bce"))


# Loss terms over click edges, one hashed negative each, repeatable vectors.
D = 4
_VEC = {s: " + ".join(f"sin((user_idx + 1)::DOUBLE * {j + 1}.0) * sin(({s} + 1)::DOUBLE * {j + 1}.0)" for j in range(D)) for s in ("item_idx", "neg_idx")}
_SQ = " + ".join(f"pow(sin(({s} + 1)::DOUBLE * {j + 1}.0), 2)" for s in ("user_idx", "item_idx", "neg_idx") for j in range(D))
_SAMPLES = f""", edges AS (SELECT DISTINCT user_idx, item_idx FROM elog), m AS (SELECT avg(ln(1 + price)) AS m, max(price) AS top FROM eitems),
 sm0 AS (SELECT *, {draw_sql('user_idx', 'item_idx', '0', '42')} % (SELECT max(item_idx) + 1 FROM elog) AS neg_idx FROM edges),
 sm AS (SELECT {_VEC['item_idx']} AS pos, {_VEC['neg_idx']} AS neg, {_SQ} AS sq, price / top AS wp, sqrt(ln(1 + price) / m) AS wl
   FROM sm0 JOIN eitems USING (item_idx), m)"""


def _samples(spark, d):
    edges = sampling.distinct_edges(tables.event_log(spark, d))
    items = tables.event_items(spark, d)
    n_items = edges.agg(F.max("item_idx")).first()[0] + 1
    rel = evaluate.relative_log_price(items).select("item_idx", "price", "loss_weight")
    out = sampling.negative_sample_uniform(edges, n_items).join(rel, "item_idx")
    for key, prefix in (("user_idx", "u"), ("item_idx", "i"), ("neg_idx", "n")):
        out = out.select("*", *[c.alias(f"{prefix}{j}") for j, c in enumerate(seeded_vector(key, D))])
    return out.select(
        dot_wide("u", "i", D).alias("pos"), dot_wide("u", "n", D).alias("neg"), "price", "loss_weight",
        (squares_wide("u", D) + squares_wide("i", D) + squares_wide("n", D)).alias("sq"),
    )


_BPR = "ln(1 + exp(-(pos - neg)))"


@query(
    "bpr_loss",
    _SAMPLES + f" SELECT {s6(f'avg({_BPR})')} AS plain, {s6(f'avg(wp * {_BPR})')} AS by_price, {s6(f'avg(wl * {_BPR})')} AS by_log_price FROM sm",
)
def _(spark, d):
    from revrank.operators.aggregates import scalar

    top = scalar(tables.event_items(spark, d), F.max("price"))
    return _samples(spark, d).agg(
        q6(F.avg(bpr_term("pos", "neg"))).alias("plain"),
        q6(F.avg(bpr_term("pos", "neg", F.col("price") / top))).alias("by_price"),
        q6(F.avg(bpr_term("pos", "neg", F.col("loss_weight")))).alias("by_log_price"),
    )


@query("l2_regularizer", _SAMPLES + f" SELECT {s6('0.0008 * 0.5 * avg(sq)')} AS penalty FROM sm")
def _(spark, d):
    return _samples(spark, d).agg(q6(F.avg("sq") * 0.5 * 0.0008).alias("penalty"))


_LAMBDA = f""", rows0 AS (SELECT event_id, user_idx, CAST(relevance > 0 AS INTEGER) AS label, {draw_sql('event_id', '5')} / 4294967296.0::DOUBLE AS score FROM elog),
 rk AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, event_id) AS rank FROM rows0),
 idl AS (SELECT user_idx, list_sum(list_transform(range(1, CAST(least(sum(label), 10) AS BIGINT) + 1), lambda x: 1.0::DOUBLE / log2(x + 1))) AS ideal FROM rows0 GROUP BY 1),
 pr AS (SELECT a.event_id AS a, b.event_id AS b, a.label > b.label AS a_high,
   abs(1.0::DOUBLE / log2(a.rank + 1) - 1.0::DOUBLE / log2(b.rank + 1)) / ideal AS gap,
   CASE WHEN a.label > b.label THEN a.score - b.score ELSE b.score - a.score END AS margin
   FROM rk a JOIN rk b ON a.user_idx = b.user_idx AND a.rank < b.rank AND a.rank <= 30 AND a.label <> b.label JOIN idl ON idl.user_idx = a.user_idx),
 g AS (SELECT *, gap / (1 + exp(margin)) AS push, gap / (1 + exp(margin)) * (1 - 1 / (1 + exp(margin))) AS curve FROM pr),
 both_ends AS (SELECT a AS event_id, CASE WHEN a_high THEN push ELSE -push END AS l, curve AS h FROM g
   UNION ALL SELECT b, CASE WHEN a_high THEN -push ELSE push END, curve FROM g),
 sums AS (SELECT event_id, sum(l) AS l, sum(h) AS h FROM both_ends GROUP BY 1)
 SELECT event_id, user_idx, {s6('coalesce(l, 0)')} AS lambda, {s6('coalesce(h, 0)')} AS hessian FROM rows0 LEFT JOIN sums USING (event_id)"""


def _lambda_rows(spark, d):
    rows = tables.event_log(spark, d).select(
        "event_id", "user_idx", (F.col("relevance") > 0).cast("int").alias("label"),
        (draw("event_id", F.lit(5)) / 4294967296.0).alias("score"),
    )
    return lambda_gradients(rows, "event_id")


@query("lambda_gradients", _LAMBDA)
def _(spark, d):
    out = _lambda_rows(spark, d)
    return out.select("event_id", "user_idx", q6("lambda").alias("lambda"), q6("hessian").alias("hessian"))


_LEAVES = _LAMBDA[: _LAMBDA.rindex(" SELECT event_id")] + f""" SELECT item_idx % 16 AS leaf,
 {s6('sum((1 + abs(coalesce(price, 0))) * coalesce(l, 0)) / (sum((1 + abs(coalesce(price, 0))) * coalesce(h, 0)) + 5)')} AS value
 FROM elog LEFT JOIN sums USING (event_id) GROUP BY 1"""


@query("newton_leaf_values", _LEAVES)
def _(spark, d):
    weight = 1 + F.abs(F.coalesce("price", F.lit(0.0)))
    placed = tables.event_log(spark, d).select("event_id", (F.col("item_idx") % 16).alias("leaf"), weight.alias("w"))
    leaves = newton_leaves(_lambda_rows(spark, d).join(placed, "event_id"), "leaf", 5.0)
    return leaves.select("leaf", q6("value").alias("value"))
