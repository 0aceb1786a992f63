"""Recommendation lists that SQL can check, and the scoring operators behind them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from revrank.functions.vectors import seeded_vector, to_array
from revrank.operators import joins, ranking, sampling, scoring
from revrank.operators.blocked import blocked_topk, dot_bound
from revrank.plans.baselines import ContentRecommender, PopularityRecommender, RandomRecommender
from revrank.plans.ngram import NGramRecommender
from revrank.registry.base import draw_sql, q6, query, s6
from revrank.registry.rows import PAIR_SCORES, PAIRS, SPLIT
from revrank.registry.sequences import grams
from revrank.sources import tables

D = 4
K = 10


def _rounded(recs):
    return recs.select(*PAIRS, q6("relevance").alias("relevance"), "rank")


_RANKED = ", r AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM cand)"
_UNSEEN = "NOT EXISTS (SELECT 1 FROM {log} s WHERE s.user_idx = u.user_idx AND s.item_idx = i.item_idx)"
_LIST = f" SELECT user_idx, item_idx, {s6('relevance')} AS relevance, rank FROM r WHERE rank <= {K}"


def price_lists(spark, d):
    """Flagship: best expected revenue among unseen items for every user."""
    model = NGramRecommender().fit(tables.star_log(spark, d))
    return model.predict(
        tables.star_log(spark, d), K, tables.star_users(spark, d), tables.star_items(spark, d)
    )


@query(
    "rec_price_constant",
    f""", cand AS (SELECT u.user_idx, i.item_idx, i.price * 0.0001::DOUBLE AS relevance FROM susers u CROSS JOIN sitems i
      WHERE {_UNSEEN.format(log='slog')})""" + _RANKED + _LIST,
    ints=("rank",),
)
def _(spark, d):
    return _rounded(price_lists(spark, d))


# The models learn from the early iterations and rank all items.
_LAST = """, lastp AS (SELECT item_idx, arg_max(price, ("timestamp", event_id)) AS price FROM etr GROUP BY 1),
 cp AS (SELECT i.item_idx, coalesce(l.price, i.price, 1.0) AS price FROM eitems i LEFT JOIN lastp l USING (item_idx))"""
_PAIRS = f", q AS (SELECT u.user_idx, i.item_idx, i.price, w.c1, w.c2 FROM eusers u CROSS JOIN cp i LEFT JOIN newest w USING (user_idx) WHERE {_UNSEEN.format(log='etr')})"


def _ngram(spark, d, smoothing):
    log = tables.event_log(spark, d)
    train, _test = sampling.temporal_split(log, 3)
    model = NGramRecommender(smoothing=smoothing, time=tables.EVENT_ORDER).fit(train)
    return model.predict(train, K, tables.event_users(spark, d), tables.event_items(spark, d))


@query(
    "rec_ngram_addk",
    SPLIT + grams("etr") + _LAST + _PAIRS
    + """, v AS (SELECT count(DISTINCT item_idx) AS v FROM etr),
    full_ctx AS (SELECT q.*, CASE WHEN c2 IS NULL THEN CAST(c1 AS VARCHAR) ELSE c2 || ',' || c1 END AS ctx FROM q),
    cand AS (SELECT f.user_idx, f.item_idx, f.price * CASE WHEN t.total IS NULL OR vi.item_idx IS NULL THEN 0.001::DOUBLE / (0.001::DOUBLE * v.v)
      ELSE (coalesce(c.c, 0) + 0.001::DOUBLE) / (t.total + 0.001::DOUBLE * v.v) END AS relevance
      FROM full_ctx f CROSS JOIN v LEFT JOIN totals t ON t.ctx = f.ctx LEFT JOIN counts c ON c.ctx = f.ctx AND c.item_idx = f.item_idx
      LEFT JOIN (SELECT DISTINCT item_idx FROM etr) vi ON vi.item_idx = f.item_idx)"""
    + _RANKED + _LIST,
    ints=("rank",),
)
def _(spark, d):
    return _rounded(_ngram(spark, d, "add-k"))


@query(
    "rec_ngram_backoff",
    SPLIT + grams("etr") + _LAST + _PAIRS
    + """, pr AS (SELECT ctx, item_idx, c / total AS p FROM counts JOIN totals USING (ctx)),
    cand AS (SELECT q.user_idx, q.item_idx, q.price * coalesce(b2.p, b1.p, 1e-6::DOUBLE) AS relevance FROM q
      LEFT JOIN pr b2 ON b2.ctx = q.c2 || ',' || q.c1 AND b2.item_idx = q.item_idx
      LEFT JOIN pr b1 ON b1.ctx = CAST(q.c1 AS VARCHAR) AND b1.item_idx = q.item_idx)"""
    + _RANKED + _LIST,
    ints=("rank",),
)
def _(spark, d):
    return _rounded(_ngram(spark, d, "back-off"))


@query(
    "rec_popularity",
    f""", pop AS (SELECT item_idx, sum(pow(relevance, 0.5)) AS s FROM slog GROUP BY 1),
    cand AS (SELECT u.user_idx, i.item_idx, coalesce(p.s, 0) AS relevance FROM susers u CROSS JOIN sitems i LEFT JOIN pop p USING (item_idx)
      WHERE {_UNSEEN.format(log='slog')})""" + _RANKED + _LIST,
    ints=("rank",),
)
def _(spark, d):
    log = tables.star_log(spark, d)
    model = PopularityRecommender(alpha=0.5).fit(log)
    return _rounded(model.predict(log, K, tables.star_users(spark, d), tables.star_items(spark, d)))


@query(
    "rec_random",
    f""", ring AS (SELECT item_idx, row_number() OVER (ORDER BY {draw_sql('item_idx', '7')}, item_idx) - 1 AS slot FROM sitems),
    n AS (SELECT count(*) AS n FROM sitems),
    cand AS (SELECT u.user_idx, i.item_idx, 1.0 - ((i.slot - {draw_sql("'start'", 'u.user_idx', '7')} % n.n + n.n) % n.n) / CAST(n.n AS DOUBLE) AS relevance
      FROM susers u CROSS JOIN ring i CROSS JOIN n WHERE {_UNSEEN.format(log='slog')})""" + _RANKED + _LIST,
    ints=("rank",),
)
def _(spark, d):
    log = tables.star_log(spark, d)
    model = RandomRecommender(seed=7).fit(log)
    return _rounded(model.predict(log, K, tables.star_users(spark, d), tables.star_items(spark, d)))


_DIM = 64
_UNIT = "list_transform(v, lambda x: x / sqrt(list_dot_product(v, v)))"


@query(
    "rec_content",
    f""", raw AS (SELECT vec_id AS item_idx, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    unit AS (SELECT item_idx, {_UNIT} AS iv FROM raw),
    liked AS (SELECT DISTINCT user_idx, item_idx FROM elog WHERE relevance > 0),
    flat AS (SELECT user_idx, j, avg(iv[j]) AS x FROM liked JOIN unit USING (item_idx), range(1, {_DIM + 1}) t(j) GROUP BY ALL),
    prof0 AS (SELECT user_idx, list(x ORDER BY j) AS v FROM flat GROUP BY 1),
    prof AS (SELECT user_idx, {_UNIT} AS uv FROM prof0),
    cand0 AS (SELECT u.user_idx, i.item_idx, {s6('list_dot_product(uv, iv)')} AS relevance FROM prof u CROSS JOIN unit i
      WHERE {_UNSEEN.format(log='elog')}),
    cand AS (SELECT * FROM cand0 WHERE relevance >= 0.05)""" + _RANKED + _LIST,
    ints=("rank",),
)
def _(spark, d):
    log = tables.event_log(spark, d)
    vectors = spark.read.parquet(f"{d}/embeddings.parquet").select(
        F.col("vec_id").alias("item_idx"), F.col("embedding").cast("array<double>").alias("vector")
    )
    model = ContentRecommender(similarity_threshold=0.05).fit(log, None, vectors)
    return _rounded(model.predict(log, K, tables.event_users(spark, d), vectors))


# --- scoring ------------------------------------------------------------------------

_U = ", ".join(f"sin(CAST(user_idx + 1 AS DOUBLE) * {j + 1}.0)" for j in range(D))
_I = ", ".join(f"sin(CAST(item_idx + 1 AS DOUBLE) * {j + 1}.0)" for j in range(D))
_DOT = " + ".join(
    f"sin(CAST(u.user_idx + 1 AS DOUBLE) * {j + 1}.0) * sin(CAST(i.item_idx + 1 AS DOUBLE) * {j + 1}.0)" for j in range(D)
)


def seeded_users(users):
    return users.select("user_idx", *seeded_vector("user_idx", D)).select("user_idx", to_array(D).alias("uvec"))


def seeded_items(items):
    return items.select("item_idx", *seeded_vector("item_idx", D)).select("item_idx", to_array(D).alias("ivec"))


def six_digits(u: np.ndarray, i: np.ndarray) -> np.ndarray:
    return np.floor((u @ i.T) * 1e6 + 0.50001) / 1e6


def six_digits_bound(ulo: np.ndarray, uhi: np.ndarray, ilo: np.ndarray, ihi: np.ndarray) -> np.ndarray:
    return dot_bound(ulo, uhi, ilo, ihi) + 1e-6


@query(
    "dot_product_scores",
    f" SELECT u.user_idx, u.item_idx, {s6(_DOT)} AS logit FROM (SELECT DISTINCT user_idx, item_idx FROM slog) u JOIN sitems i USING (item_idx)",
)
def _(spark, d):
    pairs = sampling.distinct_edges(tables.star_log(spark, d))
    users, items = seeded_users(tables.star_users(spark, d)), seeded_items(tables.star_items(spark, d))
    return scoring.dot_product_scores(pairs, users, items).select(*PAIRS, q6("logit").alias("logit"))


_BLOCK = f""", cand AS (SELECT u.user_idx, i.item_idx, {s6(_DOT)} AS relevance FROM susers u CROSS JOIN sitems i
      WHERE {_UNSEEN.format(log='slog')})"""


@query("blocked_topk", _BLOCK + _RANKED + _LIST, ints=("rank",))
def _(spark, d):
    log = tables.star_log(spark, d)
    users, items = seeded_users(tables.star_users(spark, d)), seeded_items(tables.star_items(spark, d))
    return _rounded(blocked_topk(users, items, K, six_digits, sampling.distinct_edges(log), bound=six_digits_bound))


@query(
    "exclude_seen_after_topk",
    f""", cand AS (SELECT u.user_idx, i.item_idx, {s6(_DOT)} AS relevance FROM eusers u CROSS JOIN eitems i)"""
    + _RANKED
    + f", u AS (SELECT * FROM r WHERE rank <= {K}) SELECT user_idx, item_idx, {s6('relevance')} AS relevance, rank FROM u"
    + " WHERE NOT EXISTS (SELECT 1 FROM elog s WHERE s.user_idx = u.user_idx AND s.item_idx = u.item_idx)",
    ints=("rank",),
)
def _(spark, d):
    log = tables.event_log(spark, d)
    users, items = seeded_users(tables.event_users(spark, d)), seeded_items(tables.event_items(spark, d))
    return _rounded(joins.exclude_seen(blocked_topk(users, items, K, six_digits, bound=six_digits_bound), log))


@query(
    "topk_validation",
    SPLIT
    + f""", cand AS (SELECT u.user_idx, i.item_idx, {s6(_DOT)} AS relevance FROM (SELECT DISTINCT user_idx FROM ete) u CROSS JOIN eitems i)"""
    + _RANKED
    + " SELECT v.user_idx, v.item_idx, r.rank FROM (SELECT DISTINCT user_idx, item_idx FROM ete) v"
    + " LEFT JOIN (SELECT * FROM r WHERE rank <= 20) r USING (user_idx, item_idx)",
    ints=("rank",),
)
def _(spark, d):
    _train, test = sampling.temporal_split(tables.event_log(spark, d), 3)
    held = sampling.distinct_edges(test)
    users, items = seeded_users(held.select("user_idx").distinct()), seeded_items(tables.event_items(spark, d))
    best = blocked_topk(users, items, 20, six_digits, bound=six_digits_bound)
    return held.join(best.select(*PAIRS, "rank"), PAIRS, "left")


@query(
    "cold_user_scores",
    SPLIT
    + f""", cold AS (SELECT user_idx FROM susers WHERE user_idx % 3 = 0),
    cand AS (SELECT u.user_idx, i.item_idx, i.price * 0.0001::DOUBLE AS relevance FROM cold u CROSS JOIN sitems i
      WHERE NOT EXISTS (SELECT 1 FROM slog s WHERE s.user_idx % 3 > 0 AND s.user_idx = u.user_idx AND s.item_idx = i.item_idx))"""
    + _RANKED + _LIST,
    ints=("rank",),
)
def _(spark, d):
    # A third of the users get no history at all.
    log = tables.star_log(spark, d).filter(F.col("user_idx") % 3 > 0)
    cold = tables.star_users(spark, d).join(log, "user_idx", "left_anti")
    return _rounded(NGramRecommender().fit(log).predict(log, K, cold, tables.star_items(spark, d)))


_ALL_PAIRS = """, t AS (SELECT u.user_idx, u.item_idx, i.price, i.item_attr_0 / 50.0 AS p
  FROM (SELECT DISTINCT user_idx, item_idx FROM slog) u JOIN sitems i USING (item_idx))"""


def _scored_pairs(spark, d):
    items = tables.star_items(spark, d).select("item_idx", "price", (F.col("item_attr_0") / 50.0).alias("p"))
    return sampling.distinct_edges(tables.star_log(spark, d)).join(items, "item_idx")


@query("score_price_prob", _ALL_PAIRS + f" SELECT user_idx, item_idx, {s6('price * p')} AS relevance FROM t")
def _(spark, d):
    from revrank.functions.scores import expected_revenue

    return _scored_pairs(spark, d).select(*PAIRS, q6(expected_revenue("p")).alias("relevance"))


@query("score_price_power", _ALL_PAIRS + f" SELECT user_idx, item_idx, {s6('p * pow(price, 0.8)')} AS relevance FROM t")
def _(spark, d):
    from revrank.functions.scores import score_price_power

    return _scored_pairs(spark, d).select(*PAIRS, q6(score_price_power("p")).alias("relevance"))


@query("score_sigmoid_price", _ALL_PAIRS + f" SELECT user_idx, item_idx, {s6('pow(price, 0.6) / (1 + exp(-p))')} AS relevance FROM t")
def _(spark, d):
    from revrank.functions.scores import score_sigmoid_price

    return _scored_pairs(spark, d).select(*PAIRS, q6(score_sigmoid_price("p", power=0.6)).alias("relevance"))


@query(
    "score_softmax_price",
    PAIR_SCORES
    + f""", m AS (SELECT user_idx, max(relevance) AS m FROM pairs GROUP BY 1),
    e AS (SELECT p.user_idx, item_idx, exp(relevance - m) AS x FROM pairs p JOIN m USING (user_idx)),
    s AS (SELECT user_idx, sum(x) AS s FROM e GROUP BY 1)
    SELECT e.user_idx, item_idx, {s6('x / s * price')} AS relevance FROM e JOIN s USING (user_idx) JOIN eitems USING (item_idx)""",
)
def _(spark, d):
    from revrank.registry.rows import pair_scores

    soft = scoring.softmax_by(pair_scores(spark, d), "user_idx", "relevance", "p")
    priced = soft.join(tables.event_items(spark, d), "item_idx")
    return priced.select(*PAIRS, q6(F.col("p") * F.col("price")).alias("relevance"))


def top_lists(spark, d, k=K):
    """Popularity lists learnt from the early iterations, for the metric queries."""
    train, _test = sampling.temporal_split(tables.star_log(spark, d), 3)
    model = PopularityRecommender().fit(train)
    return ranking.rank_filter(model.predict(train, k, tables.star_users(spark, d), tables.star_items(spark, d)), k)
