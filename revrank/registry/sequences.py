"""Queries over time order: histories, sequences, n-grams."""

from __future__ import annotations

from pyspark.sql import functions as F

from revrank.functions import vectors
from revrank.operators import ngram, ranking, sampling, sequences
from revrank.registry.base import q6, query, s6, text
from revrank.registry.rows import PAIR_SCORES, PAIRS, SPLIT, pair_scores
from revrank.sources import tables

ORDER = tables.EVENT_ORDER
NEWEST = 'row_number() OVER (PARTITION BY user_idx ORDER BY "timestamp" DESC, event_id DESC)'
BY_TIME = 'PARTITION BY user_idx ORDER BY "timestamp", event_id'

_TOP = """, r AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM pairs)"""


@query("topk_row_number", PAIR_SCORES + _TOP + " SELECT * FROM r WHERE rank <= 10", ints=("rank",))
def _(spark, d):
    return ranking.top_k(pair_scores(spark, d), 10)


@query(
    "topk_cumcount",
    """, p AS (SELECT user_idx, item_idx, max(price) AS relevance FROM slog GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM p)
    SELECT * FROM r WHERE rank <= 5""",
    ints=("rank",),
)
def _(spark, d):
    best = tables.star_log(spark, d).groupBy(*PAIRS).agg(F.max("price").alias("relevance"))
    return ranking.top_k(best, 5)


@query("topk_head", PAIR_SCORES + _TOP + " SELECT user_idx, item_idx, relevance FROM r WHERE rank <= 4")
def _(spark, d):
    return ranking.top_k(pair_scores(spark, d), 4).drop("rank")


@query("partial_topk", PAIR_SCORES + _TOP + " SELECT user_idx, item_idx, relevance FROM r WHERE rank <= 7")
def _(spark, d):
    return ranking.top_k(pair_scores(spark, d), 7).drop("rank")


@query("sort_recs", PAIR_SCORES + _TOP + " SELECT * FROM r WHERE rank <= 10 ORDER BY user_idx, relevance DESC, item_idx", ints=("rank",))
def _(spark, d):
    return ranking.sort_recs(ranking.top_k(pair_scores(spark, d), 10))


@query("sort_log", 'SELECT user_idx, item_idx, event_id FROM elog ORDER BY user_idx, "timestamp", event_id')
def _(spark, d):
    return tables.event_log(spark, d).orderBy("user_idx", *ORDER).select(*PAIRS, "event_id")


@query("last_n_history", f", r AS (SELECT user_idx, item_idx, event_id, {NEWEST} AS recency FROM elog) SELECT * FROM r WHERE recency <= 50", ints=("recency",))
def _(spark, d):
    log = tables.event_log(spark, d)
    return sequences.last_n_history(log, 50, ORDER).select(*PAIRS, "event_id", "recency")


@query(
    "user_sequences",
    f""", r AS (SELECT *, {NEWEST} AS n FROM elog)
    SELECT user_idx, array_to_string(list(item_idx ORDER BY "timestamp", event_id), ',') AS items FROM r WHERE n <= 100 GROUP BY 1""",
)
def _(spark, d):
    return sequences.user_sequences(tables.event_log(spark, d), ORDER).select("user_idx", text("items").alias("items"))


# Each kept row with its one and two predecessors.
GRAMS = f""", kept AS (SELECT * FROM (SELECT *, {NEWEST} AS n FROM SRC) WHERE n <= 100),
 lagged AS (SELECT *, lag(item_idx, 1) OVER ({BY_TIME}) AS p1, lag(item_idx, 2) OVER ({BY_TIME}) AS p2 FROM kept),
 grams AS (SELECT user_idx, event_id, CAST(p1 AS VARCHAR) AS ctx, 1 AS n, item_idx FROM lagged WHERE p1 IS NOT NULL
   UNION ALL SELECT user_idx, event_id, p2 || ',' || p1, 2, item_idx FROM lagged WHERE p2 IS NOT NULL),
 counts AS (SELECT ctx, item_idx, count(*) AS c FROM grams GROUP BY ALL),
 totals AS (SELECT ctx, sum(c) AS total FROM counts GROUP BY 1),
 newest AS (SELECT user_idx, max(CASE WHEN n = 1 THEN item_idx END) AS c1, max(CASE WHEN n = 2 THEN item_idx END) AS c2 FROM kept WHERE n <= 2 GROUP BY 1)"""


def grams(source: str) -> str:
    return GRAMS.replace("SRC", source)


@query("ngram_windows", grams("elog") + " SELECT user_idx, event_id, ctx, item_idx FROM grams WHERE n = 2")
def _(spark, d):
    out = sequences.ngram_windows(tables.event_log(spark, d), 2, ORDER)
    return out.select("user_idx", "event_id", text("ctx").alias("ctx"), "item_idx")


@query("ngram_counts", grams("elog") + " SELECT ctx, item_idx, c FROM counts")
def _(spark, d):
    return ngram.ngram_counts(tables.event_log(spark, d), 2, ORDER).select(text("ctx").alias("ctx"), "item_idx", "c")


@query(
    "ngram_probs_backoff",
    grams("elog") + f" SELECT ctx, item_idx, {s6('c / total')} AS p FROM counts JOIN totals USING (ctx)",
)
def _(spark, d):
    probs = ngram.backoff_probabilities(ngram.ngram_counts(tables.event_log(spark, d), 2, ORDER))
    return probs.select(text("ctx").alias("ctx"), "item_idx", q6("p").alias("p"))


_V = "(SELECT count(DISTINCT item_idx) FROM elog)"


@query(
    "ngram_probs_addk",
    grams("elog")
    + f""" SELECT ctx, item_idx, {s6(f'(c + 0.001) / (total + 0.001 * {_V})')} AS p,
    {s6(f'0.001 / (total + 0.001 * {_V})')} AS p_default FROM counts JOIN totals USING (ctx)""",
)
def _(spark, d):
    from revrank.operators.aggregates import scalar

    log = tables.event_log(spark, d)
    size = scalar(log, F.count_distinct("item_idx"))
    probs = ngram.addk_probabilities(ngram.ngram_counts(log, 2, ORDER), 0.001, size)
    return probs.select(text("ctx").alias("ctx"), "item_idx", q6("p").alias("p"), q6("p_default").alias("p_default"))


@query(
    "lookup_ngram_prob",
    SPLIT
    + grams("etr")
    + f""", pr AS (SELECT ctx, item_idx, c / total AS p FROM counts JOIN totals USING (ctx))
    SELECT q.user_idx, q.item_idx, {s6('coalesce(b2.p, b1.p, 1e-6)')} AS p
    FROM (SELECT DISTINCT user_idx, item_idx FROM ete) q LEFT JOIN newest w USING (user_idx)
    LEFT JOIN pr b2 ON b2.ctx = w.c2 || ',' || w.c1 AND b2.item_idx = q.item_idx
    LEFT JOIN pr b1 ON b1.ctx = CAST(w.c1 AS VARCHAR) AND b1.item_idx = q.item_idx""",
)
def _(spark, d):
    train, test = sampling.temporal_split(tables.event_log(spark, d), 3)
    probs = ngram.backoff_probabilities(ngram.ngram_counts(train, 2, ORDER))
    contexts = sequences.current_context(train, 2, ORDER)
    out = ngram.lookup_ngram_prob(sampling.distinct_edges(test), contexts, probs, 2)
    return out.select(*PAIRS, q6("p").alias("p"))


@query(
    "prefix_target_samples",
    f""", r AS (SELECT user_idx, item_idx, event_id, list(item_idx) OVER ({BY_TIME} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS prefix FROM elog)
    SELECT user_idx, item_idx, event_id, array_to_string(prefix, ',') AS prefix FROM r WHERE len(prefix) > 0""",
)
def _(spark, d):
    out = sequences.prefix_target_samples(tables.event_log(spark, d), 10, ORDER)
    return out.select(*PAIRS, "event_id", text("prefix").alias("prefix"))


@query(
    "fresh_samples_only",
    f""", kept AS (SELECT * FROM (SELECT *, {NEWEST} AS n FROM elog) WHERE n <= 150),
    r AS (SELECT user_idx, item_idx, event_id, "__iter", list(item_idx) OVER ({BY_TIME} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS prefix FROM kept)
    SELECT user_idx, item_idx, event_id, array_to_string(prefix, ',') AS prefix FROM r WHERE len(prefix) > 0 AND "__iter" > 3""",
)
def _(spark, d):
    train, test = sampling.temporal_split(tables.event_log(spark, d), 3)
    out = sequences.fresh_samples_only(train, test, 10, 150, ORDER)
    return out.select(*PAIRS, "event_id", text("prefix").alias("prefix"))


@query("current_context", grams("elog") + " SELECT user_idx, concat_ws(',', c2, c1) AS ctx FROM newest")
def _(spark, d):
    return sequences.current_context(tables.event_log(spark, d), 2, ORDER).select("user_idx", text("ctx").alias("ctx"))


_VOCAB = """, f AS (SELECT item_idx, min(("timestamp", event_id)) AS f FROM elog GROUP BY 1),
 vocab AS (SELECT item_idx, row_number() OVER (ORDER BY f) AS "index" FROM f)"""


@query("vocabulary", _VOCAB + ' SELECT item_idx, "index" FROM vocab')
def _(spark, d):
    return sequences.vocabulary(tables.event_log(spark, d), ORDER)


_PAD = f""", r AS (SELECT *, {NEWEST} AS n FROM elog),
 s AS (SELECT user_idx, list(item_idx ORDER BY "timestamp", event_id) AS items FROM r WHERE n <= 60 GROUP BY 1),
 p AS (SELECT user_idx, items, list_transform(range(0, greatest(0, 75 - len(items))), lambda x: CAST(-1 AS BIGINT)) AS pad FROM s)"""


@query("left_pad", _PAD + " SELECT user_idx, array_to_string(list_concat(pad, items), ',') AS items FROM p")
def _(spark, d):
    seqs = sequences.user_sequences(tables.event_log(spark, d), ORDER, 60)
    return seqs.select("user_idx", text(vectors.left_pad("items", 75, -1)).alias("items"))


@query("right_pad", _PAD + " SELECT user_idx, array_to_string(list_concat(items, pad), ',') AS items FROM p")
def _(spark, d):
    seqs = sequences.user_sequences(tables.event_log(spark, d), ORDER, 60)
    return seqs.select("user_idx", text(vectors.right_pad("items", 75, -1)).alias("items"))
