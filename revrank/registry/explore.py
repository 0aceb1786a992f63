"""Aggregates that describe log, users and items."""

from __future__ import annotations

from pyspark.sql import functions as F

from revrank.operators import aggregates, ranking, sampling, sequences
from revrank.registry.base import q6, query, s6, text
from revrank.registry.rows import PAIR_SCORES, PAIRS, pair_scores
from revrank.sources import tables


@query("user_stats", f"SELECT user_idx, {s6('avg(price)')} AS user_price_mean, {s6('avg(relevance)')} AS user_ctr FROM slog GROUP BY 1")
def _(spark, d):
    out = aggregates.user_stats(tables.star_log(spark, d))
    return out.select("user_idx", q6("user_price_mean").alias("user_price_mean"), q6("user_ctr").alias("user_ctr"))


@query("item_stats", f"SELECT item_idx, {s6('avg(relevance)')} AS item_buy_rate, {s6('ln(1 + count(*))')} AS item_log_views FROM slog GROUP BY 1")
def _(spark, d):
    out = aggregates.item_stats(tables.star_log(spark, d))
    return out.select("item_idx", q6("item_buy_rate").alias("item_buy_rate"), q6("item_log_views").alias("item_log_views"))


@query("item_popularity", "SELECT item_idx, sum(relevance) AS score FROM slog GROUP BY 1")
def _(spark, d):
    return aggregates.item_popularity(tables.star_log(spark, d))


@query("category_share", f"SELECT category, count(*) AS n, {s6('count(*) * 100.0 / (SELECT count(*) FROM sitems)')} AS pct FROM sitems GROUP BY 1")
def _(spark, d):
    out = aggregates.category_share(tables.star_items(spark, d), "category")
    return out.select("category", "n", q6("pct").alias("pct"))


@query("segment_share", f"SELECT segment, count(*) AS n, {s6('count(*) * 100.0 / (SELECT count(*) FROM susers)')} AS pct FROM susers GROUP BY 1")
def _(spark, d):
    out = aggregates.category_share(tables.star_users(spark, d), "segment")
    return out.select("segment", "n", q6("pct").alias("pct"))


_N = "(SELECT count(*) FROM slog)"
_NU, _NI = "(SELECT count(*) FROM susers)", "(SELECT count(*) FROM sitems)"


@query("interaction_density", f"SELECT {_N} AS interactions, {_NU} AS users, {_NI} AS items, {s6(f'{_N} * 100.0 / (CAST({_NU} AS DOUBLE) * {_NI})')} AS density_pct")
def _(spark, d):
    out = aggregates.interaction_density(tables.star_log(spark, d), tables.star_users(spark, d), tables.star_items(spark, d))
    return out.withColumn("density_pct", q6("density_pct"))


@query(
    "coverage",
    f"""SELECT count(DISTINCT user_idx) AS active_users, count(DISTINCT item_idx) AS active_items,
    {s6(f'count(DISTINCT user_idx) * 100.0 / {_NU}')} AS user_pct, {s6(f'count(DISTINCT item_idx) * 100.0 / {_NI}')} AS item_pct FROM slog""",
)
def _(spark, d):
    out = aggregates.coverage(tables.star_log(spark, d), tables.star_users(spark, d), tables.star_items(spark, d))
    return out.withColumns({"user_pct": q6("user_pct"), "item_pct": q6("item_pct")})


def _hist_sql(source: str, col: str, bins: int) -> str:
    return f""", src AS ({source}), lim AS (SELECT min({col})::DOUBLE AS lo, max({col})::DOUBLE AS hi FROM src)
    SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor(({col} - lo) / ((hi - lo) / {bins})), {bins - 1}) END AS INTEGER) AS bin,
    count(*) AS n FROM src, lim WHERE {col} IS NOT NULL GROUP BY 1"""


@query("interactions_per_user", _hist_sql("SELECT user_idx, count(*) AS c FROM slog GROUP BY 1", "c", 20))
def _(spark, d):
    per = aggregates.interactions_per(tables.star_log(spark, d), "user_idx")
    return aggregates.histogram(per.withColumnRenamed("n", "c"), "c", 20)


@query("interactions_per_item", _hist_sql("SELECT item_idx, count(*) AS c FROM slog GROUP BY 1", "c", 20))
def _(spark, d):
    per = aggregates.interactions_per(tables.star_log(spark, d), "item_idx")
    return aggregates.histogram(per.withColumnRenamed("n", "c"), "c", 20)


@query("relevance_distribution", "SELECT relevance, count(*) AS n FROM slog GROUP BY 1")
def _(spark, d):
    return aggregates.relevance_distribution(tables.star_log(spark, d))


@query("histogram", _hist_sql("SELECT price FROM sitems", "price", 30))
def _(spark, d):
    return aggregates.histogram(tables.star_items(spark, d), "price", 30)


def _hist_by_sql(table: str, col: str, group: str, bins: int = 20) -> str:
    return f""", lim AS (SELECT {group}, min({col}) AS lo, max({col}) AS hi FROM {table} GROUP BY 1)
    SELECT {group}, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor(({col} - lo) / ((hi - lo) / {bins})), {bins - 1}) END AS INTEGER) AS bin,
    count(*) AS n FROM {table} JOIN lim USING ({group}) GROUP BY ALL"""


@query("histogram_by", _hist_by_sql("sitems", "price", "category"))
def _(spark, d):
    return aggregates.histogram_by(tables.star_items(spark, d), "price", "category")


_UA = " UNION ALL ".join(
    f"""SELECT '{c}' AS attribute, segment, CAST(least(floor(({c} - lo{n}) / ((hi{n} - lo{n}) / 20)), 19) AS INTEGER) AS bin, count(*) AS n
    FROM susers JOIN lim USING (segment) GROUP BY ALL"""
    for n, c in enumerate(["user_attr_0", "user_attr_1"])
)


@query(
    "attribute_histograms",
    f""", lim AS (SELECT segment, min(user_attr_0) AS lo0, max(user_attr_0) AS hi0, min(user_attr_1) AS lo1, max(user_attr_1) AS hi1
    FROM susers GROUP BY 1) {_UA}""",
)
def _(spark, d):
    return aggregates.attribute_histograms(tables.star_users(spark, d), "segment", "user_attr_")


CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "segment_category_pivot",
    "SELECT segment, "
    + ", ".join(f"count(*) FILTER (WHERE category = '{c}') AS {c}" for c in CATEGORIES)
    + " FROM slog JOIN susers USING (user_idx) JOIN sitems USING (item_idx) GROUP BY 1",
)
def _(spark, d):
    return aggregates.segment_category_pivot(
        tables.star_log(spark, d), tables.star_users(spark, d), tables.star_items(spark, d), CATEGORIES
    )


@query("correlation_matrix", f"SELECT 'user_attr_1' AS \"row\", 'user_attr_0' AS col, {s6('corr(user_attr_1, user_attr_0)')} AS corr FROM susers")
def _(spark, d):
    users = tables.star_users(spark, d)
    out = aggregates.correlation_matrix(users, ["user_attr_0", "user_attr_1"])
    return out.select("row", "col", q6("corr").alias("corr"))


@query("id_space", "SELECT max(user_idx) + 1 AS n_users, max(item_idx) + 1 AS n_items FROM slog")
def _(spark, d):
    return aggregates.id_space(tables.star_log(spark, d))


@query("distinct_edges", "SELECT DISTINCT user_idx, item_idx FROM slog")
def _(spark, d):
    return sampling.distinct_edges(tables.star_log(spark, d))


@query("query_group_sizes", "SELECT user_idx, count(*) AS group_size FROM slog GROUP BY 1")
def _(spark, d):
    return aggregates.query_group_sizes(tables.star_log(spark, d))


def _edge_price(direction: str) -> str:
    return f""", r AS (SELECT item_idx, price, row_number() OVER (PARTITION BY item_idx ORDER BY "timestamp" {direction}, event_id {direction}) AS n FROM elog)
    SELECT item_idx, price FROM r WHERE n = 1"""


@query("last_price_per_item", _edge_price("DESC"))
def _(spark, d):
    return aggregates.last_price_per_item(tables.event_log(spark, d), tables.EVENT_ORDER)


@query("first_price_per_item", _edge_price("ASC"))
def _(spark, d):
    return aggregates.first_price_per_item(tables.event_log(spark, d), tables.EVENT_ORDER)


@query("max_price", "SELECT max(price) AS max_price FROM slog")
def _(spark, d):
    return aggregates.max_price(tables.star_log(spark, d))


@query(
    "collect_ranked_lists",
    PAIR_SCORES
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM pairs)
    SELECT user_idx, array_to_string(list(relevance ORDER BY rank), ',') AS relevances FROM r WHERE rank <= 10 GROUP BY 1""",
)
def _(spark, d):
    out = aggregates.collect_ranked_lists(ranking.top_k(pair_scores(spark, d), 10), 10)
    return out.select("user_idx", text("relevances").alias("relevances"))


@query("global_mean_label", f"SELECT {s6('avg(CAST(relevance > 0 AS INTEGER))')} AS global_mean FROM slog")
def _(spark, d):
    return aggregates.global_mean_label(tables.star_log(spark, d)).select(q6("global_mean").alias("global_mean"))


@query("seen_items_by_user", "SELECT user_idx, item_idx FROM elog GROUP BY ALL")
def _(spark, d):
    return tables.event_log(spark, d).select(*PAIRS).distinct()
