"""Row-level queries: loading, schema repair, filters, joins, scalar expressions, unions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from revrank.functions import scores, vectors
from revrank.operators import aggregates, evaluate, joins, ranking, sampling, sequences
from revrank.registry.base import q6, query, s6, text
from revrank.session import ensure_checkpoint_dir
from revrank.sources import schema, tables

PAIRS = ["user_idx", "item_idx"]


def pair_scores(spark, d):
    """(user, item) pairs of the click log with their number of rows."""
    return tables.event_log(spark, d).groupBy(*PAIRS).agg(F.count("*").alias("relevance"))


PAIR_SCORES = ", pairs AS (SELECT user_idx, item_idx, count(*) AS relevance FROM elog GROUP BY ALL)"


@query("load_log", 'SELECT user_idx, item_idx, relevance, "timestamp", price, "__iter" FROM slog')
def _(spark, d):
    return tables.star_log(spark, d).select(*tables.LOG_COLUMNS)


@query("load_users", "SELECT * FROM susers")
def _(spark, d):
    return tables.star_users(spark, d)


@query("load_items", "SELECT * FROM sitems")
def _(spark, d):
    return tables.star_items(spark, d)


@query("load_event_log", "SELECT * FROM elog")
def _(spark, d):
    return tables.event_log(spark, d)


@query(
    "with_default_columns",
    'SELECT user_idx, item_idx, relevance, CAST(0 AS INTEGER) AS "timestamp", CAST(1.0 AS DOUBLE) AS price FROM slog',
)
def _(spark, d):
    return schema.with_default_columns(tables.star_log(spark, d).select(*PAIRS, "relevance"))


@query(
    "price_from_items",
    "SELECT l.user_idx, l.item_idx, l.relevance, coalesce(i.price, 1.0) AS price FROM slog l LEFT JOIN sitems i USING (item_idx)",
)
def _(spark, d):
    log = tables.star_log(spark, d).select(*PAIRS, "relevance")
    return schema.price_from_items(log, tables.star_items(spark, d))


@query(
    "assign_arrival_timestamp",
    'SELECT user_idx, item_idx, event_id, row_number() OVER (ORDER BY "timestamp", event_id) - 1 AS "timestamp" FROM elog',
)
def _(spark, d):
    log = tables.event_log(spark, d).select(*PAIRS, "event_id", F.col("timestamp").alias("seen_at"))
    return schema.assign_arrival_timestamp(log, ["seen_at", "event_id"]).drop("seen_at")


@query("rename_ids", "SELECT user_idx AS user_id, item_idx AS item_id, relevance FROM slog")
def _(spark, d):
    return schema.rename_ids(tables.star_log(spark, d).select(*PAIRS, "relevance"))


@query("drop_technical_columns", 'SELECT relevance, "timestamp", price FROM slog')
def _(spark, d):
    return schema.drop_technical_columns(tables.star_log(spark, d).select(*tables.LOG_COLUMNS))


@query(
    "write_recommendations",
    PAIR_SCORES
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM pairs)
    SELECT user_idx, item_idx, CAST(relevance AS FLOAT) AS relevance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""",
)
def _(spark, d):
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/recs-{uuid.uuid4().hex}"
    schema.write_recommendations(ranking.top_k(pair_scores(spark, d), 10), path)
    return spark.read.parquet(path)


@query("select_log", "SELECT user_idx, item_idx, relevance FROM slog")
def _(spark, d):
    return tables.star_log(spark, d).select(*PAIRS, "relevance")


@query(
    "binary_label",
    "SELECT user_idx, item_idx, CAST(relevance > 0 AS INTEGER) AS label FROM slog",
)
def _(spark, d):
    return tables.star_log(spark, d).select(*PAIRS, scores.binary_label().alias("label"))


WIDE_LOG = """, wide AS (SELECT l.user_idx, l.item_idx, relevance, l.price, segment, user_attr_0, user_attr_1,
    category, item_attr_0, brand, name FROM slog l JOIN susers USING (user_idx) JOIN sitems i USING (item_idx))"""


def wide_sides(spark, d):
    log = tables.star_log(spark, d).select(*PAIRS, "relevance", "price")
    return log, tables.star_users(spark, d), tables.star_items(spark, d).drop("price")


def wide_log(spark, d):
    return joins.enrich_interactions(*wide_sides(spark, d))


_NUMERIC = ["user_idx", "item_idx", "relevance", "price", "user_attr_0", "user_attr_1", "item_attr_0"]
_TEXT = ["segment", "category", "brand", "name"]


def _distinct_sql(columns, cond):
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\" FROM wide" for c in columns
    )
    return WIDE_LOG + f' SELECT * FROM ({parts}) WHERE "distinct" {cond}'


@query("numeric_columns", _distinct_sql(_NUMERIC, "> 10"))
def _(spark, d):
    return aggregates.joined_numeric_columns(*wide_sides(spark, d))


@query("high_cardinality", _distinct_sql(_TEXT, ">= 30"))
def _(spark, d):
    return aggregates.joined_high_cardinality(*wide_sides(spark, d))


@query("restrict_ids", "SELECT user_idx, item_idx, relevance FROM slog WHERE item_idx < (SELECT max(item_idx) // 2 FROM slog)")
def _(spark, d):
    log = tables.star_log(spark, d).select(*PAIRS, "relevance")
    half = log.agg(F.max("item_idx")).first()[0] // 2
    return joins.restrict_ids(log, "item_idx", half)


@query(
    "filter_users_isin",
    "SELECT user_idx, item_idx FROM slog WHERE user_idx IN (SELECT user_idx FROM susers WHERE segment = 'BUILDING')",
)
def _(spark, d):
    asked = tables.star_users(spark, d).filter(F.col("segment") == "BUILDING")
    return joins.filter_users_isin(tables.star_log(spark, d).select(*PAIRS), asked)


@query(
    "rank_filter",
    PAIR_SCORES
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx) AS rank FROM pairs)
    SELECT * FROM r WHERE rank <= 3""",
    ints=("rank",),
)
def _(spark, d):
    return ranking.rank_filter(ranking.top_k(pair_scores(spark, d), 10), 3)


@query(
    "enrich_interactions",
    """SELECT user_idx, item_idx, relevance, segment, user_attr_0, user_attr_1, category, i.price, item_attr_0
    FROM slog l JOIN susers USING (user_idx) JOIN sitems i USING (item_idx)""",
)
def _(spark, d):
    log = tables.star_log(spark, d).select(*PAIRS, "relevance", "price")
    items = tables.star_items(spark, d).drop("brand", "name")
    return joins.enrich_interactions(log, tables.star_users(spark, d), items)


@query(
    "candidate_pairs",
    """, r AS (SELECT u.user_idx, i.item_idx, i.price, row_number() OVER (PARTITION BY u.user_idx ORDER BY i.price DESC, i.item_idx) AS rank
      FROM susers u CROSS JOIN sitems i
      WHERE NOT EXISTS (SELECT 1 FROM slog s WHERE s.user_idx = u.user_idx AND s.item_idx = i.item_idx))
    SELECT user_idx, item_idx, price, rank FROM r WHERE rank <= 20""",
    ints=("rank",),
)
def _(spark, d):
    users = tables.star_users(spark, d).select("user_idx")
    items = tables.star_items(spark, d).select("item_idx", "price")
    return ranking.candidate_pairs(
        users, items, tables.star_log(spark, d), 20, [F.col("price").desc(), "item_idx"]
    )


SPLIT = """, tr AS (SELECT * FROM slog WHERE "__iter" <= 3), te AS (SELECT * FROM slog WHERE "__iter" > 3),
 etr AS (SELECT * FROM elog WHERE "__iter" <= 3), ete AS (SELECT * FROM elog WHERE "__iter" > 3)"""


@query(
    "exclude_seen",
    SPLIT + " SELECT DISTINCT user_idx, item_idx FROM te WHERE (user_idx, item_idx) NOT IN (SELECT (user_idx, item_idx) FROM tr)",
)
def _(spark, d):
    train, test = sampling.temporal_split(tables.star_log(spark, d), 3)
    return joins.exclude_seen(sampling.distinct_edges(test), train)


@query(
    "exclude_history",
    SPLIT
    + """, h AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY "timestamp" DESC, event_id DESC) AS n FROM etr)
    SELECT DISTINCT user_idx, item_idx FROM ete WHERE (user_idx, item_idx) NOT IN (SELECT (user_idx, item_idx) FROM h WHERE n <= 30)""",
)
def _(spark, d):
    train, test = sampling.temporal_split(tables.event_log(spark, d), 3)
    stored = sequences.last_n_history(train, 30, tables.EVENT_ORDER)
    return joins.exclude_seen(sampling.distinct_edges(test), stored)


@query(
    "attach_stats",
    SPLIT
    + f""", us AS (SELECT user_idx, avg(price) AS m, avg(relevance) AS c FROM tr GROUP BY 1),
    its AS (SELECT item_idx, avg(relevance) AS b, ln(1 + count(*)) AS v FROM tr GROUP BY 1)
    SELECT p.user_idx, p.item_idx, {s6('coalesce(m, 0)')} AS user_price_mean, {s6('coalesce(c, 0)')} AS user_ctr,
      {s6('coalesce(b, 0)')} AS item_buy_rate, {s6('coalesce(v, 0)')} AS item_log_views
    FROM (SELECT DISTINCT user_idx, item_idx FROM te) p LEFT JOIN us USING (user_idx) LEFT JOIN its USING (item_idx)""",
)
def _(spark, d):
    train, test = sampling.temporal_split(tables.star_log(spark, d), 3)
    out = joins.attach_stats(
        sampling.distinct_edges(test), aggregates.user_stats(train), aggregates.item_stats(train)
    )
    return out.select(*PAIRS, *[q6(c).alias(c) for c in out.columns if c not in PAIRS])


@query(
    "lookup_price",
    """ SELECT p.user_idx, p.item_idx, coalesce(i.price, 1.0) AS price FROM (SELECT DISTINCT user_idx, item_idx FROM slog) p
    LEFT JOIN (SELECT * FROM sitems WHERE category <> 'ECONOMY') i USING (item_idx)""",
)
def _(spark, d):
    priced = tables.star_items(spark, d).filter(F.col("category") != "ECONOMY")
    return schema.lookup_price(sampling.distinct_edges(tables.star_log(spark, d)), priced)


# --- scalar expressions -------------------------------------------------------------

@query("price_transforms", f"SELECT item_idx, {s6('ln(1 + price)')} AS price_log, {s6('sqrt(price)')} AS price_sqrt FROM sitems")
def _(spark, d):
    return tables.star_items(spark, d).select(
        "item_idx", q6(scores.price_log()).alias("price_log"), q6(scores.price_sqrt()).alias("price_sqrt")
    )


@query("price_power", f"SELECT item_idx, {s6('pow(price, 1.4)')} AS w, {s6('pow(price, 0.8)')} AS a FROM sitems")
def _(spark, d):
    return tables.star_items(spark, d).select(
        "item_idx", q6(scores.price_power("price", 1.4)).alias("w"), q6(scores.price_power("price", 0.8)).alias("a")
    )


@query(
    "relative_log_price",
    f""", m AS (SELECT avg(ln(1 + price)) AS m FROM sitems)
    SELECT item_idx, price, {s6('ln(1 + price) / m')} AS rel_price, {s6('sqrt(ln(1 + price) / m)')} AS loss_weight FROM sitems, m""",
)
def _(spark, d):
    out = evaluate.relative_log_price(tables.star_items(spark, d))
    return out.select("item_idx", "price", q6("rel_price").alias("rel_price"), q6("loss_weight").alias("loss_weight"))


_GAPS = "CASE WHEN item_idx % 7 = 0 THEN NULL ELSE price END"


@query(
    "fill_missing_price",
    f""", g AS (SELECT item_idx, {_GAPS} AS price FROM sitems)
    SELECT item_idx, {s6('coalesce(price, (SELECT avg(price) FROM g))')} AS price FROM g""",
)
def _(spark, d):
    gaps = tables.star_items(spark, d).select("item_idx", F.expr(_GAPS).alias("price"))
    return evaluate.fill_missing_price(gaps).select("item_idx", q6("price").alias("price"))


@query(
    "nan_to_zero",
    """SELECT item_idx, CASE WHEN item_idx % 7 = 0 THEN 0.0 WHEN item_idx % 7 = 1 THEN 0.0 ELSE price END AS price FROM sitems""",
)
def _(spark, d):
    dirty = F.expr("CASE WHEN item_idx % 7 = 0 THEN NULL WHEN item_idx % 7 = 1 THEN double('NaN') ELSE price END")
    return tables.star_items(spark, d).select("item_idx", scores.nan_to_zero(dirty).alias("price"))


_X = "(price - 1000.0) / 50.0"


@query("sigmoid", f"SELECT item_idx, {s6(f'1 / (1 + exp(-({_X})))')} AS y FROM sitems")
def _(spark, d):
    return tables.star_items(spark, d).select("item_idx", q6(scores.sigmoid((F.col("price") - 1000.0) / 50.0)).alias("y"))


@query("log_sigmoid", f"SELECT item_idx, {s6(f'-ln(1 + exp(-({_X})))')} AS y FROM sitems")
def _(spark, d):
    x = (F.col("price") - 1000.0) / 50.0
    return tables.star_items(spark, d).select("item_idx", q6(scores.log_sigmoid(x)).alias("y"))


@query(
    "softmax",
    PAIR_SCORES
    + f""", m AS (SELECT user_idx, max(relevance) AS m FROM pairs GROUP BY 1),
    e AS (SELECT p.user_idx, item_idx, exp(relevance - m) AS x FROM pairs p JOIN m USING (user_idx)),
    s AS (SELECT user_idx, sum(x) AS s FROM e GROUP BY 1)
    SELECT e.user_idx, item_idx, {s6('x / s')} AS p FROM e JOIN s USING (user_idx)""",
)
def _(spark, d):
    from revrank.operators.scoring import softmax_by

    return softmax_by(pair_scores(spark, d), "user_idx", "relevance", "p").select(*PAIRS, q6("p").alias("p"))


_P = "(item_attr_0 / 50.0)"
_TRIG = f"(sin({_P}) + 1) * exp({_P} - 1) * ln(1 + price) * cos(price / 100) * (1 + tan({_P} * pi() / 4))"


@query("trig_revenue", f"SELECT item_idx, {s6(_TRIG)} AS relevance FROM sitems")
def _(spark, d):
    prob = F.col("item_attr_0") / 50.0
    return tables.star_items(spark, d).select("item_idx", q6(scores.trig_revenue(prob)).alias("relevance"))


@query("expected_revenue", f"SELECT item_idx, {s6(f'price * {_P}')} AS relevance FROM sitems")
def _(spark, d):
    prob = F.col("item_attr_0") / 50.0
    return tables.star_items(spark, d).select("item_idx", q6(scores.expected_revenue(prob)).alias("relevance"))


_SEQ = """, r AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY "timestamp" DESC, event_id DESC) AS n FROM elog),
 seqs AS (SELECT user_idx, list(item_idx ORDER BY "timestamp", event_id) AS items FROM r WHERE n <= 12 GROUP BY 1)"""


def _seqs(spark, d):
    return sequences.user_sequences(tables.event_log(spark, d), tables.EVENT_ORDER, 12)


@query("array_slice", _SEQ + " SELECT user_idx, array_to_string(items[3:7], ',') AS part FROM seqs")
def _(spark, d):
    return _seqs(spark, d).select("user_idx", text(F.slice("items", 3, 5)).alias("part"))


@query("array_append", _SEQ + " SELECT user_idx, array_to_string(list_append(items, user_idx), ',') AS longer FROM seqs")
def _(spark, d):
    return _seqs(spark, d).select("user_idx", text(F.array_append("items", F.col("user_idx"))).alias("longer"))


@query("array_gather", _SEQ + " SELECT user_idx, items[1] AS oldest, items[len(items)] AS newest FROM seqs")
def _(spark, d):
    return _seqs(spark, d).select(
        "user_idx", F.element_at("items", 1).alias("oldest"), F.element_at("items", -1).alias("newest")
    )


@query(
    "array_dot",
    f"SELECT vec_id, {s6('list_dot_product(CAST(embedding AS DOUBLE[]), CAST(list_reverse(embedding) AS DOUBLE[]))')} AS dot FROM embeddings",
)
def _(spark, d):
    vec = F.col("embedding").cast("array<double>")
    rows = spark.read.parquet(f"{d}/embeddings.parquet")
    return rows.select("vec_id", q6(vectors.dot(vec, F.reverse(vec))).alias("dot"))


@query(
    "l2_normalize",
    f"""SELECT vec_id, {s6('embedding[1] / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))')} AS first,
    {s6('embedding[64] / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))')} AS last FROM embeddings""",
)
def _(spark, d):
    unit = vectors.l2_normalize(F.col("embedding").cast("array<double>"))
    rows = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", unit.alias("v"))
    return rows.select("vec_id", q6(F.element_at("v", 1)).alias("first"), q6(F.element_at("v", -1)).alias("last"))


# --- unions -----------------------------------------------------------------------------

@query("append_log", SPLIT + " SELECT user_idx, item_idx, event_id FROM etr UNION ALL SELECT user_idx, item_idx, event_id FROM ete")
def _(spark, d):
    train, test = sampling.temporal_split(tables.event_log(spark, d), 3)
    return sequences.append_log(train, test).select(*PAIRS, "event_id")


@query("temporal_split", """SELECT user_idx, item_idx, "__iter", CASE WHEN "__iter" <= 3 THEN 'train' ELSE 'test' END AS phase FROM slog""")
def _(spark, d):
    train, test = sampling.temporal_split(tables.star_log(spark, d).select(*PAIRS, "__iter"), 3)
    return train.withColumn("phase", F.lit("train")).unionByName(test.withColumn("phase", F.lit("test")))
