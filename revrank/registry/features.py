"""Feature engineering, sampling and splitting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from revrank.functions.hashing import draw
from revrank.operators import features, sampling
from revrank.operators.evaluate import roc_auc
from revrank.registry.base import draw_sql, md5_sql, q6, query, s6
from revrank.registry.explore import CATEGORIES
from revrank.registry.rows import PAIRS, SPLIT
from revrank.sources import tables

SEED = 42


@query(
    "one_hot",
    "SELECT item_idx, " + ", ".join(f"CAST(category = '{c}' AS INTEGER) AS category_{c}" for c in CATEGORIES[:-1]) + " FROM sitems",
)
def _(spark, d):
    items = tables.star_items(spark, d).select("item_idx", "category")
    return features.one_hot(items, {"category": CATEGORIES[:-1]})


@query("align_columns", "SELECT price, CAST(0 AS INTEGER) AS category_OTHER, item_idx, CAST(category = 'PROMO' AS INTEGER) AS category_PROMO FROM sitems")
def _(spark, d):
    hot = features.one_hot(tables.star_items(spark, d), {"category": ["PROMO", "SMALL"]})
    return features.align_columns(hot, ["price", "category_OTHER", "item_idx", "category_PROMO"])


@query(
    "standardize",
    f""", m AS (SELECT avg(price) AS mp, stddev_pop(price) AS sp, avg(item_attr_0) AS ma, stddev_pop(item_attr_0) AS sa FROM sitems)
    SELECT item_idx, {s6('(price - mp) / sp')} AS price, {s6('(item_attr_0 - ma) / sa')} AS item_attr_0 FROM sitems, m""",
)
def _(spark, d):
    out = features.standardize(tables.star_items(spark, d), ["price", "item_attr_0"])
    return out.select("item_idx", q6("price").alias("price"), q6("item_attr_0").alias("item_attr_0"))


@query(
    "target_encode",
    f""", w AS (SELECT l.user_idx, l.item_idx, name, relevance FROM slog l JOIN sitems USING (item_idx)),
    t AS (SELECT name, (avg(relevance) * count(*) + 10 * (SELECT avg(relevance) FROM w)) / (count(*) + 10) AS te FROM w GROUP BY 1)
    SELECT user_idx, item_idx, {s6('te')} AS name_te FROM w JOIN t USING (name)""",
)
def _(spark, d):
    items = tables.star_items(spark, d).select("item_idx", "name")
    rows = tables.star_log(spark, d).select(*PAIRS, "relevance").join(items, "item_idx")
    encoding = features.target_encoding(rows, "name", F.col("relevance"))
    return features.apply_encoding(rows, encoding, "name", 0.0).select(*PAIRS, q6("name_te").alias("name_te"))


@query(
    "target_encode_out_of_fold",
    f""", w AS (SELECT l.user_idx, l.item_idx, name, relevance, CAST({draw_sql('l.user_idx', 'l.item_idx', '42')} % 5 AS INTEGER) AS fold FROM slog l JOIN sitems USING (item_idx)),
    f AS (SELECT name, fold, sum(relevance) AS fs, count(*) AS fn FROM w GROUP BY ALL),
    a AS (SELECT name, sum(fs) AS s, sum(fn) AS n FROM f GROUP BY 1),
    g AS (SELECT fold, sum(relevance) AS gs, count(*) AS gn FROM w GROUP BY 1),
    t AS (SELECT f.name, f.fold, (s - fs + 10 * (((SELECT sum(gs) FROM g) - gs) / ((SELECT sum(gn) FROM g) - gn))) / (n - fn + 10) AS te
      FROM f JOIN a USING (name) JOIN g USING (fold))
    SELECT user_idx, item_idx, {s6('te')} AS name_te FROM w JOIN t USING (name, fold)""",
)
def _(spark, d):
    items = tables.star_items(spark, d).select("item_idx", "name")
    rows = tables.star_log(spark, d).select(*PAIRS, "relevance").join(items, "item_idx")
    rows = rows.withColumn("fold", (draw(*PAIRS, F.lit(SEED)) % 5).cast("int"))
    out = features.out_of_fold_encoding(rows, "name", "relevance", "fold")
    return out.select(*PAIRS, q6("name_te").alias("name_te"))


_RANK = f"row_number() OVER (PARTITION BY label ORDER BY {md5_sql('event_id', '42')})"
_LAB = ", lab AS (SELECT event_id, user_idx, item_idx, CAST(relevance > 0 AS INTEGER) AS label FROM elog)"


def labelled(spark, d):
    return tables.event_log(spark, d).select("event_id", *PAIRS, (F.col("relevance") > 0).cast("int").alias("label"))


@query(
    "undersample_negatives",
    _LAB + f""", r AS (SELECT *, {_RANK} AS rn FROM lab)
    SELECT event_id, user_idx, item_idx, label FROM r WHERE label = 1 OR rn <= (SELECT sum(label) FROM lab)""",
)
def _(spark, d):
    return features.undersample_negatives(labelled(spark, d), "label", ["event_id"], SEED)


@query(
    "union_pos_neg",
    _LAB + " SELECT event_id, label FROM lab",
)
def _(spark, d):
    rows = labelled(spark, d).select("event_id", "label")
    return features.union_pos_neg(rows.filter("label = 1"), rows.filter("label = 0"))


@query("class_weights", _LAB + f" SELECT label, {s6('(SELECT count(*) FROM lab) / (2.0 * count(*))')} AS weight FROM lab GROUP BY 1")
def _(spark, d):
    out = features.class_weights(labelled(spark, d))
    return out.select("label", q6("weight").alias("weight"))


@query("price_weights", f"SELECT user_idx, item_idx, {s6('pow(price, 1.3)')} AS weight FROM slog")
def _(spark, d):
    from revrank.functions.scores import price_power

    return tables.star_log(spark, d).select(*PAIRS, q6(price_power("price", 1.3)).alias("weight"))


@query("stratified_folds", _LAB + f" SELECT event_id, label, CAST(({_RANK} - 1) % 5 AS INTEGER) AS fold FROM lab")
def _(spark, d):
    return features.stratified_folds(labelled(spark, d), "label", ["event_id"], 5, SEED).select("event_id", "label", "fold")


_EDGES = ", edges AS (SELECT DISTINCT user_idx, item_idx FROM elog)"
_TENTH, _HALF = int(0.1 * (1 << 32)), int(0.5 * (1 << 32))


@query("holdout_split", _EDGES + f" SELECT user_idx, item_idx, {draw_sql('user_idx', 'item_idx', '42')} < {_TENTH} AS is_val FROM edges")
def _(spark, d):
    return sampling.holdout_split(sampling.distinct_edges(tables.event_log(spark, d)), 0.1, SEED)


@query("negative_sample_uniform", _EDGES + f" SELECT user_idx, item_idx, {draw_sql('user_idx', 'item_idx', '3', '42')} % (SELECT max(item_idx) + 1 FROM elog) AS neg_idx FROM edges")
def _(spark, d):
    log = tables.event_log(spark, d)
    n_items = log.agg(F.max("item_idx")).first()[0] + 1
    return sampling.negative_sample_uniform(sampling.distinct_edges(log), n_items, epoch=3, seed=SEED)


_SLOTS = ", slots AS (SELECT item_idx, row_number() OVER (ORDER BY item_idx) - 1 AS slot FROM (SELECT DISTINCT item_idx FROM eitems)), seen AS (SELECT user_idx, slot FROM edges JOIN slots USING (item_idx))"


def _unseen_sql(source: str, key: str, parts: tuple[str, ...]) -> str:
    return f""", src AS ({source}),
    tried AS (SELECT src.*, t.t, {draw_sql(*parts, 't.t', '42')} % (SELECT count(*) FROM slots) AS slot FROM src, range(0, 4) t(t)),
    alive AS (SELECT * FROM tried WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.user_idx = tried.user_idx AND seen.slot = tried.slot)),
    drawn AS (SELECT {key}, arg_min(slot, t) AS slot FROM alive GROUP BY ALL),
    free AS (SELECT u.user_idx, min(s.slot) AS free FROM eusers u, slots s
      WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.user_idx = u.user_idx AND seen.slot = s.slot) GROUP BY 1),
    done AS (SELECT src.*, coalesce(drawn.slot, free.free) AS slot FROM src LEFT JOIN drawn USING ({key}) LEFT JOIN free USING (user_idx))"""


@query(
    "negative_sample_unseen",
    _EDGES + _SLOTS + _unseen_sql("SELECT event_id, user_idx, item_idx FROM elog", "event_id", ("event_id",))
    + " SELECT event_id, user_idx, done.item_idx, slots.item_idx AS neg_idx FROM done JOIN slots USING (slot)",
)
def _(spark, d):
    log = tables.event_log(spark, d).select("event_id", *PAIRS)
    slots = sampling.numbered_items(tables.event_items(spark, d))
    return sampling.negative_sample_unseen(log, ["event_id"], log, slots, 4, SEED)


@query(
    "negative_sample_bipartite",
    _EDGES + _SLOTS + _unseen_sql("SELECT user_idx, item_idx FROM edges", "user_idx, item_idx", ("user_idx", "item_idx"))
    + " SELECT user_idx, slots.item_idx FROM done JOIN slots USING (slot)",
)
def _(spark, d):
    slots = sampling.numbered_items(tables.event_items(spark, d))
    return sampling.negative_sample_bipartite(sampling.distinct_edges(tables.event_log(spark, d)), slots, 4, SEED)


@query("edge_dropout", _EDGES + f" SELECT * FROM edges WHERE NOT {draw_sql('user_idx', 'item_idx', '2', '42')} < {_HALF}")
def _(spark, d):
    return sampling.edge_dropout(sampling.distinct_edges(tables.event_log(spark, d)), 0.5, epoch=2, seed=SEED)


@query(
    "roc_auc",
    SPLIT
    + f""", p AS (SELECT item_idx, avg(relevance) AS score FROM tr GROUP BY 1),
    s AS (SELECT coalesce(score, 0) AS score, CAST(relevance > 0 AS INTEGER) AS label FROM te LEFT JOIN p USING (item_idx)),
    g AS (SELECT score, sum(label) AS p, count(*) - sum(label) AS n FROM s GROUP BY 1),
    c AS (SELECT *, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
    SELECT {s6('sum(p * (below + n / 2.0)) / (sum(p) * sum(n))')} AS auc FROM c""",
)
def _(spark, d):
    from revrank.operators.aggregates import item_stats

    train, test = sampling.temporal_split(tables.star_log(spark, d), 3)
    rates = item_stats(train).select("item_idx", F.col("item_buy_rate").alias("score"))
    scored = test.join(rates, "item_idx", "left").select(
        F.coalesce("score", F.lit(0.0)).alias("score"), (F.col("relevance") > 0).cast("int").alias("label")
    )
    return roc_auc(scored).select(q6("auc").alias("auc"))
