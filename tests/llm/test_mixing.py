import re
from collections import defaultdict

from pyspark.sql import functions as F

from revrank.llm.common import running_totals
from revrank.llm.mixing import mix_sources, mixed_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, cap=3, weights=(1, 2, 3)):
    """Fill the sources step by step, the excess shared again among the open ones."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        free = sum(w[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and left * w[s] / free > cap * sizes[s]} if free else set()
        if not over:
            return {s: cap * sizes[s] if s in capped else left * w[s] / free for s in names}
        capped |= over


def test_targets_sums_and_sizes(docs, corpus):
    rows = mix_sources(docs).collect()
    assert len(rows) == len(corpus)
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in rows}
    by_source = defaultdict(int)
    for r in rows:
        assert r["size"] == size[r["doc_id"]]
        by_source[r["source"]] += r["size"]
    want = targets(by_source)
    took = defaultdict(int)
    for r in rows:
        assert r["source_size"] == by_source[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        took[r["source"]] += r["taken"]
    assert all(abs(took[s] - want[s]) <= 0.5 for s in want)


def test_reruns_and_bucket_sizes_agree(docs):
    def taken(df, **more):
        return {r["doc_id"]: r["taken"] for r in mix_sources(df, **more).collect()}

    first = taken(docs)
    assert taken(docs.repartition(3, "text")) == first
    assert taken(docs, rows_per_bucket=2) != {} and sum(taken(docs, rows_per_bucket=2).values()) == sum(first.values())
    assert taken(docs, seed="other") != first


def test_running_totals_by_levels(spark):
    sums = spark.range(50).selectExpr("id % 2 AS k", "id AS i", "id * id AS v")
    rows = running_totals(sums, ["k"], "i", "v", fan=3).collect()
    assert len(rows) == 50
    for r in rows:
        assert r["before"] == sum(j * j for j in range(r["i"]) if j % 2 == r["k"])


def test_rows_of_the_mix(docs, corpus):
    text = {r[0]: r[1] for r in corpus}
    took = {r["doc_id"]: r["taken"] for r in mix_sources(docs).collect()}
    rows = mixed_documents(docs).collect()
    words = defaultdict(int)
    for r in rows:
        assert text[r["doc_id"]].startswith(r["text"])
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert dict(words) == {d: t for d, t in took.items() if t}


def test_odd_rows(odd_docs, docs):
    rows = mix_sources(odd_docs).collect()
    assert len(rows) == 7 and all(r["taken"] is not None for r in rows)
    assert sum(r["taken"] for r in rows) == sum(r["size"] for r in rows)
    assert mix_sources(docs.limit(0)).count() == 0
    assert mixed_documents(odd_docs).columns == odd_docs.columns
    empty_texts = docs.withColumn("text", F.lit(None).cast("string"))
    assert mix_sources(empty_texts).agg(F.sum("taken")).first()[0] == 0
