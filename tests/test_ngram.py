"""Hand-made counts, and both smoothed recommenders against a plain-Python brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from revrank.operators.ngram import backoff_probabilities, ngram_counts
from revrank.operators.sequences import current_context, user_sequences
from revrank.plans import ngram as plan
from revrank.plans.ngram import NGramRecommender


def test_counts_by_hand(mini):
    log, _, _ = mini
    got = {(tuple(r["ctx"]), r["item_idx"]): r["c"] for r in ngram_counts(log, 2, ["timestamp"]).collect()}
    # user 0: 0 1 0 2, user 1: 0 1 0
    assert got == {
        ((0,), 1): 2, ((1,), 0): 2, ((0,), 2): 1, ((0, 1), 0): 2, ((1, 0), 2): 1,
    }
    p = backoff_probabilities(ngram_counts(log, 2, ["timestamp"]))
    sums = p.groupBy("ctx").agg(F.sum("p").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-12 for r in sums)


def test_sequences_by_hand(mini):
    log, _, _ = mini
    assert dict(user_sequences(log, ["timestamp"]).collect()) == {0: [0, 1, 0, 2], 1: [0, 1, 0]}
    assert dict(current_context(log, 2, ["timestamp"]).collect()) == {0: [0, 2], 1: [1, 0]}


def test_price_order_for_all(mini):
    log, users, items = mini
    got = NGramRecommender().fit(log).predict(log, 2, users, items.fillna(1.0)).collect()
    assert {(r["user_idx"], r["item_idx"], r["rank"]) for r in got} == {
        (0, 3, 1), (1, 2, 1), (1, 3, 2), (2, 0, 1), (2, 1, 2)
    }


def brute(log, users, items, smoothing, order, k, top, floor):
    seqs, prices, vocab = defaultdict(list), {}, set()
    for u, i, t, p in sorted(log, key=lambda r: (r[2], r[1])):
        seqs[u].append(i)
        prices[i] = p
        vocab.add(i)
    counts = defaultdict(Counter)
    for s in seqs.values():
        s = s[-100:]
        for n in range(1, order + 1):
            for a in range(len(s) - n):
                counts[tuple(s[a : a + n])][s[a + n]] += 1
    out = {}
    seen = {(r[0], r[1]) for r in log}
    for u in users:
        ctx = tuple(seqs[u][-order:]) if seqs[u] else ()
        scored = []
        for i, own in items.items():
            if (u, i) in seen:
                continue
            if smoothing == "add-k":
                p = 1 / len(vocab)
                if ctx in counts and i in vocab:
                    p = (counts[ctx][i] + k) / (sum(counts[ctx].values()) + k * len(vocab))
            else:
                p = floor
                for n in range(len(ctx), 0, -1):
                    c = counts.get(ctx[-n:], {})
                    if i in c:
                        p = c[i] / sum(c.values())
                        break
            scored.append((-(prices.get(i, own) * p), i))
        out[u] = [(i, -s) for s, i in sorted(scored)[:top]]
    return out


@pytest.mark.parametrize("order,cheapest", [(1, 1), (2, 1), (3, 1), (1, -9), (2, -9)])
@pytest.mark.parametrize("smoothing,floor", [("add-k", 1e-6), ("back-off", 1e-6), ("back-off", 0.2)])
def test_recommender_equals_brute_force(spark, monkeypatch, smoothing, floor, order, cheapest):
    monkeypatch.setattr(plan, "BACKOFF_FLOOR", floor)
    rng = random.Random(order)
    log = [
        (rng.randint(0, 11), min(rng.randint(0, 14), rng.randint(0, 14)), t, rng.randint(cheapest, 9) + 0.5) for t in range(160)
    ]
    users = list(range(14))  # two without history
    items = {i: rng.randint(cheapest, 9) + 0.25 for i in range(20)}  # five outside the log
    df = spark.createDataFrame([(u, i, 1.0, t, p) for u, i, t, p in log],
                               "user_idx bigint, item_idx bigint, relevance double, timestamp bigint, price double")
    udf = spark.createDataFrame([(u,) for u in users], "user_idx bigint")
    idf = spark.createDataFrame(list(items.items()), "item_idx bigint, price double")
    model = NGramRecommender(order=order, smoothing=smoothing, k=0.01).fit(df)
    got = defaultdict(list)
    for r in model.predict(df, 6, udf, idf).orderBy("user_idx", "rank").collect():
        got[r["user_idx"]].append((r["item_idx"], r["relevance"]))
    want = brute(log, users, items, smoothing, order, 0.01, 6, floor)
    for u in users:
        assert [s for _, s in got[u]] == pytest.approx([s for _, s in want[u]])
        assert [i for i, _ in got[u]] == [i for i, _ in want[u]]
