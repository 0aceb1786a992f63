import math
import random

import pytest

from revrank.llm import topk_search


def brute(rows, every=50, k=5):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = {}
    for q in (i for i in usable if i % every == 0):
        scores = [
            (-sum(a * b for a, b in zip(usable[q][0], x)), c) for c, xs in usable.items() if c != q for x in xs
        ]
        out[q] = [(c, -s) for s, c in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in topk_search.top_k(df).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("spread", [0.0, 2.0])
def test_equals_brute_force_over_many_blocks(spark, monkeypatch, spread):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 40)
    rng = random.Random(3)
    rows = []
    for i in range(420):
        center = [rng.gauss(0, 1) for _ in range(12)] if i % 6 else [float(i % 4 == j) * 3 for j in range(12)]
        length = math.exp(rng.gauss(0, spread)) if spread else 1.0
        rows.append((i, [float(x * length) for x in center]))
    # Ties and vectors that take no part.
    rows += [(500 + i, rows[50][1]) for i in range(9)]
    rows += [(600, None), (650, [1.0, None] * 6), (700, [float("nan")] * 12), (750, [float("inf")] + [0.0] * 11), (800, [0.0] * 12), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    rows = [(r[0], r[1]) for r in df.collect()]
    assert found(df) == brute(rows)


def test_large_components_stay(spark, monkeypatch):
    """Lengths up to where scores just fit 64 bits, and beyond where they are never among the best."""
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 40)
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 1) * 10 ** rng.choice([0, 2, 5, 6]) for _ in range(6)]) for i in range(300)]
    rows += [(400 + i, [rng.randint(-(1 << 22), 1 << 22) + 0.5 for _ in range(6)]) for i in range(60)]
    rows += [(500, [70000.0, 1.0, 0.0, 0.0, 0.0, 0.0]), (501, [70000.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    assert found(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")) == brute(rows)
    far = [(0, [1.0, -1e20, 3.0]), (1, [2.0, 1e20, 1e5]), (2, [-7.0, 0.0, 5e12]), (3, [1.0, 0.0, 0.0]), (4, [0.0, 0.0, 2e5]), (5, [1.0, 0.0, 9.0]), (6, [2.0, 0.0, 4.0])]
    assert found(spark.createDataFrame(far, "vec_id bigint, embedding array<double>")) == brute(far)
    with pytest.raises(Exception, match="does not fit bigint"):
        found(spark.createDataFrame([(0, [1e20]), (1, [1e20])], "vec_id bigint, embedding array<double>"))


def test_products_are_exact_at_any_length():
    import numpy as np

    rng = random.Random(8)
    for top in (1 << 20, 1 << 29, 1 << 31, 1 << 40, 1 << 70):
        a, b = ([[float(rng.randint(-top, top)) for _ in range(5)] for _ in range(30)] for _ in range(2))
        bound = max(math.hypot(*x) for x in a) * max(math.hypot(*x) for x in b)
        want = [[min(max(sum(int(p) * int(q) for p, q in zip(x, y)), topk_search.BELOW), topk_search.ABOVE) for y in b] for x in a]
        assert topk_search._products(np.array(a), np.array(b), bound).tolist() == want


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [3.0], 2), (2, [], 2), (3, [-1.0, 0.5, 7.0], None)],
        "vec_id bigint, embedding array<double>, rank int",
    )
    assert found(df) == {0: [(1, 768 * 256), (2, 0), (3, -256 * 256 + 512 * 128)]}
    assert topk_search.top_k(df.limit(0)).count() == 0
    assert topk_search.top_k(df.filter("vec_id = 0")).count() == 0
