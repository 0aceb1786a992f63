"""The pooled model's gradient in one pass over parts of the chunks: same numbers as in two passes over blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revrank.operators import sequence_blocks
from revrank.operators.sequence_blocks import chunk_nodes, pack_histories, pooled_softmax_gradient
from revrank.session import cut


@pytest.mark.parametrize("scale", [1.0, 40.0])
def test_one_pass_equals_two(spark, monkeypatch, scale):
    """Hot users in chunks, users of one row, items without rows, scores that need a shift before exp()."""
    rng = np.random.default_rng(5)
    rows = [(int(u), int(rng.integers(0, 25)), t) for t, u in enumerate(rng.choice(12, 300, p=[0.45] + [0.05] * 11))]
    log = cut(spark.createDataFrame([*rows, (99, 3, 0)], "user_idx bigint, item_idx bigint, timestamp bigint"))
    chunks = pack_histories(log, ["timestamp"], 4, [], 16)
    links, _ = chunk_nodes(chunks, ["items"], 1000)
    vectors = [(n, 1, *[float(x) for x in rng.normal(size=3) * scale]) for n in range(30)]
    emb = cut(spark.createDataFrame(vectors, "node bigint, copies int, e0 double, e1 double, e2 double"))
    found = []
    for whole in (0, 1 << 20):
        if whole:
            monkeypatch.setattr(sequence_blocks, "blocked_logsumexp", None)
        out = pooled_softmax_gradient(chunks, links, emb, 3, 4, 288, whole)
        rows = out.orderBy("node").collect()
        found.append((np.array([r["node"] for r in rows]), np.array([[r["e0"], r["e1"], r["e2"]] for r in rows]), sum(r["loss"] for r in rows)))
    assert (found[0][0] == found[1][0]).all() and len(found[0][0]) == 30
    assert np.allclose(found[0][1], found[1][1], rtol=1e-9, atol=1e-12) and found[0][2] == pytest.approx(found[1][2], rel=1e-12)
