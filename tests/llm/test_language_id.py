import numpy as np
import pytest
from pyspark.sql import functions as F

from revrank.llm import language_id as L


@pytest.fixture(scope="module")
def filters(docs):
    return L.train_filters(docs.filter(~L.held_out()))


def test_held_out_accuracy(docs, filters):
    rows = L.identify(docs, filters).join(docs, "doc_id").filter(L.held_out() & F.col("lang").isNotNull() & (F.length("text") > 40)).collect()
    assert len(rows) > 10
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_unknown(docs, filters):
    got = {r["doc_id"]: r for r in L.identify(docs, filters).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (300, 301, 302, 305))
    assert got[303]["lang_pred"] in {"en", "de", "fr"} and got[307]["lang_pred"] in {"en", "de", "fr"}


def test_filters_hold_what_went_in_and_count_by_brute_force(filters):
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    at = [p.astype(int) for p in filters.places(grams)]
    for i in range(len(filters.languages)):
        plane = (filters.planes[i // 8] >> (i % 8)) & 1
        assert filters.hits(grams)[i] == int((plane[at[0]] & plane[at[1]]).sum())
    # False hits come as often as the fill says.
    assert np.all(np.abs(filters.hits(grams) / 4000 - filters.chance) < 0.02)


def test_long_texts_are_the_sum_of_their_parts(filters, monkeypatch):
    text = "the of and to in is that it was " * 400
    whole = filters.predict(text)
    monkeypatch.setattr(L, "CHUNK", 100)
    assert filters.predict(text) == whole


def test_rows_of_the_stage(docs, odd_docs, filters, corpus):
    kept = {r["doc_id"] for r in L.keep_identified(docs, filters).collect()}
    assert not kept & {300, 301, 302, 305}
    assert {r[0] for r in corpus if r[2] and r[1] and len(r[1]) > 40} <= kept
    rows = L.keep_identified(odd_docs, filters)
    assert rows.columns == odd_docs.columns and rows.count() == 5
    assert L.keep_identified(docs.limit(0), filters).count() == 0


def test_nothing_to_learn_from(docs):
    none = L.train_filters(docs.limit(0))
    assert {r["lang_pred"] for r in L.identify(docs, none).collect()} == {"und"}
