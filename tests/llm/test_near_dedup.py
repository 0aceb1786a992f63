import random
import re

import numpy as np
import pytest

from revrank.llm import near_dedup as N

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def brute(rows, n):
    """Links and components over all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return {i: (len(s), root(i)) for i, s in sets}


@pytest.fixture(scope="module")
def crowd(spark, corpus):
    """The corpus and a crowd of copies around the threshold, some linked over others only."""
    rng = random.Random(9)
    rows = [(r[0], r[1]) for r in corpus]
    base = [f"w{rng.randrange(400)}" for _ in range(140)]
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(1, 12)):
            copy[rng.randrange(len(copy))] = f"v{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(copy)))
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).cache()


@pytest.mark.parametrize("n", [2, 5])
def test_classes_equal_brute_force(crowd, n):
    want = brute([(r["doc_id"], r["text"]) for r in crowd.collect()], n)
    got = {r["doc_id"]: r for r in N.near_duplicates(crowd, words=n).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(4)
    for share in (0.75, 0.8, 0.9, 1.0):
        a = rng.integers(0, 1 << 64, 2000, dtype=np.uint64)
        other = int(2000 * (1 - share) / (1 + share))
        b = np.concatenate((a[other:], rng.integers(0, 1 << 64, other, dtype=np.uint64)))
        x, y = (N.odd_sketch(N.min_hashes(np.unique(s), N._ODD)) for s in (a, b))
        ones = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
        estimate = 1 + N.SKETCH_BITS / (4 * N.SKETCH_SAMPLES) * np.log(1 - 2 * ones / N.SKETCH_BITS)
        assert abs(estimate - share) < 0.04
        assert ones <= N.most_flips(0.8) or share < 0.8


def test_parity_maps_bound_the_difference_of_sets():
    rng = np.random.default_rng(8)
    for size, own in ((5, 2), (150, 30), (150, 0), (3000, 900), (20000, 9000)):
        shared, one, two = (np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64)) for n in (size, own, own))
        x, y = (N.parity_map(np.concatenate((shared, s))) for s in (one, two))
        ones = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
        assert ones <= 2 * own and ones >= 2 * own - own * own / 500


def test_pairs_just_below_the_threshold_are_not_listed(spark, monkeypatch):
    # Common and own shingles 200 to 31, so all pairs are 0.76 alike: no link, but within the margin of the sketches.
    common = " ".join(f"c{i}" for i in range(201))
    rows = [(n, common + " " + " ".join(f"d{n}_{i}" for i in range(31))) for n in range(30)]
    listed, real = [], N.confirmed
    monkeypatch.setattr(N, "confirmed", lambda pairs, *rest: (listed.append(pairs.count()), real(pairs, *rest))[1])
    found = N.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=2).collect()
    assert all(r["kept"] for r in found) and len(found) == 30
    assert listed[-1] == 0


def test_words_in_chunks(monkeypatch):
    text = "Ab cD\té\x0bx  " * 3000 + "y" * 5000
    whole = N.word_hashes(text)
    assert len(whole) == len(WORD.findall(text))
    monkeypatch.setattr(N, "CHUNK", 777)
    assert (N.word_hashes(text) == whole).all()


def test_components_of_a_chain(spark):
    links = spark.range(1, 40).selectExpr("id * 10 AS a", "(id - 1) * 10 AS b")
    assert {r["component"] for r in N.components(links).collect()} == {0}
    assert N.components(links.limit(0)).count() == 0


def test_rows_of_the_stage(docs, odd_docs, corpus):
    want = brute([(r[0], r[1]) for r in corpus], 5)
    kept = sorted(r["doc_id"] for r in N.drop_near_duplicates(docs).collect())
    assert kept == sorted(i for i, (_, c) in want.items() if i == c)
    rows = N.drop_near_duplicates(odd_docs)
    assert rows.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in rows.collect()) == ["1", "2", "3", "3", "None", "None"]
    assert N.near_duplicates(docs.limit(0)).count() == 0
