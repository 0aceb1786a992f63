import hashlib
import random

import public_tokenizers
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from revrank.llm import order_minhash as O
from revrank.llm import sentencepiece_bpe as S

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def listed(flat, counts):
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]


@pytest.fixture(scope="module")
def encoder():
    with open(MODEL, "rb") as f:
        return S.Encoder(f.read())


def test_ids_equal_the_library(encoder):
    rng = random.Random(6)
    alphabet = "abcdeéß ▁\n\t.,12日本😀́​  theing<s>/"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    texts += ["", " ", "   ", "\n", "</s><unk>", "a" * 3000, "▁▁ a", "x\x00y", "the " * 2000, "ﬁ é"]
    want = encoder.table.library.encode(texts, num_threads=1)
    assert listed(*encoder.encode_all(texts)) == want


def test_agenda_and_lock_step_agree(encoder):
    rng = random.Random(7)
    chunks = [S.SPACE * rng.randint(0, 3) + "".join(rng.choice("abcdehinorst") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    assert [encoder.table.by_agenda(c) for c in chunks] == encoder.table.in_lock_step(chunks)


def test_kept_chunks_are_bounded(encoder, monkeypatch):
    monkeypatch.setattr(encoder.known, "most", 50)
    texts = [f"word{i} other{i * 7} thing{i % 9}" for i in range(200)]
    assert listed(*encoder.encode_all(texts)) == encoder.table.library.encode(texts, num_threads=1)


def test_a_stage_keeps_a_share_of_the_chunks(encoder, monkeypatch):
    monkeypatch.setattr(S, "KEPT_CHUNKS", 5000)
    with open(MODEL, "rb") as f:
        small = S.Encoder(f.read(), share=S.STAGE_SHARE)
    assert (small.known.most, small.known.most_characters) == (5000 // S.STAGE_SHARE, S.KEPT_CHARACTERS // S.STAGE_SHARE)
    for start in range(0, 3000, 300):
        texts = [f"word{i} other{i * 7} thing{i % 9}" for i in range(start, start + 300)]
        assert listed(*small.encode_all(texts)) == encoder.table.library.encode(texts, num_threads=1)
    assert len(small.agreed) < len(encoder.agreed)


def test_rows(docs, odd_docs, corpus):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = {r["doc_id"]: r for r in S.encode_texts(docs, MODEL).collect()}
    digests = {r["doc_id"]: r for r in S.encoding_digests(docs, MODEL).collect()}
    assert len(rows) == len(digests) == len(corpus)
    for i, text, *_ in corpus:
        ids = [*lib.encode(text or ""), lib.eos_id()]
        assert rows[i]["ids"] == ids and rows[i]["decoded"] == lib.decode(ids)
        assert digests[i]["n_tokens"] == len(ids)
        assert digests[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert S.encode_texts(odd_docs, MODEL).count() == 7 and S.encode_texts(docs.limit(0), MODEL).count() == 0


def brute_edits(rows):
    order = sorted(rows)
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        h = len(t) // 2
        yield d, t, t[: len(t) - h] + after[:h]


def test_edits_and_prints(docs, corpus):
    rows = {r["doc_id"]: r for r in O.fingerprints(docs).collect()}
    prints = {}
    for d, text, edited in brute_edits([(r[0], r[1] or "") for r in corpus]):
        r = rows[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints.setdefault(text, set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert rows[200]["near_next"] == 1
    long = [r for r in rows.values() if 200 < r["n_chars"]]
    assert sum(r["near_edited"] for r in long) > sum(r["near_next"] for r in long if r["doc_id"] < 100)


def test_prints_by_brute_force(spark):
    """Bins, occurrence numbers and pairs from scratch, with the engine's own hash."""
    texts = ["a b c a b c a b c d e f", "one two", "", "x", " ".join(f"w{i % 17}" for i in range(300)), "漢字" * 60,
             "a b " + "漢字仮名交" * 9 + " c d e", "x" * 24 + " " + "y" * 25]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r["p"] for r in O.with_fingerprint(df, "text", "p").select("p").collect()]

    def hashed(rows, kind):
        names = [f"c{i}" for i in range(max(map(len, rows)))]
        padded = [tuple(r) + (None,) * (len(names) - len(r)) for r in rows]
        schema = ", ".join(f"{n} {kind}" for n in names)
        return [r[0] for r in spark.createDataFrame(padded, schema).coalesce(1).select(F.xxhash64(*names)).collect()]

    for text, found in zip(texts, got):
        words = [s for w in text.split() for s in ([w] if len(w) <= 24 else w)]
        grams = [words[i : i + 3] for i in range(max(1, len(words) - 2))] if words else [[text]]
        base = [h & O.HASH_MASK for h in hashed(grams, "string")]
        seen, numbered = {}, []
        for h in base:
            numbered.append((h, seen.get(h, 0)))
            seen[h] = seen.get(h, 0) + 1
        both = spark.createDataFrame(numbered, "h bigint, n int").coalesce(1).select(F.xxhash64("h", "n")).collect()
        full = sorted((r[0] & O.HASH_MASK, place) for place, r in enumerate(both))
        bins = {}
        for h, place in full:
            bins.setdefault(h >> (O.HASH_BITS - O.BIN_BITS), []).append((place, h))
        used = sorted(bins)
        chosen = [(b, place, h) for b in used for place, h in bins[b][:2]]
        pairs = []
        for i, (b, place, h) in enumerate(chosen):
            if i and chosen[i - 1][0] == b:
                continue
            _, other, g = chosen[(i + 1) % len(chosen)]
            pairs.append([h] if len(chosen) == 1 else [h, g] if place < other else [g, h])
        want = [b << O.PAIR_BITS | (h & ((1 << O.PAIR_BITS) - 1)) for b, h in zip(used, hashed(pairs, "bigint"))]
        want = [v - (1 << 32) if v >> 31 else v for v in want]
        assert found == want, text


def test_order_matters(spark):
    words = [f"w{i}" for i in range(400)]
    same, swapped = " ".join(words), " ".join(words[200:] + words[:200])
    df = spark.createDataFrame([(same, swapped)], "a string, b string")
    df = O.with_fingerprint(O.with_fingerprint(df, "a", "p"), "b", "q")
    # Nearly the same k-mers, but about half of the pairs are in the other order.
    assert 0.3 < df.select(O.likeness("p", "q")).first()[0] < 0.75


def test_one_kind_of_symbols_and_order_in_short_texts(spark):
    rng = random.Random(4)
    chinese = "".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(2000))
    prose = " ".join(f"w{rng.randrange(900)}" for _ in range(300))
    short = [f"s{i}" for i in range(12)]
    rows = [
        (chinese, chinese[:1000] + prose[:1000]), (" ".join(short), " ".join(short[6:] + short[:6])),
        (" ".join(short), " ".join(short[:6] + [f"t{i}" for i in range(6)])),
    ]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    df = O.with_fingerprint(O.with_fingerprint(df, "a", "p"), "b", "q")
    mixed, swapped, half = [r[0] for r in df.select(O.likeness("p", "q")).collect()]
    assert 0.05 < mixed < 0.8
    # Eight of ten k-mers are the same, 0.67 as sets.
    assert swapped < 0.45
    assert half > 0


def test_prints_odd_rows(odd_docs, docs):
    assert O.fingerprints(odd_docs).count() == 7
    assert O.fingerprints(docs.limit(0)).count() == 0
    one = O.fingerprints(docs.filter("doc_id = 3")).first()
    assert one["near_next"] == 1
