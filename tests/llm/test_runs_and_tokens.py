import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from revrank.llm.common import WORD
from revrank.llm.periodic_runs import collapse, find_runs, longest, periodic_runs, repeated_tail
from revrank.llm.token_alignment import align_tokenizers, byte_level_entries, piece_entries
from revrank.llm.token_files import CodeFile, level_widths, read_token_files, token_file_digests, write_codes, write_token_files
from revrank.llm.word_pieces import PieceEncoder

BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = [
    "", " ", "  ", " a", "a ", "a  b", "a   b c", "\n\n x", "x \n y", "it's  's 's", "a b   c", "<|endoftext|> a <|endoftext|>b",
    "日本 語 ", "᠎ a\x85 c\x1c d", "﻿ ﻿", "x 1 23 ,, .", "\x00 \x00a b", "  lead", "trail  ", "\t\tx y\r\n z", "é́ e", "▁ ▁a", "x" * 5000,
    "a. a b. b, word. word word? one.\ntwo one,\nthree\n", "a.b. 1. 2: x.. y?! é. ß, ê",
]


def plain_runs(words):
    """By definition: every lag, every maximal stretch, smallest period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 4), min_size=1, max_size=8), st.integers(1, 30)), max_size=4), max_size=6))
def test_runs_equal_the_definition(texts):
    words = [[str(w) for part, n in text for w in (part * n)[: max(n, len(part))]] for text in texts]
    assert find_runs(words) == [plain_runs(w) for w in words]


def test_long_repetitive_texts():
    rng = random.Random(2)
    period = [str(rng.randrange(3000)) for _ in range(20_000)]
    assert find_runs([["x"] * 60_000, period * 4, [str(i) for i in range(60_000)]]) == [[(0, 60_000, 1)], [(0, 80_000, 20_000)], []]


def test_rows_of_periodic_runs(spark, docs, odd_docs):
    found = {r.doc_id: r for r in periodic_runs(docs, rewrite=repeated_tail).withColumn("best", longest("runs")).collect()}
    import re

    for r in docs.collect():
        words = repeated_tail(r.doc_id, re.findall(WORD, r.text or ""))
        runs = plain_runs(words) if len(words) < 3000 else find_runs([words])[0]
        own = found[r.doc_id]
        assert [tuple(x) for x in own.runs] == runs and own.n_words == len(words)
        assert own.collapsed == " ".join(collapse(words, runs))
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        assert best is None and own.best.start is None or (own.best.start, own.best.length, own.best.period) == (best[1], -best[0], best[2])
    assert any(r.runs for r in found.values())
    assert periodic_runs(odd_docs).count() == odd_docs.count()
    assert periodic_runs(docs.limit(0)).count() == 0


def test_overlapping_runs_collapse():
    words = "a a a a a a b a a a a a a b a a a a a a b a a a a a a b x".split()
    runs = plain_runs(words)
    assert (0, 28, 7) in runs and len(runs) == 5
    assert collapse(words, runs) == ["a", "b", "x"]


@pytest.mark.parametrize("special", [False, True])
@pytest.mark.parametrize("space", [False, True])
def test_pieces_give_the_library_s_ids(corpus, special, space):
    texts = [t or "" for _, t, _, _ in corpus] + ODD_TEXTS
    with open(BYTE_LEVEL, encoding="utf-8") as f:
        encoder = PieceEncoder(f.read(), special)
    lib = tokenizers.Tokenizer.from_file(BYTE_LEVEL)
    lib.encode_special_tokens = special
    want = [lib.encode(" " + t if space else t, add_special_tokens=False).ids for t in texts]
    for _ in range(4):
        flat, counts = encoder.encode(texts, space)
        assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == want
        encoder.known.most = 1
    assert encoder.known.older is not None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 31) - 1) | st.integers(0, 600), max_size=1500), st.data())
def test_codes_are_directly_addressable(ids, data):
    ids = np.array(ids, np.int64)
    out = io.BytesIO()
    write_codes(out, ids, np.array([0, len(ids) // 3, len(ids)]), pa.array([5, None], pa.int64()))
    codes = CodeFile(pa.BufferReader(out.getvalue()))
    assert sum(level_widths(ids)) == max(1, int(ids.max()).bit_length() if len(ids) else 1)
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert codes.read(a, b).tolist() == ids[a:b].tolist()
    if len(ids):
        assert codes.token(min(a, len(ids) - 1)) == ids[min(a, len(ids) - 1)]
    assert codes.document(1).tolist() == ids[len(ids) // 3 :].tolist() and codes.keys().to_pylist() == [5, None]


def test_one_token_needs_few_bytes():
    rng = np.random.default_rng(0)
    ids = rng.zipf(1.3, 200_000) % 50_000
    out = io.BytesIO()
    write_codes(out, ids, np.array([0, len(ids)]), pa.array([1]))

    class Counting:
        def __init__(self):
            self.data, self.read_bytes = out.getvalue(), 0

        def read_at(self, n, at):
            self.read_bytes += n
            return self.data[at : at + n]

    file = Counting()
    codes = CodeFile(file)
    file.read_bytes = 0
    for place in rng.integers(0, len(ids), 50).tolist():
        assert codes.token(place) == ids[place]
    assert file.read_bytes < 50 * 500


def test_token_files_round_trip(spark, docs, corpus, odd_docs):
    lib = tokenizers.Tokenizer.from_file(BYTE_LEVEL)
    files = write_token_files(docs, BYTE_LEVEL, segment_tokens=2000)
    assert files.count() > 4
    read = {r.doc_id: r for r in read_token_files(files).collect()}
    prints = {r.doc_id: r for r in token_file_digests(files).collect()}
    start = 0
    for doc_id, text, _, _ in sorted(corpus):
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 0]
        assert (read[doc_id].start, read[doc_id].n_tokens, read[doc_id].ids) == (start, len(ids), ids)
        assert prints[doc_id].start == start and prints[doc_id].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(read) == len(corpus)
    odd = read_token_files(write_token_files(odd_docs, BYTE_LEVEL)).orderBy("start").collect()
    assert [r.doc_id for r in odd] == [None, None, 1, 1, 2, 3, 3]
    assert token_file_digests(write_token_files(docs.limit(0), BYTE_LEVEL)).count() == 0


def test_alignment_by_brute_force(spark, corpus, odd_docs):
    texts = [(i, t, None, None) for i, t, _, _ in corpus] + [(1000 + k, t, None, None) for k, t in enumerate(ODD_TEXTS)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string").repartition(5)
    got = {r.doc_id: r for r in align_tokenizers(docs, BYTE_LEVEL, PIECES).collect()}
    lib = tokenizers.Tokenizer.from_file(BYTE_LEVEL)
    lib.encode_special_tokens = True
    with open(BYTE_LEVEL, encoding="utf-8") as f:
        a_bytes = byte_level_entries(PieceEncoder(f.read(), True))
    b_lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    b_bytes = piece_entries(b_lib)
    want, counts = {}, Counter()

    def spans(ids, entries):
        ends = np.cumsum([0] + [len(entries[i]) for i in ids]).tolist()
        return list(zip(ends, ends[1:], ids))

    for doc_id, text, _, _ in texts:
        a, b = lib.encode(" " + (text or ""), add_special_tokens=False).ids, b_lib.encode(text or "")
        whole = b" " + (text or "").encode()
        if not text or b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            want[doc_id] = None
            continue
        a, b = spans(a, a_bytes), spans(b, b_bytes)
        links = [(x, y) for s, e, x in a for t, f, y in b if s < f and t < e] if len(a) < 3000 else None
        if links is None:
            links, k = [], 0
            for s, e, x in a:
                while b[k][1] <= s:
                    k += 1
                j = k
                while j < len(b) and b[j][0] < e:
                    links.append((x, b[j][2]))
                    j += 1
        cuts, groups, last = sorted({e for _, e, _ in a} & {e for _, e, _ in b}), [], 0
        for e in cuts:
            sides = [",".join(str(i) for s, f, i in side if last <= s and f <= e) for side in (a, b)]
            groups.append("|".join(sides))
            last = e
        want[doc_id] = (len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest())
        counts.update(set(links))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    assert len(got) == len(want)
    assert sum(v is None for v in want.values()) >= 4
    for doc_id, w in want.items():
        r = got[doc_id]
        full = (0, 0, 0, 0, 0, 0, "")
        if w is not None:
            best, total = sum(counts[p] == most[p[0]] for p in w[3]), sum(counts[p] for p in w[3])
            full = (w[0], w[1], w[2], len(w[3]), best, total, w[4])
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == full
    assert align_tokenizers(odd_docs, BYTE_LEVEL, PIECES).count() == odd_docs.count()
    assert align_tokenizers(docs.limit(0), BYTE_LEVEL, PIECES).count() == 0


def test_alignment_over_many_chunks(spark, docs):
    many, one = (
        sorted(align_tokenizers(d, BYTE_LEVEL, PIECES, chunk_pairs=n).collect(), key=lambda r: r.doc_id)
        for d, n in ((docs, 1), (docs.coalesce(1), 1 << 40))
    )
    assert many == one
