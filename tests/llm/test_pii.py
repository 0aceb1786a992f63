import random
import re

import pytest
from pyspark.sql import functions as F

from revrank.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in re.sub("[^0-9]", "", m.group())][::-1]
        if 12 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_patterns_equal_plain_regular_expressions():
    rng = random.Random(1)
    for alphabet in ("0123456789..-- +()@ab_%.é", "ab@.-", "+12 -().", "0123456789 -"):
        for _ in range(20000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 34)))
            assert pii.base_spans(text) == brute(text), text


@pytest.mark.parametrize("text", ["a" * 300000, "1" * 300000, "1." * 150000, "+" * 200000, "a@" * 150000, "+1(" * 100000, "a.b@" * 80000])
def test_long_texts_do_not_backtrack(text):
    pii.base_spans(text)


@pytest.fixture(scope="module")
def people(spark):
    """ann@x.org is known as 'Quillfeather' all over the corpus; other words are common."""
    rng = random.Random(2)
    common = "the of and that with for was are this from have not".split()
    talk = lambda n: " ".join(rng.choice(common) for _ in range(n))
    rows = [(i, f"{talk(12)} Quillfeather {talk(2)} ann@x.org {talk(9)}") for i in range(6)]
    rows += [(10 + i, f"{talk(30)} +49 30 1234567{i} {talk(10)}") for i in range(20)]
    rows += [(40 + i, talk(40)) for i in range(80)]
    rows += [(200, f"{talk(5)} quillfeather {talk(5)}"), (201, None), (202, ""), (203, f"rare word next bob@y.net {talk(3)}")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).cache()


def test_terms_that_reveal(people):
    text = {r["doc_id"]: r["text"] or "" for r in people.collect()}
    rows = {r["doc_id"]: r for r in pii.scan_pii(people).collect()}
    assert len(rows) == len(text)
    for i, r in rows.items():
        assert [(s["start"], s["kind"], s["end"]) for s in r["base"]] == brute(text[i])
        assert {text[i][t["start"] : t["end"]].lower() for t in r["terms"]} == ({"quillfeather"} if "uillfeather" in text[i] else set())
        assert r["n_phone"] == (10 <= i < 30)


def test_disclosure_by_brute_force(people):
    import math

    found = pii.find_entities(people).cache()
    flagged, _ = pii.revealing_terms(people, found, 0.0, 1.0, 3)
    got = {r["term"]: r["disclosure"] for r in flagged.collect()}
    near = [(r["doc_id"], n) for r in found.collect() for n in r["near"]]
    n, texts = people.count(), [set(re.findall(r"[^\W\d_]{3,}", (r["text"] or "").lower())) for r in people.collect()]
    want = {}
    for e in {x["entity"] for _, x in near}:
        e_docs = len({d for d, x in near if x["entity"] == e})
        for t in {x["term"] for _, x in near if x["entity"] == e}:
            mine = [(d, x) for d, x in near if x["entity"] == e and x["term"] == t]
            if len({x["context"] for _, x in mine}) >= 3:
                t_docs = sum(t in words for words in texts)
                value = min(1.0, math.log(len(mine) * n / (t_docs * e_docs)) / math.log(n / e_docs))
                want[t] = max(want.get(t, value), value)
    assert {t: round(v, 9) for t, v in got.items()} == {t: round(v, 9) for t, v in want.items() if v >= 0}


def test_names_in_a_repeated_phrase(spark):
    """One phrase in many different texts counts by text, whatever stands next to the name; exact copies count once."""
    rng = random.Random(4)
    talk = lambda n: " ".join(rng.choice("the of and that with for was are this from have not".split()) for _ in range(n))
    rows = [(i, f"{talk(30)} Please contact Jane Doe at jane@x.org for further details {talk(20)}") for i in range(40)]
    rows += [(100 + i, talk(40)) for i in range(400)]
    # Far from the entity; one text copied.
    rows += [(600 + i, f"{talk(3)} Farfetch {talk(24)} kim@z.org {talk(9)}") for i in range(6)]
    rows += [(700 + i, "signed by Copyman kit@y.net the of and") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = pii.find_entities(df).cache()
    flagged = {r["term"] for r in pii.revealing_terms(df, found, 0.9, 0.98, 2, 0.01)[0].collect()}
    assert flagged == {"please", "contact", "jane", "doe", "further", "details", "farfetch"}
    texts = dict(rows)
    for r in pii.scan_pii(df).filter("doc_id < 40").collect():
        assert {"jane", "doe"} <= {texts[r["doc_id"]][t["start"] : t["end"]].lower() for t in r["terms"]}


def test_two_texts_are_enough_where_chance_is_ruled_out(spark):
    rows = [(i, f"word{i} the of and") for i in range(3000)] + [(5000 + i, f"of Wrenfield mia@q.org and {'the ' * i}") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert [len(r["terms"]) for r in pii.scan_pii(df).filter("doc_id >= 5000").collect()] == [1, 1]


def test_rewritten_texts(people, odd_docs):
    before = {r["doc_id"]: r["text"] for r in people.collect()}
    for r in pii.sanitise(people.withColumn("n_chars", F.length("text"))).collect():
        text = r["text"]
        if 40 <= r["doc_id"] < 200 or r["doc_id"] in (201, 202):
            assert text == before[r["doc_id"]]
        else:
            assert not pii.base_spans(text) and "uillfeather" not in text
            assert r["n_chars"] == len(text)
    rows = pii.sanitise(odd_docs)
    assert rows.columns == odd_docs.columns and sorted(map(str, rows.collect())) == sorted(map(str, odd_docs.collect()))
    assert pii.scan_pii(odd_docs).count() == 7 and pii.scan_pii(odd_docs.limit(0)).count() == 0
