import random

import pytest

WORDS = {
    "en": "the of and to in is that it for was with on as be by this are from at or an have not".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "fr": "le la les de des et en un une du que qui dans pour est sur au avec ne se pas plus par".split(),
}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "er", "ung", "tion", "eux", "a"]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source) with copies, near copies, white space, nulls and a long text."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        lang = ["en", "de", "fr"][i % 3]
        rows.append((i, prose(rng, lang, rng.randint(20, 120)), lang, f"s{i % 5}" if i % 7 else "hot"))
    base = rows[0][1].split(" ")
    for j in range(12):
        copy = list(base)
        copy[rng.randrange(len(copy))] = "changed"
        rows.append((100 + j, " ".join(copy), "en", "hot"))
    rows += [(200 + j, rows[4][1], "de", "hot") for j in range(9)]
    rows += [
        (300, "", "en", None), (301, None, "en", None), (302, " \n\t ", None, "s1"), (303, "One", "en", "s1"), (304, "one", None, "s1"),
        (305, "12345 67 !!", None, "s2"), (306, prose(rng, "fr", 9000), "fr", "s2"), (307, "日本語のテキスト" * 40, None, "s3"),
        (308, "x" * 3000, None, "s3"), (309, "a\u00a0b\u2003c one\x0btwo\x0cthree", None, "s4"),
    ]
    return rows


COLUMNS = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, COLUMNS).repartition(5).cache()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, repeated rows, one id with two texts, names that operators use themselves."""
    rows = [
        (1, "the of and to in is that it for was", "en", "a", 7, "x"), (1, "the of and to in is that it for was", "en", "a", 7, "x"),
        (2, None, None, None, None, None), (None, "the of and", "en", "b", 1, "y"), (None, None, None, None, None, None),
        (3, "der die und in den von zu das mit sich", "de", "b", 2, "z"), (3, "le la les de des et en un une du", "fr", None, 3, "z"),
    ]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, size bigint, target string"
    ).withColumnsRenamed({}).selectExpr("*", "size AS score", "target AS `key`", "size AS kept", "target AS term")
