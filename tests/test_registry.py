"""Every query with SQL must give the SQL's rows; the others must give rows."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from revrank.registry import ORACLES, QUERIES  # noqa: E402
from tests.conftest import FOLDER  # noqa: E402
from tools.check import KINDS, TABLES, rows_of  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    kinds = dict(df.dtypes)
    assert sorted(kinds) == sorted(columns)
    for c in result.description:
        assert KINDS.get(str(c[1]), str(c[1])) == kinds[c[0]]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


MODEL_QUERIES = sorted(set(QUERIES) - set(ORACLES))


def test_only_fitted_models_lack_sql():
    assert all(n.startswith(("rec_", "logistic_", "forest_", "rank_")) for n in MODEL_QUERIES)


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_model_query_lists(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert rows
    if name.startswith("rec_"):
        per_user = {}
        for r in rows:
            per_user.setdefault(r["user_idx"], []).append((r["rank"], r["relevance"], r["item_idx"]))
        for lists in per_user.values():
            lists.sort()
            assert [x[0] for x in lists] == list(range(1, len(lists) + 1))
            assert len({x[2] for x in lists}) == len(lists) <= 10
            assert all(a[1] >= b[1] for a, b in zip(lists, lists[1:]))
