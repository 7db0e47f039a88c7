"""Every query against DuckDB's answer to its SQL on the same files."""

import decimal

import duckdb
import pytest

from mulberry.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, float):
        return repr(value)
    return str(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = duck.execute(SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    expected = sorted([plain(r[names.index(c)]) for c in columns] for r in found.fetchall())
    assert sorted([plain(r[c]) for c in columns] for r in df.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_approximate_counts_are_near(spark, sf_dir):
    exact = dict(QUERIES["agg_uniq_exact"](spark, sf_dir).collect())
    for name in ("agg_uniq", "agg_state_uniq"):
        for kind, n in QUERIES[name](spark, sf_dir).collect():
            assert abs(n - exact[kind]) <= max(2, 0.1 * exact[kind])


def test_reduced_vectors_find_nearly_the_same(spark, sf_dir):
    exact = {r[0] for r in QUERIES["fn_l2_distance"](spark, sf_dir).collect()}
    assert len(exact & {r["vec_id"] for r in QUERIES["fn_l2_reduced"](spark, sf_dir).collect()}) >= 9
