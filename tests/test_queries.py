"""Every registered query against its SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as contract
from tidewatch import oracle, registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES.split():
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return repr(v + 0.0) if isinstance(v, float) else str(v)


def test_every_query_has_sql_except_the_undetermined_ones():
    without = set(registry.all_queries()) - set(contract.oracle_sql())
    assert without == {"kmeans_clusters", "kmeans_outliers", "kmeans_with_heading", "sampled_lines"}
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(oracle.all_sql()))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = contract.queries()[name](spark, sf_dir)
    want = duck.sql(contract.oracle_sql()[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    place = [want.columns.index(c) for c in order]
    ours = sorted((tuple(value(v) for v in r) for r in got.select(*[f"`{c}`" for c in order]).collect()), key=repr)
    theirs = sorted((tuple(value(r[i]) for i in place) for r in want.fetchall()), key=repr)
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(registry.all_queries()) - set(oracle.all_sql())))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert contract.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
