"""Every registered query that has SQL against that SQL, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def rows(names, values):
    place = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in place) for r in values), key=repr)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def same(spark, con, name):
    df = entry.queries()[name](spark, SF)
    want = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, map(tuple, df.collect())) == rows(want.columns, want.fetchall())


def _timeline():
    from chronoweave.plans import catalogue, catalogue_io

    return sorted(catalogue.QUERIES | catalogue_io.QUERIES)


@pytest.mark.parametrize("name", _timeline())
def test_query(spark, con, name):
    same(spark, con, name)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_flagship_plan_has_no_cross_join(spark):
    plan = entry.entry(spark)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_corpus_operators_are_not_imported_elsewhere():
    root = os.path.dirname(entry.__file__)
    for folder, _, files in os.walk(os.path.join(root, "chronoweave")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(folder, f)) as source:
                        assert "llm" not in source.read(), f
