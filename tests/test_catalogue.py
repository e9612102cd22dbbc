"""Every core query with SQL against DuckDB; every other one must give a stable schema."""

import decimal
import glob
import os

import duckdb
import pytest

from feedloom.plans import catalogue


@pytest.fixture(scope="module")
def db(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def text(v):
    if isinstance(v, (float, decimal.Decimal)) and not isinstance(v, bool):
        return repr(round(float(v), 6) + 0.0)
    return str(v)


def lines(rows, cols):
    return sorted("|".join(text(r[c]) for c in cols) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_equals_sql(spark, sf, db, name):
    df = catalogue.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    found = db.execute(catalogue.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    assert lines([r.asDict() for r in df.collect()], cols) == lines([dict(zip(names, r)) for r in found.fetchall()], cols)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_runs(spark, sf, name):
    df = catalogue.QUERIES[name](spark, sf)
    assert df.columns and df.count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 30
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_import_llm():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for f in glob.glob(f"{root}/feedloom/**/*.py", recursive=True):
        if "/llm/" not in f:
            assert "feedloom.llm" not in open(f).read(), f
