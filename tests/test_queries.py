"""Every query with SQL equals DuckDB on the smallest tables; without the training-data part all still imports."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from cueloom.plans import queries as engine

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def shown(rows):
    return sorted(tuple("nan" if isinstance(v, float) and math.isnan(v) else repr(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(engine.queries()))
def test_query(spark, duck, name):
    made = engine.queries()[name](spark, SF)
    columns = sorted(made.columns)
    rows = [tuple(r) for r in made.select(*columns).collect()]
    assert rows
    sql = engine.oracle_sql().get(name)
    if sql:
        names = ", ".join(f'"{c}"' for c in columns)
        assert sorted(duck.sql(sql).columns) == columns
        assert shown(rows) == shown(duck.sql(f"SELECT {names} FROM ({sql})").fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(engine.queries()) <= set(entry_module.queries())
