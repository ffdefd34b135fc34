import re

import duckdb
import pytest

import __spark_entry__ as entry
from lexiloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "documents pages conversations benchmark labels embeddings".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([r[k] for k in order]) for r in values)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql_agrees(spark, con, name):
    got = registry.QUERIES[name](spark, SF)
    found = con.execute(registry.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert rows(got.columns, map(tuple, got.collect())) == rows(columns, found.fetchall())


@pytest.mark.parametrize("name", sorted(registry.QUERIES.keys() - registry.ORACLES.keys()))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "n"] and df.count() > 0
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_library_does_not_need_the_training_operators():
    from pathlib import Path

    top = Path(registry.__file__).parents[1]
    for source in top.rglob("*.py"):
        if "llm" not in source.relative_to(top).parts:
            assert not re.search(r"lexiloom[. ](import )?llm", source.read_text()), source
