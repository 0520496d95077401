"""Every query against its SQL twin."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from factloom import registry

ROOT = Path(__file__).resolve().parents[1]
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small}/{name}.parquet')")
    return connection


def ordered(names, rows):
    places = [names.index(n) for n in sorted(names)]
    return sorted(([r[i] for i in places] for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_a_twin():
    assert set(registry.queries) == set(registry.oracles)
    assert set(registry.queries) <= set(contract.queries())


def test_core_queries_stand_without_an_optional_library():
    code = ("import sys; sys.modules['tokenizers'] = None; import __spark_entry__ as e; "
            "assert 'qoq_change' in e.queries() and 'op5_token_counts' not in e.queries()")
    found = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert found.returncode == 0 and "left out" in found.stderr, found.stderr


def test_entry(spark):
    assert contract.entry(spark).count() == 1040


@pytest.mark.parametrize("name", sorted(registry.queries))
def test_query_equals_sql(spark, duck, small, name):
    df = contract.queries()[name](spark, small)
    result = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    assert {n: kinds[t] for n, t in df.dtypes} == {d[0]: str(d[1]) for d in result.description}
    assert ordered(df.columns, [tuple(r) for r in df.collect()]) == ordered(names, result.fetchall())
