from pathlib import Path

import pytest

from factloom.sources.partitions import PartitionedTable

SCHEMA = "k string, year int, v double"


def rows_of(table):
    return sorted(map(tuple, table.read().collect()), key=str)


def files_of(table, year):
    return sorted(p.name for path in table.paths() if f"/year={year}/" in path for p in Path(path).glob("part-*"))


@pytest.fixture
def table(spark, tmp_path):
    made = PartitionedTable(spark, str(tmp_path / "t"), ("year",))
    made.replace(spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0), ("c", 2, 3.0), ("d", 3, 4.0)], SCHEMA), batch=7)
    return made


def test_merge_changes_touched_partitions_only(spark, table):
    before = {year: files_of(table, year) for year in (1, 2, 3)}
    assert all(before.values())
    changes = spark.createDataFrame([("b", 1, 20.0), ("e", 4, 5.0)], SCHEMA)
    table.merge(changes, ["k", "year"], removed=spark.createDataFrame([("d", 3)], "k string, year int"))
    assert rows_of(table) == [("a", 1, 1.0), ("b", 1, 20.0), ("c", 2, 3.0), ("e", 4, 5.0)]
    assert files_of(table, 2) == before[2] and files_of(table, 1) != before[1]
    assert files_of(table, 3) == [] and files_of(table, 4)
    assert table.properties() == {"batch": 7}


def test_state_before_last_is_kept_for_readers(spark, table):
    first = table.read()
    table.merge(spark.createDataFrame([("a", 1, 9.0)], SCHEMA), ["k", "year"])
    assert {r["k"]: r["v"] for r in first.collect()}["a"] == 1.0
    table.merge(spark.createDataFrame([("a", 1, 10.0)], SCHEMA), ["k", "year"], batch=8)
    folder = Path(table.folder)
    assert len(list(folder.glob("m-*"))) == 2 and len(list(folder.glob("data/year=1/commit=*"))) == 2
    assert len(list(folder.glob("data/year=2/commit=*"))) == 1 and table.properties() == {"batch": 8}


def test_a_merge_that_fails_leaves_the_table(spark, table):
    bad = spark.createDataFrame([("a", 1, 9.0), ("c", 2, 9.0)], SCHEMA).selectExpr(
        "k", "year", "IF(k = 'c', raise_error('lost'), v) AS v")
    with pytest.raises(Exception, match="lost"):
        table.merge(bad, ["k", "year"])
    assert rows_of(table)[0] == ("a", 1, 1.0) and len(rows_of(table)) == 4


def test_null_keys_odd_names_and_empty_merges(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), ("part",))
    assert not table.exists()
    schema = "k string, part string, v long"
    table.merge(spark.createDataFrame([(None, "a b", 1), ("x", None, 2), ("y", "a=b/c:d", 3)], schema), ["k", "part"])
    table.merge(spark.createDataFrame([(None, "a b", 10), ("x", None, 20), ("y", "a=b/c:d", 30)], schema), ["k", "part"])
    assert rows_of(table) == sorted([(None, "a b", 10), ("x", None, 20), ("y", "a=b/c:d", 30)], key=str)
    table.merge(spark.createDataFrame([], schema), ["k", "part"])
    assert len(rows_of(table)) == 3
    table.merge(spark.createDataFrame([], schema), ["k", "part"], removed=table.read())
    assert rows_of(table) == [] and table.read().schema.simpleString() == "struct<k:string,part:string,v:bigint>"


def test_two_columns_of_partitions(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), ("a", "b"))
    schema = "a int, b int, v int"
    table.replace(spark.createDataFrame([(1, 1, 1), (1, 2, 2), (2, 1, 3)], schema))
    table.merge(spark.createDataFrame([(1, 2, 9)], schema), ["a", "b"])
    table.merge(spark.createDataFrame([(1, 2, 10)], schema), ["a", "b"])
    assert rows_of(table) == [(1, 1, 1), (1, 2, 10), (2, 1, 3)]
    assert len(table.paths()) == 3
