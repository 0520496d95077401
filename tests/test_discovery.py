import json

from pyspark.sql import functions as F

from factloom.functions import catalog
from factloom.operators.normalize import normalize_tag
from factloom.registry import base
from factloom.schemas import CORRUPT
from factloom.sources import discovery
from factloom.sources.documents import discovered_submissions, raw_submissions


def put(folder, *documents):
    folder.mkdir()
    for n, d in enumerate(documents):
        (folder / f"{n}.json").write_text(d if isinstance(d, str) else json.dumps(d, indent=1))
    return str(folder)


def test_columns_and_types_of_all_documents_are_found(spark, tmp_path):
    path = put(tmp_path / "in", {"cik": 1, "sic": 10, "odd name": None, "n": {"x": [1]}},
               {"cik": 2, "sic": "ten", "VOID": True, "n": {"x": [1.5], "y": "t"}, "source_path": "p"}, '{"cik": 3', "[1]")
    texts = discovery.read_texts(spark, path)
    schema = discovery.discover_schema(texts)
    assert {f.name: f.dataType.simpleString() for f in schema.fields} == {
        "cik": "bigint", "sic": "string", "odd name": "string", "VOID": "boolean",
        "n": "struct<x:array<decimal(21,1)>,y:string>", "source_path": "string"}
    rows = discovery.read_with(texts, schema).collect()
    assert len(rows) == 4
    good = {r["cik"]: r for r in rows if r[CORRUPT] is None and r["cik"]}
    assert good[1]["sic"] == "10" and good[2]["sic"] == "ten" and good[2]["source_path"] == "p"
    assert good[2]["_source_path"].endswith("1.json") and good[1]["VOID"] is None
    assert any(r[CORRUPT] == '{"cik": 3' for r in rows)


def test_no_document_gives_no_columns(spark, tmp_path):
    path = put(tmp_path / "in", "broken", "7")
    texts = discovery.read_texts(spark, path)
    assert discovery.discover_schema(texts).fields == []
    assert sorted(r[CORRUPT] for r in discovery.read_with(texts, discovery.discover_schema(texts)).collect()) == ["7", "broken"]


def test_discovered_submissions_have_the_declared_columns(spark, tmp_path):
    path = put(tmp_path / "in", {"cik": "0000000005", "name": "A", "tickers": ["T"], "flags": {"a": 1}, "filings": {"recent": {"form": ["8-K"]}}},
               {"cik": 6, "name": "B", "sic": 1234})
    read = discovered_submissions(spark, path)
    rows = {r["cik_raw"]: r for r in raw_submissions(read).collect()}
    assert rows["5"]["sic_raw"] is None and rows["6"]["sic_raw"] == "1234" and rows["5"]["tickers_raw"] == ["T"]
    assert json.loads(rows["5"]["filings_blob"]) == {"recent": {"form": ["8-K"]}} and rows["5"]["source_path"]
    assert {r["flags"]["a"] for r in read.filter("flags IS NOT NULL").collect()} == {1}


def nodes(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line.strip(" :+-").split(" ")[0] for line in plan.splitlines()]


def test_sql_functions_plan_like_the_dataframe(spark, small, seed):
    catalog.register(spark, seed)
    base.rows(spark, small).createOrReplaceTempView("reported")
    called = spark.sql("SELECT raw_concept, normalize_gaap_tag(raw_concept) AS canonical_concept, "
                       "fiscal_quarter(period_end) AS q FROM reported")
    direct = normalize_tag(seed)(base.rows(spark, small)).select(
        "raw_concept", "canonical_concept", F.quarter("period_end").alias("q"))
    assert called.exceptAll(direct).isEmpty() and direct.exceptAll(called).isEmpty()
    for df in (called, direct):
        assert nodes(df).count("Join") == direct._jdf.queryExecution().optimizedPlan().toString().count("Join ")
        assert "Python" not in df._jdf.queryExecution().toString()
    assert spark.sql("SELECT expected_quarters(DATE'2019-12-31', DATE'2020-06-30')").first()[0] == 3
    assert spark.sql("SELECT base_form('10-K/A'), pad_identifier('7'), period_key(DATE'2020-01-02'), quarter_index(DATE'2020-04-01')"
                     ).first()[:] == ("10-K", "0000000007", 20200102, 8082)
    assert spark.sql("SELECT pct_change(3.0D, 0.0D), pct_change(3.0D, -2.0D)").first()[:] == (None, 2.5)
    assert spark.sql("SELECT count(*) FROM synonyms_of('Revenues')").first()[0] == seed.filter("canonical_tag = 'Revenues'").count()
