import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from factloom.operators import quality
from factloom.plans import warehouse
from factloom.registry import base
from factloom.sources.layers import LayerStore
from factloom.sources.tables import KEYS_PER_FACTS_DOCUMENT


@pytest.fixture(scope="module")
def built(spark, small, tmp_path_factory):
    """Documents as indented files, one per company, built into all layers."""
    root = tmp_path_factory.mktemp("build")
    for name in ("facts", "submissions"):
        (root / name).mkdir()
    rows = base.rows(spark, small).filter(F.col("raw_concept") != "UnmappedTag")
    assert rows.count() < KEYS_PER_FACTS_DOCUMENT
    from factloom.sources.documents import fold_fact_documents

    for r in fold_fact_documents(rows.withColumn("part", F.lit(0))).collect():
        (root / "facts" / f"{r['cik']}.json").write_text(json.dumps(json.loads(r["document"]), indent=1))
        company = {"cik": int(r["cik"]), "name": "Company " + r["cik"], "sic": 3571, "sicDescription": "x",
                   "stateOfIncorporation": "DE", "tickers": ["T" + r["cik"]], "exchanges": ["NYSE"],
                   "filings": {"recent": {"accessionNumber": ["a"], "filingDate": ["2001-01-01"], "form": ["10-K"]}}}
        (root / "submissions" / f"{r['cik']}.json").write_text(json.dumps(company, indent=2))
    store = LayerStore(spark, str(root / "tables"))
    report = warehouse.build(spark, store, str(root / "facts"), str(root / "submissions"),
                             as_of=F.lit("2001-09-01").cast("date"))
    return store, report.cache()


def test_all_checks_pass(built):
    _, report = built
    quality.require_pass(report)
    assert report.count() == 22


def test_every_table_is_there(built):
    store, _ = built
    tables = {
        "seeds": ["gaap_tag_synonyms", "companies"],
        "bronze": ["raw_company_facts", "raw_submissions", "concept_entries", "ingest_ledger"],
        "silver": ["fact_entries", "stg_financials", "stg_companies", "stg_filing_periods", "stg_filings"],
        "gold": ["dim_companies", "dim_fiscal_periods", "dim_gaap_concepts", "fact_financials", "rpt_anomaly_flags"],
    }
    for layer, names in tables.items():
        for name in names:
            assert store.read(layer, name).count() > 0, name
    assert store.read("bronze", "rejected_concepts").count() == 0
    assert store.read("gold", "dim_companies").filter("is_active").count() == 25


def test_damaged_documents_show_in_the_report(spark, tmp_path):
    """Three companies: one whole, one document cut off, one concept that is no object."""
    for name in ("facts", "submissions"):
        (tmp_path / name).mkdir()
    entry = {"val": 5, "start": "2020-01-01", "end": "2020-03-31", "accn": "a", "form": "10-Q",
             "filed": "2020-05-01", "fp": "Q1"}
    whole = {"units": {"USD": [entry]}}
    for cik, gaap in ((1, {"Assets": whole}), (2, {"Assets": whole}), (3, {"Assets": {"units": {"USD": entry}}})):
        text = json.dumps({"cik": cik, "entityName": f"E{cik}", "facts": {"us-gaap": gaap}}, indent=1)
        (tmp_path / "facts" / f"{cik}.json").write_text(text[:-9] if cik == 2 else text)
        company = json.dumps({"cik": cik, "name": f"C{cik}", "filings": {"recent": {}}})
        (tmp_path / "submissions" / f"{cik}.json").write_text(company[:-5] if cik == 2 else company)
    store = LayerStore(spark, str(tmp_path / "tables"))
    report = warehouse.build(spark, store, str(tmp_path / "facts"), str(tmp_path / "submissions"))
    failed = {r["check_name"]: r["failing_rows"] for r in report.collect() if r["status"] == "fail"}
    assert failed == {"documents rejected": 1, "concepts unreadable": 1, "submissions rejected": 1}
    assert [r["cik"] for r in store.read("gold", "dim_companies").select("cik").orderBy("cik").collect()] == [
        "0000000001", "0000000003"]
    with pytest.raises(AssertionError, match="documents rejected"):
        quality.require_pass(report)
    later = warehouse.build(spark, store, str(tmp_path / "facts"), str(tmp_path / "submissions"),
                            now=F.current_timestamp() + F.expr("INTERVAL 2 DAYS"))
    found = {r["check_name"]: r["failing_rows"] for r in later.collect()}
    assert found["documents fresh"] == found["submissions fresh"] == 2
    ledger = store.read("bronze", "ingest_ledger")
    assert sorted((r["kind"], r["status"], r["error"]) for r in ledger.filter("status = 'failed'").collect()) == [
        ("facts", "failed", "malformed"), ("submissions", "failed", "malformed")]
    with pytest.raises(RuntimeError, match="companies failed"):
        warehouse.build(spark, store, str(tmp_path / "facts"), str(tmp_path / "submissions"), stop_on_failure=True)


def test_failed_rebuild_leaves_the_table_readable(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    store.write(spark.range(3), "gold", "t")
    failing = spark.range(10).selectExpr("if(id > 5, raise_error('stop'), id) AS id")
    with pytest.raises(Exception, match="stop"):
        store.write(failing, "gold", "t")
    assert store.read("gold", "t").count() == 3
    for n in (4, 5, 6):
        before = store.read("gold", "t")
        store.write(spark.range(n), "gold", "t")
        assert before.count() in (3, 4, 5)  # the version it began with is still there
    assert store.read("gold", "t").count() == 6
    assert len(list((tmp_path / "gold" / "t").glob("v-*"))) == 2


def test_silver_equals_the_same_facts_as_rows(built, spark, small):
    store, _ = built
    columns = ["cik", "canonical_concept", "period_end", "reported_value", "accession_number", "form_type"]
    expected = base.silver(spark, small).filter("raw_concept <> 'UnmappedTag'").select(columns)
    stored = store.read("silver", "stg_financials").select(columns)
    assert expected.exceptAll(stored).count() == 0 and stored.exceptAll(expected).count() == 0


def test_tables_answer_sql(built, spark):
    store, _ = built
    store.register("silver", "stg_financials", partitioned=True)
    store.register("gold", "dim_companies")
    n = spark.sql("""SELECT count(*) AS n FROM silver.stg_financials f JOIN gold.dim_companies c USING (cik)
                     WHERE period_year = 1998""").first()["n"]
    assert n == store.read("silver", "stg_financials").filter("period_year = 1998").count() > 0


def test_wide_rows_are_written_in_small_groups(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    store.write(spark.range(0, 20, 1, 1), "bronze", "t", wide_rows=True)
    (part,) = (tmp_path / "bronze" / "t").glob("v-*/*.parquet")
    groups = pq.ParquetFile(part).metadata
    assert [groups.row_group(i).num_rows for i in range(groups.num_row_groups)] == [8, 8, 4]


def test_unknown_layer_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        LayerStore(spark, str(tmp_path)).path("platinum", "x")
