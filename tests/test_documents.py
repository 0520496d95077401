import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from factloom.operators import ingest
from factloom.operators.extract import (
    extract_entries, extracted_facts, read_entries, unnest_all, unnest_tracked, unreadable, usable_facts,
)
from factloom.params import ALL_UNITS, Params
from factloom.schemas import FACTS_DOCUMENT
from factloom.sources import documents as docs
from factloom.sources import seeds


def entry(**changes):
    base = {"val": 100.5, "start": "2020-01-01", "end": "2020-03-31", "accn": "a1",
            "form": "10-Q", "filed": "2020-05-01", "fp": "Q1"}
    return {k: v for k, v in {**base, **changes}.items() if v != "absent"}


def document(cik=77, gaap=None, **extra):
    facts = {"us-gaap": gaap} if gaap is not None else {}
    return {"cik": cik, "entityName": f"Example {cik}", "facts": facts, **extra}


def usd(*entries, unit="USD"):
    return {"units": {unit: list(entries)}}


@pytest.fixture
def land(tmp_path):
    def write(*documents, indent=None):
        for i, d in enumerate(documents):
            text = d if isinstance(d, str) else json.dumps(d, indent=indent)
            (tmp_path / f"{i:010d}.json").write_text(text)
        return str(tmp_path)

    return write


def bronze(spark, path):
    return docs.raw_company_facts(docs.read_fact_documents(spark, path))


def values(df):
    return sorted(r["reported_value"] for r in df.collect())


def test_indented_file_is_one_row_with_raw_facts(spark, land):
    path = land(document(320193, {"Assets": usd(entry(start="absent"))}), indent=2)
    row = bronze(spark, path).first()
    assert (row["cik_raw"], row["entity_name"]) == ("320193", "Example 320193")
    assert json.loads(row["facts_blob"])["us-gaap"]["Assets"]["units"]["USD"][0]["val"] == 100.5
    assert row["loaded_at"] is not None


def test_zero_padded_identifier_is_stored_unpadded(spark, land):
    assert bronze(spark, land(document("0000000077", {}))).first()["cik_raw"] == "77"


def test_entries_become_typed_rows(spark, land, seed):
    path = land(document(77, {
        "SalesRevenueNet": usd(entry()), "Assets": usd(entry(val=900, start="absent")),
        "Goodwill": usd(entry(val=1)),
    }))
    rows = {r["canonical_concept"]: r for r in extracted_facts(bronze(spark, path), seed).collect()}
    assert set(rows) == {"Revenues", "Assets"}
    revenue = rows["Revenues"]
    assert revenue["cik"] == "0000000077" and revenue["raw_concept"] == "SalesRevenueNet"
    assert revenue["period_end"] == dt.date(2020, 3, 31) and revenue["value_type"] == "duration"
    assert rows["Assets"]["value_type"] == "instant" and rows["Assets"]["period_start"] is None


def test_unusable_entries_are_dropped_and_odd_starts_kept(spark, land, seed):
    path = land(document(77, {"Assets": usd(
        entry(val="abc"), entry(end="2020-02-30"), entry(end="2020"), entry(end="2020-01-05 x"),
        entry(val="1.0d"), entry(form="absent"), entry(form=None), entry(form="8-k"),
        entry(form="8-K/A"), entry(val=None), entry(end="absent"),
        entry(val=1, start="x"), entry(val=2, start=None), entry(val="3"), entry(val=4, form="10-k"),
    )}))
    facts = extracted_facts(bronze(spark, path), seed)
    kept = {r["reported_value"]: r for r in facts.collect()}
    assert set(kept) == {1.0, 2.0, 3.0, 4.0}
    assert kept[1.0]["value_type"] == "duration" and kept[1.0]["period_start"] is None
    assert kept[2.0]["value_type"] == "instant"
    assert kept[4.0]["form_type"] == "10-K"


@pytest.mark.parametrize("facts", [{}, {"us-gaap": None}, {"us-gaap": {}}, {"dei": {"x": 1}}])
def test_documents_without_taxonomy_give_no_rows(spark, land, seed, facts):
    path = land({"cik": 1, "entityName": "E", "facts": facts})
    b = bronze(spark, path)
    assert unnest_all(b).count() == 0 and unnest_tracked(b, seed).count() == 0
    assert b.select(docs.concept_count("facts_blob").alias("n")).first()["n"] == 0


def test_concept_count(spark, land):
    path = land(document(1, {"Assets": usd(), "Goodwill": usd(), "A.b-c": usd()}))
    assert bronze(spark, path).select(docs.concept_count("facts_blob").alias("n")).first()["n"] == 3


def test_object_in_place_of_array_costs_that_concept_only(spark, land, seed):
    gaap = {"Assets": {"units": {"USD": entry()}}, "Revenues": usd(entry(val=5))}
    b = bronze(spark, land(document(1, gaap)))
    for rows in (unnest_all(b), unnest_tracked(b, seed)):
        assert [r["raw_concept"] for r in rows.collect()] == ["Revenues"]
    found = unreadable(read_entries(b, seed)).collect()
    assert [tuple(r) for r in found] == [("0000000001", "Assets", "USD", "unit is no array", 1)]


def test_each_damaged_part_costs_itself_alone_whatever_the_seed(spark, land, seed):
    """A concept, units, a unit, an entry that cannot be read, and a unit named twice."""
    good = json.dumps(entry(val=7))
    text = f"""{{"cik": 9, "entityName": "E", "facts": {{"us-gaap": {{
        "Assets": "text", "Revenues": {{"units": [1]}}, "ProfitLoss": {{"units": {{"USD": {{"val": 1}}}}}},
        "Liabilities": {{"units": {{"USD": [5, {good}, null]}}}},
        "NetIncomeLoss": {{"units": {{"USD": [{good}], "USD": [{good}]}}}},
        "StockholdersEquity": {{"units": {{"USD": [{good}]}}}}, "Goodwill": null}}}}}}"""
    b = bronze(spark, land(text, document(10, {"Assets": usd(entry(val=8))})))
    wide = spark.createDataFrame(
        [(f"Tag{i}", f"Tag{i}", "IS", "x") for i in range(2500)], seed.schema).unionByName(seed).unionByName(
        spark.createDataFrame([("Liabilities", "Liabilities", "BS", "x")], seed.schema))
    narrow = spark.createDataFrame([(t, t, "IS", "x") for t in (
        "Assets", "Revenues", "ProfitLoss", "Liabilities", "NetIncomeLoss", "StockholdersEquity")], seed.schema)
    expected = {("Assets", "10"), ("Liabilities", "9"), ("StockholdersEquity", "9")}
    reasons = {("Assets", None, "concept is no object", 1), ("Revenues", None, "units is no object", 1),
               ("ProfitLoss", "USD", "unit is no array", 1), ("Liabilities", "USD", "entry is no object", 2),
               ("NetIncomeLoss", "USD", "repeated unit", 2)}
    for tags in (None, wide.dropDuplicates(["synonym_tag"]), narrow):
        entries = read_entries(b, tags)
        kept = [(r["raw_concept"], r["cik"].lstrip("0")) for r in entries.filter("reason IS NULL").collect()]
        assert sorted(kept) == sorted(expected)
        assert {tuple(r)[1:] for r in unreadable(entries).collect()} == reasons


def test_units_are_chosen(spark, land, seed):
    gaap = {"EarningsPerShareBasic": usd(entry(val=1.1), unit="USD/shares"), "Assets": usd(entry(val=2))}
    b = bronze(spark, land(document(1, gaap)))
    assert values(extracted_facts(b, seed)) == [2.0]
    assert values(extracted_facts(b, seed, Params(units=ALL_UNITS))) == [1.1, 2.0]
    assert unnest_all(b, ("USD/shares",)).count() == 1


def test_tracked_parse_equals_full_parse_with_semi_join(spark, land, seed):
    gaap = {t: usd(entry(val=i), entry(val=i + 100)) for i, t in enumerate(
        ["Revenues", "ProfitLoss", "Goodwill", "Liabilities", "Inventory"])}
    b = bronze(spark, land(document(1, gaap), document(2, gaap)))
    from factloom.operators.normalize import tracked_only

    full = extract_entries(tracked_only(seed)(unnest_all(b)))
    fast = extract_entries(unnest_tracked(b, seed))
    assert fast.count() == 12
    assert full.exceptAll(fast).count() == 0 and fast.exceptAll(full).count() == 0


def test_empty_seed_gives_full_schema_and_no_rows(spark, land, seed):
    b = bronze(spark, land(document(1, {"Assets": usd(entry())})))
    empty = spark.createDataFrame([], seed.schema)
    facts = extracted_facts(b, empty)
    assert facts.count() == 0
    assert facts.columns == extracted_facts(b, seed).columns


def test_quarantine_takes_each_bad_document_once(spark, land):
    twice = '{"cik": 5, "entityName": "E", "facts": {"us-gaap": {"Assets": {}, "Assets": {}}}}'
    path = land(
        {"cik": 6, "facts": "text"}, {"cik": 7, "facts": {"us-gaap": [1]}},
        document(1, {"Assets": usd(entry())}), {"cik": 2, "entityName": "E"},
        '{"cik": 3, "entityName": "E", "facts": {"us-ga', document(4, {"Assets": usd(entry(accn="x" * 500))}),
        twice,
    )
    received = docs.read_fact_documents(spark, path)
    good, bad = docs.split_documents(received, Params(max_object_bytes=400))
    assert [r["cik"] for r in good.collect()] == ["1"]
    assert sorted(r["reason"] for r in bad.collect()) == [
        "facts is no object", "malformed", "missing facts", "repeated concept", "taxonomy is no object", "too large"]


def test_submissions_are_judged(spark, land):
    path = land({"cik": 1, "name": "A"}, '{"cik": 2, "na', {"name": "B"}, {"cik": "x", "name": "C"})
    judged = docs.judge_submissions(docs.read_submission_documents(spark, path))
    assert sorted((r["name"] or "", r["reason"] or "") for r in judged.collect()) == [
        ("", "malformed"), ("A", ""), ("B", "missing cik"), ("C", "missing cik")]


def test_fold_then_unnest_is_identity(spark, small):
    from factloom.registry import base

    facts = base.rows(spark, small)
    back = extract_entries(unnest_all(base.bronze_facts(spark, small), ALL_UNITS))
    original = facts.select(
        "cik", "entity_name", "raw_concept", "reported_value", "period_start", "period_end",
        "accession_number", F.upper("form_raw").alias("form_type"), "filed_date", "fiscal_period_label",
        F.expr("if(period_start IS NULL, 'instant', 'duration')").alias("value_type"),
    )
    assert back.exceptAll(original).count() == 0 and original.exceptAll(back).count() == 0


def test_seeds(spark, tmp_path):
    synonyms, tracked = seeds.synonyms(spark), seeds.tracked_companies(spark)
    assert synonyms.count() == 21 and synonyms.select("synonym_tag").distinct().count() == 21
    assert synonyms.select("canonical_tag").distinct().count() == 9
    assert tracked.count() == 52
    assert tracked.filter("ticker = 'AAPL'").first()["cik"] == "0000320193"
    path = tmp_path / "seed.csv"
    path.write_text("# a comment\ncanonical_tag,synonym_tag,statement_type,display_label\n"
                    "B,x,IS,Label B\nA,x,IS,Label A\nC,0001,BS,Label C\n")
    own = {r["synonym_tag"]: r["canonical_tag"] for r in seeds.synonyms(spark, str(path)).collect()}
    assert own == {"x": "A", "0001": "C"}


def test_refresh_candidates_from_landed_files(spark, tmp_path):
    as_of = dt.datetime(2024, 1, 2, 12)
    for cik, hours in (("0000000001", 1), ("0000000002", 7), ("0000000003", 6)):
        path = tmp_path / f"{cik}.json"
        path.write_text("{}")
        moment = (as_of - dt.timedelta(hours=hours)).replace(tzinfo=dt.timezone.utc).timestamp()
        os.utime(path, (moment, moment))
    tracked = spark.createDataFrame([(f"000000000{i}",) for i in range(1, 5)], "cik string")
    landed = docs.landed_files(spark, str(tmp_path))
    moment = F.lit("2024-01-02 12:00:00").cast("timestamp")
    due = ingest.refresh_candidates(tracked, landed, moment)
    assert sorted(r["cik"] for r in due.collect()) == ["0000000002", "0000000003", "0000000004"]
    assert ingest.refresh_candidates(tracked, landed, moment, force=True).count() == 4


def test_run_summary_and_gate(spark):
    rows = [("1", "A", "fetched", None), ("2", "B", "skipped", None), ("3", "C", "failed", "boom")]
    outcomes = spark.createDataFrame(rows, "cik string, ticker string, status string, error string")
    assert {tuple(r) for r in ingest.ingest_summary(outcomes).collect()} == {
        ("fetched", 1), ("skipped", 1), ("failed", 1)}
    with pytest.raises(RuntimeError, match="boom"):
        ingest.fail_on_any_failure(outcomes)
    ingest.fail_on_any_failure(outcomes.filter("status <> 'failed'"))


def test_usable_facts_keeps_columns(spark):
    df = spark.createDataFrame([(1.0, None, "10-Q")], "reported_value double, period_end date, form_type string")
    assert usable_facts(df).count() == 0 and usable_facts(df).columns == df.columns


def test_odd_tags_in_a_seed_are_quoted(spark, land, seed):
    tags = ["It's", "a`b", "x.y-z", "back\\slash"]
    odd = spark.createDataFrame([(t, t, "IS", t) for t in tags], seed.schema)
    b = bronze(spark, land(document(1, {t: usd(entry(val=i)) for i, t in enumerate(tags)})))
    found = {r["raw_concept"]: r["entry"]["val"] for r in unnest_tracked(b, odd).collect()}
    assert found == {t: str(i) for i, t in enumerate(tags)}


def test_every_part_of_a_filer_is_a_file_of_its_own(spark, medium):
    from factloom.registry import base, sources

    parts = base.rows(spark, medium).select("cik", "part").distinct().count()
    filers = base.rows(spark, medium).select("cik").distinct().count()
    read = docs.read_fact_documents(spark, sources.fact_files(spark, medium))
    assert read.select("source_path").distinct().count() == read.count() == parts > filers


def test_a_list_of_submissions_holds_a_bounded_number(spark, medium):
    from factloom.registry import sources

    read = docs.read_submission_documents(spark, sources.submission_files(spark, medium))
    sizes = [r["count"] for r in read.groupBy(F.input_file_name()).count().collect()]
    keys = spark.read.parquet(f"{medium}/customer.parquet").agg(F.max("c_custkey")).first()[0]
    assert max(sizes) <= sources.KEYS_PER_LIST < keys and len(sizes) >= keys // sources.KEYS_PER_LIST


def test_lists_of_submissions_follow_the_documents(spark, tmp_path):
    """Companies far apart, each in three loads: the files are as many as the loads, not a grid of both."""
    from factloom.registry import sources
    from factloom.sources.tables import KEYS_PER_SUBMISSION, SCHEMAS

    companies = [(k * 300, f"C{k}", k, 0.0, "BUILDING") for k in range(20)]
    day = dt.datetime(2024, 1, 1)
    orders = [
        (load * KEYS_PER_SUBMISSION + 2 * c[0], c[0], "O", 1.0, day, "2-HIGH") for c in companies for load in range(3)
    ]
    for name, told in (("customer", companies), ("orders", orders)):
        spark.createDataFrame(told, SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    read = docs.read_submission_documents(spark, sources.submission_files(spark, str(tmp_path)))
    found = docs.judge_submissions(read).select("cik", "status", "source_path").collect()
    assert len(found) == 60 and {r["status"] for r in found} == {"good"} and len({r["source_path"] for r in found}) == 3


def _bytes_read(spark):
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_a_whole_file_is_read_once(spark, tmp_path):
    """Numbers that become text are not fetched from the file again, one by one."""
    text = "[\n" + ",\n".join(f'{{"cik": {k},\n "sic": {k % 9}, "name": "N"}}' for k in range(3000)) + "\n]"
    (tmp_path / "list.json").write_text(text)
    before = _bytes_read(spark)
    read = docs.read_submission_documents(spark, str(tmp_path)).select("cik", "sic").collect()
    assert sorted(int(r["cik"]) for r in read) == list(range(3000))
    assert _bytes_read(spark) - before < 3 * len(text)


@pytest.mark.parametrize("text, found", [
    ('{"cik": 1.50,\n "entityName": "A",\n "facts": {"a" : [1e2,\n 007.0]}}', 1),
    ('\ufeff{"cik": 1,\r\n "facts": {}}\n\n', 1),
    ('[{"cik": 1},\n\n {"cik": 2}]', 2),
    ('{"cik": 1,\n "facts": {"us-gaap"', 1),
    ('{"cik": 1}\u0000\u0000\n{"cik": 2}', 1),
    ("\u0000" * 100, 1),
    (" \n ", 0),
    ("", 0),
])
def test_whole_files_as_in_multi_line_mode(spark, tmp_path, text, found):
    (tmp_path / "odd.json").write_bytes(text.encode())
    mine = docs.read_fact_documents(spark, str(tmp_path)).select(*FACTS_DOCUMENT.names).collect()
    spark_s = spark.read.schema(FACTS_DOCUMENT).option("multiLine", True).json(str(tmp_path)).collect()
    assert mine == spark_s and len(mine) == found


def test_files_of_facts_hold_several_parts(spark, medium, monkeypatch):
    from factloom.registry import base, sources

    found, read = [], docs.read_fact_documents
    monkeypatch.setattr(docs, "read_fact_documents", lambda *a: found.append(read(*a)) or found[-1])
    told = sources.src_json_files(spark, medium).agg(F.sum("entries")).first()[0]
    facts = base.rows(spark, medium)
    parts = facts.select("cik", "part").distinct().count()
    wide = facts.select("cik", F.floor(F.col("part") / sources.PARTS_PER_OBJECT)).distinct().count()
    assert told == facts.count()
    assert found[0].select("source_path").distinct().count() == found[0].count() == wide < parts


def test_an_entry_is_parsed_once(spark, land, seed):
    """A filter on its fields does not parse it again."""
    b = bronze(spark, land(document(1, {"Assets": usd(entry(), entry(val="x"), entry(form="8-K"), "no entry")})))
    found = extracted_facts(b, seed)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 1 and plan.count("entry_text#") and "StructField(form" in plan
    assert sum(line.count("StructField(form,") for line in plan.splitlines()) == 1
