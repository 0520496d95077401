import datetime as dt
import random

import pytest

from factloom.operators import dedup
from factloom.plans.silver import SILVER_COLUMNS, silver_financials, silver_stepwise

SCHEMA = (
    "cik string, entity_name string, raw_concept string, reported_value double, period_start date, "
    "period_end date, accession_number string, form_type string, filed_date date, "
    "fiscal_period_label string, value_type string, canonical_concept string"
)


def fact(value, form="10-Q", filed="2020-05-01", accn="a1", end="2020-03-31", fp="Q1", cik="1",
         concept="Revenues", start="2020-01-01", raw=None):
    day = dt.date.fromisoformat
    return (cik, "E", raw or concept, float(value), day(start) if start else None, day(end), accn, form,
            day(filed) if filed else None, fp, "duration", concept)


@pytest.fixture
def facts(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def values(df):
    return sorted(r["reported_value"] for r in df.collect())


def test_latest_filing_wins(facts):
    df = facts(fact(1, filed="2020-05-01"), fact(2, filed="2020-06-01"), fact(3, filed=None))
    assert values(dedup.latest_per_key(df)) == [2.0]


def test_equal_dates_are_decided_by_accession(facts):
    df = facts(fact(1, accn="a2"), fact(2, accn="a1"))
    assert values(dedup.latest_per_key(df)) == [1.0]


def test_periods_of_different_length_collapse_unless_asked(facts):
    df = facts(fact(1, start="2020-07-01", end="2020-09-30"),
               fact(2, start="2020-01-01", end="2020-09-30", accn="a2"))
    assert values(dedup.latest_per_key(df)) == [2.0]
    assert values(dedup.latest_per_key(df, include_start=True)) == [1.0, 2.0]


def test_amendment_by_the_rules_and_by_intent(facts):
    df = facts(fact(1, "10-K", "2021-02-01", "a1", "2020-12-31", "FY"),
               fact(2, "10-K/A", "2021-06-01", "a2", "2020-12-31", "FY"))
    resolved = silver_financials(df).first()
    assert (resolved["reported_value"], resolved["normalized_value"]) == (1.0, 2.0)
    assert values(dedup.amendment_supersede(df)) == [2.0]


@pytest.mark.parametrize("end,expected", [("2020-03-31", 1.0), ("2020-12-31", 2.0)])
def test_form_preference_by_quarter(facts, end, expected):
    df = facts(fact(1, "10-Q", end=end), fact(2, "10-K", end=end, filed="2020-04-01"))
    assert values(dedup.prefer_form(df)) == [expected]
    assert values(silver_financials(df)) == [expected]


def test_full_year_in_another_quarter_ties_with_quarterly(facts):
    df = facts(fact(1, "10-Q", filed="2020-11-01", end="2020-09-30"),
               fact(2, "10-K", filed="2020-12-01", end="2020-09-30", fp="FY"))
    assert values(silver_financials(df)) == [2.0]


def test_only_the_latest_annual_row_counts_for_its_label(facts):
    rows = [fact(1, "10-K", "2020-05-01", "a1", fp="FY"), fact(2, "10-K", "2020-06-01", "a2", fp="Q1"),
            fact(3, "20-F", "2020-07-01", "a3")]
    assert values(silver_stepwise(facts(*rows))) == values(silver_financials(facts(*rows))) == [3.0]


def test_one_aggregation_equals_both_steps_on_random_filings(facts):
    rng = random.Random(7)
    forms = ["10-Q", "10-K", "10-Q/A", "10-K/A", "20-F", "10-KT", "20-F/A"]
    rows = [
        fact(i, rng.choice(forms), rng.choice(["2020-05-01", "2020-06-01", None, "2020-07-01"]),
             f"a{rng.randrange(500)}", rng.choice(["2020-03-31", "2020-09-30", "2020-12-31"]),
             rng.choice(["FY", "Q1", None]), str(rng.randrange(15)), rng.choice(["Revenues", "Assets"]))
        for i in range(1500)
    ]
    df = facts(*rows)
    fused, steps = silver_financials(df).select(*SILVER_COLUMNS), silver_stepwise(df)
    assert steps.count() > 50
    assert fused.exceptAll(steps).count() == 0 and steps.exceptAll(fused).count() == 0
    assert fused.groupBy(*dedup.PERIOD_KEY).count().filter("count > 1").count() == 0
    assert steps.drop("calendar_quarter", "period_year").exceptAll(
        df.select(*steps.drop("calendar_quarter", "period_year").columns)).count() == 0


def test_restated_value_equals_the_superseding_row(facts):
    rng = random.Random(11)
    rows = [
        fact(i, rng.choice(["10-Q", "10-K", "10-Q/A", "10-K/A", "20-F", "20-F/A"]),
             f"2020-0{rng.randrange(1, 9)}-01", f"a{i:04d}",
             rng.choice(["2020-03-31", "2020-12-31"]), rng.choice(["FY", "Q1"]), str(rng.randrange(40)))
        for i in range(600)
    ]
    df = facts(*rows)
    superseded = {
        (r["cik"], r["period_end"], r["base_form"]): r["reported_value"]
        for r in dedup.amendment_supersede(df).collect()
    }
    for r in silver_financials(df).collect():
        base = r["form_type"].removesuffix("/A")
        assert r["normalized_value"] == superseded[(r["cik"], r["period_end"], base)] or base == "20-F"
        if base == "20-F":
            assert r["normalized_value"] == r["reported_value"] == superseded[
                (r["cik"], r["period_end"], base)]


def test_latest_load_per_company(spark):
    rows = [("7", "old", dt.datetime(2024, 1, 1)), ("7", "new", dt.datetime(2024, 1, 2)),
            ("8", "only", None)]
    raw = spark.createDataFrame(rows, "cik_raw string, company_name_raw string, loaded_at timestamp")
    assert sorted(r["company_name_raw"] for r in dedup.latest_load_per_company(raw).collect()) == [
        "new", "only"]
