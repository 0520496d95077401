import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from factloom.operators import companies as co
from factloom.operators import coverage, quality
from factloom.operators.normalize import normalize_tag
from factloom.plans import gold
from factloom.sources import documents as docs


@pytest.fixture
def submissions(spark, tmp_path):
    base = {"name": "A", "sic": 3571, "sicDescription": "x", "stateOfIncorporation": "CA"}
    history = {"recent": {"accessionNumber": ["a1", "a2"], "filingDate": ["2020-01-01", "bad"], "form": ["10-K", "8-k"]}}
    items = [
        {**base, "cik": "320193", "tickers": ["AAPL", "X"], "exchanges": ["Nasdaq"], "filings": history},
        {**base, "cik": 7, "name": "B", "tickers": [], "exchanges": [], "filings": {"recent": {}}},
        {**base, "cik": 8, "name": "C", "tickers": None},
    ]
    for i, item in enumerate(items):
        (tmp_path / f"{i}.json").write_text(json.dumps(item, indent=2))
    return docs.raw_submissions(docs.read_submission_documents(spark, str(tmp_path)))


def test_company_rows(submissions):
    rows = {r["cik"]: r for r in co.companies(submissions).collect()}
    apple = rows["0000320193"]
    assert (apple["primary_ticker"], apple["primary_exchange"], apple["sic_code"]) == ("AAPL", "Nasdaq", "3571")
    assert rows["0000000007"]["primary_ticker"] is None and rows["0000000008"]["primary_ticker"] is None


def test_filing_history(submissions):
    rows = [tuple(r) for r in co.flatten_filings(submissions).orderBy("accession_number").collect()]
    assert rows == [("0000320193", "a1", "10-K", dt.date(2020, 1, 1)), ("0000320193", "a2", "8-K", None)]


def test_activity_flag(submissions):
    rows = co.companies(submissions)
    last = co.last_filing(co.flatten_filings(submissions))

    def active(as_of):
        dim = gold.dim_companies(rows, last, F.lit(as_of).cast("date"))
        return {r["cik"] for r in dim.filter("is_active").collect()}

    assert active("2021-07-01") == {"0000320193"}
    assert active("2021-07-02") == set()


def test_ticker_lookup(spark):
    directory = spark.createDataFrame([("AAPL", "1"), ("MSFT", "2")], "ticker string, cik string")
    asked = spark.createDataFrame([("aapl",), ("nope",)], "ticker string")
    assert [tuple(r) for r in co.ticker_lookup(asked, directory).collect()] == [("aapl", "1")]
    with pytest.raises(ValueError, match="nope"):
        co.require_known_tickers(asked, directory)


def periods(spark, *ends, concept="Revenues", cik="1"):
    rows = [(cik, concept, dt.date.fromisoformat(e)) for e in ends]
    return spark.createDataFrame(rows, "cik string, canonical_concept string, period_end date")


@pytest.mark.parametrize("ends,expected", [
    (["2020-03-31"], (1, 1, 0, False)),
    (["2020-03-31", "2020-12-31"], (2, 4, 2, True)),
    (["2020-03-31", "2020-04-01"], (2, 2, 0, False)),
    (["2020-03-30", "2020-03-31"], (2, 1, -1, False)),
    (["2020-03-31", "2020-03-31"], (1, 1, 0, False)),
])
def test_coverage(spark, ends, expected):
    row = coverage.filing_periods(periods(spark, *ends)).first()
    assert (row["actual_quarters"], row["expected_quarters"], row["missing_quarters"], row["has_gaps"]) == expected


def test_missing_quarters_and_gap_flags(spark):
    df = periods(spark, "2020-03-31", "2020-12-31").unionByName(periods(spark, "2020-06-30", concept="Assets"))
    df = df.unionByName(periods(spark, "2020-06-30", concept="Assets", cik="2"))
    assert sorted(r["q_idx"] % 4 for r in coverage.missing_quarters(df).collect()) == [2, 3]
    gaps = coverage.filing_periods(df).select("cik", "missing_quarters", "has_gaps")
    joined = df.join(gaps, "cik", "left")
    one_pass = gold.with_gap_flags(df).select(joined.columns)
    assert joined.exceptAll(one_pass).count() == 0 and one_pass.exceptAll(joined).count() == 0
    assert joined.filter("cik = '2'").first()["has_gaps"] is None


def test_normalize_is_idempotent_and_passes_unknown_tags(spark, seed):
    df = spark.createDataFrame([("SalesRevenueNet",), ("Odd",), (None,)], "raw_concept string")
    once = normalize_tag(seed)(df)
    assert {tuple(r) for r in once.collect()} == {("SalesRevenueNet", "Revenues"), ("Odd", "Odd"), (None, None)}
    again = normalize_tag(seed, "canonical_concept", "twice")(once)
    assert again.filter("NOT (twice <=> canonical_concept)").count() == 0


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", float("nan")), (None, -2.0), (None, None), ("b", float("inf"))], "k string, reported_value double")
    assert {tuple(r) for r in quality.not_null(df, ["k", "reported_value"]).collect()} == {
        ("k", 2), ("reported_value", 1)}
    assert [tuple(r) for r in quality.duplicates(df, ["k"]).collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.unaccepted_values(df, "k", ["a"]).collect()] == [("k", "b", 1)]
    parent = spark.createDataFrame([("b",)], "id string")
    assert [tuple(r) for r in quality.orphans(df, "k", parent, "id").collect()] == [("k", "a", 2)]
    assert quality.non_finite_values(df).count() == 2
    revenue = df.withColumn("canonical_concept", F.lit("Revenues"))
    assert quality.negative_revenue(revenue).count() == 1
    report = quality.report({"dup": quality.duplicates(df, ["k"]), "fine": df.limit(0)})
    assert {tuple(r) for r in report.collect()} == {("dup", 2, "fail"), ("fine", 0, "pass")}
    with pytest.raises(AssertionError, match="dup: 2"):
        quality.require_pass(report)


def test_freshness(spark):
    loads = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 2))], "src string, at timestamp")
    as_of = F.lit("2024-01-02 02:00:00").cast("timestamp")
    judged = quality.freshness(loads, ["src"], "at", as_of, 25)
    assert {r["src"]: r["is_stale"] for r in judged.collect()} == {"a": True, "b": False}
