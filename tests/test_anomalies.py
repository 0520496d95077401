import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from factloom.operators.ordered import lag_in_chunks
from factloom.params import Params
from factloom.plans import anomalies, reports

SCHEMA = (
    "cik string, canonical_concept string, period_end date, reported_value double, "
    "accession_number string, period_start date, value_type string, period_year int, calendar_quarter int"
)
ENDS = {1: (3, 31), 2: (6, 30), 3: (9, 30), 4: (12, 31)}


@pytest.fixture
def silver(spark):
    def make(concept, series, cik="1", shift=0):
        """series: {(year, quarter): value}"""
        rows = []
        for (year, quarter), value in series.items():
            end = dt.date(year, *ENDS[quarter]) - dt.timedelta(days=shift)
            start = dt.date(year, 3 * quarter - 2, 1)
            rows.append((cik, concept, end, float(value), f"{year}{quarter}", start, "duration", year, quarter))
        return spark.createDataFrame(rows, SCHEMA)

    return make


def quarters(values, year=2018):
    return {(year + i // 4, i % 4 + 1): v for i, v in enumerate(values) if v is not None}


def column(df, name):
    return [r[name] for r in df.orderBy("period_end").collect()]


def test_change_needs_the_adjacent_quarter(silver):
    df = anomalies.qoq_change(silver("Assets", quarters([100, 150, None, 300, 0, 5])))
    assert column(df, "qoq") == [None, 0.5, None, -1.0, None]


def test_year_over_year_looks_up_the_quarter_not_the_row(silver):
    df = anomalies.yoy_change(silver("Revenues", quarters([100, 110, None, 130, 150, 160, 170])))
    assert column(df, "prior_year_value") == [None, None, None, 100.0, 110.0, None]
    assert column(df, "yoy")[3] == 0.5


def test_two_ends_in_one_quarter_compare_with_the_later(silver):
    old = silver("Revenues", {(2018, 1): 10}).unionByName(silver("Revenues", {(2018, 1): 5}, shift=20))
    df = anomalies.yoy_change(old.unionByName(silver("Revenues", {(2019, 1): 20})))
    assert column(df, "prior_year_value")[-1] == 10.0


def test_trailing_window_excludes_the_row_and_must_be_full(silver):
    values = [1, 4, 2, 8, 5, 7, 3, 6, 9, 2]
    df = anomalies.trailing_stats(silver("EarningsPerShareBasic", quarters(values)))
    means, devs = column(df, "trailing_mean"), column(df, "trailing_stddev")
    assert means[:8] == [None] * 8
    assert means[8] == pytest.approx(statistics.mean(values[:8]))
    assert devs[9] == pytest.approx(statistics.pstdev(values[1:9]))


def fired(df, *rules):
    return {(str(r["period_end"]), r["rule"]): r for r in anomalies.fired_rules(df, list(rules)).collect()}


def test_revenue_spike_and_its_seasonal_exception(silver):
    flat = fired(silver("Revenues", quarters([100, 100, 100, 140])), anomalies.revenue_spike())
    assert [k[0] for k in flat] == ["2018-12-31"]
    row = next(iter(flat.values()))
    assert row["observed"] == pytest.approx(0.4) and row["severity"] == pytest.approx(0.4 / 0.3)
    seasonal = quarters([100, 100, 100, 140, 100, 100, 100, 150])
    assert set(fired(silver("Revenues", seasonal), anomalies.revenue_spike())) == {
        ("2018-12-31", "revenue_spike")}
    opposite = quarters([100, 100, 100, 140, 140, 140, 140, 70])
    assert ("2019-12-31", "revenue_spike") in fired(
        silver("Revenues", opposite), anomalies.revenue_spike())


def test_sign_flip_needs_revenue_that_did_not_fall(silver):
    income = silver("NetIncomeLoss", quarters([10, -5, 5, -5]))
    revenue = silver("Revenues", quarters([100, 90, 95]))
    hits = fired(income.unionByName(revenue), anomalies.income_sign_flip())
    assert {k[0] for k in hits} == {"2018-09-30", "2018-12-31"}


def test_eps_drop(silver):
    rule = anomalies.eps_drop()
    eps = "EarningsPerShareBasic"
    assert not fired(silver(eps, quarters([1, 2, 1, 2, 1, 2, 1, -50])), rule)
    hits = fired(silver(eps, quarters([1, 2, 1, 2, 1, 2, 1, 2, -50])), rule)
    assert len(hits) == 1 and next(iter(hits.values()))["severity"] == pytest.approx((1.5 + 50) / 0.5 / 2)
    assert not fired(silver(eps, quarters([1, 2, 1, 2, 1, 2, 1, 2, 50])), rule)


def test_asset_jump_threshold_is_exclusive(silver):
    hits = fired(silver("Assets", quarters([100, 140, 100, 141])), anomalies.asset_jump())
    assert {k[0] for k in hits} == {"2018-12-31"}


def test_quarterly_only_leaves_out_long_spans(silver, spark):
    year = silver("Revenues", {(2018, 4): 400}).withColumn("period_start", F.lit("2018-01-01").cast("date"))
    df = silver("Revenues", quarters([100, 100, 100])).unionByName(year)
    assert fired(df, anomalies.revenue_spike())
    assert anomalies.fired_rules(df, [anomalies.revenue_spike()], Params(quarterly_only=True)).count() == 0


def history(spark, n=3000, hot=0.5, seed=5):
    """Filings of few keys, one of which holds half of them; some days hold many filings."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot else f"k{rng.randrange(20)}"
        filed = None if rng.random() < 0.02 else dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(30))
        rows.append((key, "Revenues", "Revenues", None, dt.date(2019, 12, 31), filed, f"a{i:05d}",
                     rng.choice(["10-K", "10-K/A"]), float(rng.randrange(1, 50))))
    return spark.createDataFrame(
        rows, "cik string, canonical_concept string, raw_concept string, period_start date, "
        "period_end date, filed_date date, accession_number string, form_type string, reported_value double")


def test_lag_in_chunks_equals_plain_lag(spark):
    df = history(spark)
    chunked = lag_in_chunks(df, ["cik"], ["filed_date"], ["accession_number"], ["reported_value", "filed_date"])
    w = Window.partitionBy("cik").orderBy("filed_date", "accession_number")
    plain = df.withColumns({f"prev_{c}": F.lag(c).over(w) for c in ("reported_value", "filed_date")})
    assert chunked.count() == df.count()
    plain = plain.select(chunked.columns)
    assert chunked.exceptAll(plain).count() == 0 and plain.exceptAll(chunked).count() == 0


def test_restatements_against_brute_force_and_repeated_loads(spark):
    df = history(spark, 800)
    expected = set()
    by_key = {}
    for r in sorted(df.collect(), key=lambda r: (r["cik"], r["filed_date"] or dt.date.min, r["accession_number"])):
        old = by_key.get(r["cik"])
        if old is not None and r["form_type"].endswith("/A") and abs(r["reported_value"] - old) / abs(old) > 0.1:
            expected.add(r["accession_number"])
        by_key[r["cik"]] = r["reported_value"]
    for loaded in (df, df.unionByName(df).unionByName(df)):
        found = [r["accession_number"] for r in anomalies.restatements(loaded).collect()]
        assert len(found) == len(set(found)) and set(found) == expected


def test_flags_hold_one_row_per_record_and_rule(spark, small):
    from factloom.registry import base

    flags = anomalies.anomaly_flags(base.silver(spark, small), base.facts(spark, small))
    counts = {r["rule"]: r["count"] for r in flags.groupBy("rule").count().collect()}
    assert (counts["revenue_spike"], counts["income_sign_flip"], counts["asset_jump"]) == (125, 25, 56)
    assert flags.groupBy("cik", "canonical_concept", "period_end", "rule").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("days", [30, 90, 200])
def test_events_near_anomalies_against_brute_force(spark, days):
    rng = random.Random(days)
    first = dt.date(2020, 1, 1)
    flags = [(str(rng.randrange(3)), f"c{i}", first + dt.timedelta(days=rng.randrange(900)), "r") for i in range(60)]
    events = [("0" if rng.random() < 0.5 else str(rng.randrange(3)), first + dt.timedelta(days=rng.randrange(1200)))
              for _ in range(300)]
    f = spark.createDataFrame(flags, "cik string, canonical_concept string, period_end date, rule string")
    f = f.withColumn("q_idx", F.expr("year(period_end) * 4 + quarter(period_end)"))
    e = spark.createDataFrame(events, "cik string, event_date date")
    found = {(r["cik"], r["canonical_concept"]): (r["events"], r["first_event"], r["last_event"])
             for r in anomalies.events_near_anomalies(f, e, Params(event_window_days=days)).collect()}
    expected = {}
    for cik, concept, end, _ in flags:
        near = [d for c, d in events if c == cik and end <= d <= end + dt.timedelta(days=days)]
        if near:
            expected[(cik, concept)] = (len(near), min(near), max(near))
    assert found == expected


def test_feed_filters_orders_and_limits(spark):
    rows = [("1", "Assets", 1, "x", "r", 2.0), ("1", "Assets", 2, "y", "r", None), ("2", "Assets", 1, "z", "r", 3.0)]
    flags = spark.createDataFrame(rows, "cik string, canonical_concept string, q_idx int, accession_number string, "
                                  "rule string, severity double").withColumn("period_end", F.col("q_idx"))
    assert [r["filing_link"] for r in anomalies.anomaly_feed(flags).collect()] == [
        "filings/2/z", "filings/1/x", "filings/1/y"]
    assert anomalies.anomaly_feed(flags, cik="1", quarter=2).count() == 1
    assert anomalies.anomaly_feed(flags, top=1).first()["cik"] == "2"


def test_reports_on_a_known_company(silver):
    revenue = silver("Revenues", quarters([100, 120, 110, 130, 200]))
    income = silver("NetIncomeLoss", quarters([10, -12, None, 13, 50]))
    both = revenue.unionByName(income)
    card = reports.overview_cards(both).first()
    assert (card["revenue"], card["net_income"], card["eps"]) == (200.0, 50.0, None)
    annual = {(r["canonical_concept"], r["period_year"]): r["annual_value"]
              for r in reports.annual_rollup(both).collect()}
    assert annual == {("Revenues", 2018): 460.0}
    balance = both.withColumn("value_type", F.lit("instant"))
    assert {r["annual_value"] for r in reports.annual_rollup(balance).collect()} == {130.0}
    margins = [r["margin"] for r in reports.margin_trend(both).orderBy("q_idx").collect()]
    assert margins == [0.1, -0.1, 0.1, 0.25]
    growth = [r["growth_index"] for r in reports.growth_index(both).orderBy("period_end").collect()]
    assert growth == pytest.approx([100, 120, 110, 130, 200])
    line = reports.sparkline(revenue, 3).first()["points"]
    assert [p["reported_value"] for p in line] == [110.0, 130.0, 200.0]
    pairs = {r["q_idx"] % 4: r for r in reports.income_vs_revenue(both).filter("q_idx < 2018 * 4 + 5").collect()}
    assert pairs[0]["income_qoq"] is None and pairs[0]["revenue_qoq"] == pytest.approx(20 / 110)


def test_a_hot_day_of_one_key_is_split_by_ranges(spark):
    """One key with a third of all filings, most on one day and without a date: same lag, small chunks."""
    chance = random.Random(6)
    rows, day = [], dt.date(2020, 5, 1)
    for i in range(3000):
        key = "0000000001" if i % 3 == 0 else f"{i % 50:010d}"
        filed = None if i % 11 == 0 else day + dt.timedelta(days=0 if i % 3 == 0 and i % 5 else i % 40)
        number = f"{chance.randrange(10**10):010d}-20-{i:06d}"
        row = (key, "Assets", "Assets", None, dt.date(2020, 3, 31), filed, number, chance.choice(["10-Q", "10-Q/A"]), float(chance.randrange(1, 9)))
        rows += [row] * chance.choice([1, 1, 2])
    names = "cik string, canonical_concept string, raw_concept string, period_start date, period_end date, filed_date date, accession_number string, form_type string, reported_value double"
    facts = spark.createDataFrame(rows, names).repartition(5)
    plain = anomalies.restatements(facts)
    split = anomalies.restatements(facts, hot_key=100, hot_day=50)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect())) and plain.count() > 300
    history = facts.selectExpr(*anomalies._HISTORY_KEY, "filed_date", "'' AS series", *anomalies._HISTORY_ORDER).distinct()
    chunks = anomalies._split_hot_days(history, 100, 50).groupBy("cik", "filed_date", "series").count()
    assert history.groupBy("cik", "filed_date").count().agg({"count": "max"}).first()[0] > 500
    assert chunks.agg({"count": "max"}).first()[0] < 150
    order = Window.partitionBy("cik").orderBy(F.col("filed_date").asc_nulls_first(), "accession_number", "form_type", "reported_value")
    lagged = history.withColumn("prev", F.lag("reported_value").over(order))
    wanted = lagged.filter("form_type LIKE '%/A' AND abs((reported_value - prev) / abs(prev)) > 0.1")
    assert wanted.count() == split.count()
