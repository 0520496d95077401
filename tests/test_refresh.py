import json
import os

import pytest

from factloom.operators import ingest
from factloom.plans.refresh import facts_in_force, refresh_silver, silver_in_force
from factloom.sources.layers import LayerStore
from factloom.streaming.landing import land_changed, landed, newest_versions, read_ledger


def entry(value, end="2020-03-31", filed="2020-05-01", form="10-Q", accn="a"):
    return {"val": value, "start": "2020-01-01", "end": end, "accn": accn, "form": form, "filed": filed, "fp": "Q1"}


class Filings:
    """A folder of documents, landed and refreshed; times are given."""

    def __init__(self, spark, seed, root):
        self.spark, self.seed, self.root, self.clock = spark, seed, root, 1000
        self.bronze, self.store = str(root / "bronze"), LayerStore(spark, str(root / "tables"))
        (root / "in").mkdir()

    def put(self, name, *documents, damaged=()):
        lines = [json.dumps({"cik": c, "entityName": f"E{c}", "facts": {"us-gaap": {
            k: {"units": {"USD": v}} for k, v in concepts.items()}}}) for c, concepts in documents]
        file = self.root / "in" / f"{name}.json"
        file.write_text("\n".join([*lines, *damaged]) + "\n")
        self.clock += 10
        os.utime(file, (self.clock, self.clock))

    def land(self, **options):
        return land_changed(self.spark, str(self.root / "in"), self.bronze, multi_line=False, **options)

    def refresh(self):
        rows = refresh_silver(self.spark, self.store, self.bronze, self.seed, buckets=4).collect()
        return sorted((int(r["cik"]), r["canonical_concept"], str(r["period_end"]), r["reported_value"]) for r in rows)


@pytest.fixture
def filings(spark, seed, tmp_path):
    return Filings(spark, seed, tmp_path)


def test_removed_changed_and_new_facts_reach_silver(filings):
    filings.put("1", (1, {"Assets": [entry(5), entry(6, "2020-06-30")], "NetIncomeLoss": [entry(1)]}))
    filings.put("2", (2, {"Assets": [entry(7)]}))
    filings.land()
    before = filings.refresh()
    assert before == [(1, "Assets", "2020-03-31", 5.0), (1, "Assets", "2020-06-30", 6.0),
                      (1, "NetIncomeLoss", "2020-03-31", 1.0), (2, "Assets", "2020-03-31", 7.0)]
    # One fact is gone, one smaller and filed earlier than it was, one new, in another year.
    filings.put("1", (1, {"Assets": [entry(4, filed="2020-04-01"), entry(9, "2021-03-31")], "NetIncomeLoss": [entry(1)]}))
    filings.land()
    assert filings.refresh() == [(1, "Assets", "2020-03-31", 4.0), (1, "Assets", "2021-03-31", 9.0),
                                 (1, "NetIncomeLoss", "2020-03-31", 1.0), (2, "Assets", "2020-03-31", 7.0)]
    assert filings.refresh() == filings.refresh()


def test_an_older_filing_comes_back_when_the_newer_one_goes(filings):
    old, new = entry(5), entry(8, filed="2020-08-01", accn="b")
    filings.put("1", (1, {"Assets": [old]}))
    filings.put("1b", (1, {"Assets": [new]}))
    filings.land()
    assert filings.refresh() == [(1, "Assets", "2020-03-31", 8.0)]
    filings.put("1b", (1, {}))
    filings.land()
    assert filings.refresh() == [(1, "Assets", "2020-03-31", 5.0)]


def test_a_filer_that_a_file_no_longer_names_goes_but_a_damaged_one_stays(filings):
    filings.put("f", (1, {"Assets": [entry(1)]}), (2, {"Assets": [entry(2)]}), (3, {"Assets": [entry(3)]}))
    filings.land()
    filings.refresh()
    filings.put("f", (1, {"Assets": [entry(10)]}), damaged=['{"cik": 2, "entityName"'])
    filings.land()
    assert filings.refresh() == [(1, "Assets", "2020-03-31", 10.0), (2, "Assets", "2020-03-31", 2.0), (3, "Assets", "2020-03-31", 3.0)]
    filings.put("f", (1, {"Assets": [entry(11)]}), (3, {"Assets": [entry(3)]}))
    filings.land()
    assert filings.refresh() == [(1, "Assets", "2020-03-31", 11.0), (3, "Assets", "2020-03-31", 3.0)]
    filings.put("f", damaged=["{"])
    filings.land()
    assert filings.refresh() == [(1, "Assets", "2020-03-31", 11.0), (3, "Assets", "2020-03-31", 3.0)]


def test_a_file_that_passes_to_another_filer(filings):
    filings.put("f", (1, {"Assets": [entry(1)]}))
    filings.land()
    filings.refresh()
    filings.put("f", (77, {"Assets": [entry(2)]}))
    filings.land()
    assert filings.refresh() == [(77, "Assets", "2020-03-31", 2.0)]


def test_only_what_is_touched_is_written(filings, spark):
    filings.put("1", *[(c, {"Assets": [entry(c), entry(c, "2019-03-31")]}) for c in range(1, 40)])
    filings.put("2", (50, {"Assets": [entry(1)]}))
    filings.land()
    filings.refresh()
    facts, silver = facts_in_force(spark, filings.store), silver_in_force(spark, filings.store)
    parts, years = set(facts.paths()), set(silver.paths())
    assert len(parts) == 4 and len(years) == 2
    filings.put("2", (50, {"Assets": [entry(2)]}))
    filings.land()
    filings.refresh()
    assert len(parts & set(facts.paths())) == 3 and len(years & set(silver.paths())) == 1


def test_a_refresh_that_failed_between_the_tables_is_run_again(filings, spark, monkeypatch):
    from factloom.sources import partitions

    filings.put("1", (1, {"Assets": [entry(5)], "NetIncomeLoss": [entry(1)]}))
    filings.land()
    filings.refresh()
    filings.put("1", (1, {"Assets": [entry(6)]}))
    filings.land()
    merge = partitions.PartitionedTable.merge

    def lost(self, rows, keys, removed=None, **properties):
        if properties:
            raise RuntimeError("lost")
        return merge(self, rows, keys, removed, **properties)

    monkeypatch.setattr(partitions.PartitionedTable, "merge", lost)
    with pytest.raises(RuntimeError, match="lost"):
        filings.refresh()
    monkeypatch.undo()
    assert filings.refresh() == [(1, "Assets", "2020-03-31", 6.0)]
    assert facts_in_force(spark, filings.store).read().count() == 1


def test_several_landings_before_a_refresh(filings):
    for value in (1, 2, 3):
        filings.put("1", (1, {"Assets": [entry(value)]}))
        filings.land()
    assert filings.refresh() == [(1, "Assets", "2020-03-31", 3.0)]


def test_ledger_of_good_rejected_skipped_and_refreshed_files(filings, spark):
    filings.put("1", (1, {}))
    filings.put("2", damaged=['{"cik": 2'])
    filings.put("3", (3, {}), (3, {}))
    (filings.root / "in" / "4.json").write_text("\n")
    assert filings.land() == 4
    filings.put("1", (1, {"Assets": [entry(1)]}))
    assert filings.land() == 1
    assert filings.land() == 0
    rows = read_ledger(spark, filings.bronze).collect()
    found = sorted((r["run"], os.path.basename(r["source_path"]), r["cik_raw"], r["status"], r["error"], r["documents"]) for r in rows)
    assert found == [
        (0, "1.json", "1", "fetched", None, 1), (0, "2.json", None, "failed", "malformed", 1),
        (0, "3.json", "3", "fetched", None, 2), (0, "4.json", None, "failed", "no document", 0),
        (1, "1.json", "1", "fetched", None, 1), (1, "2.json", None, "skipped", "malformed", 1),
        (1, "3.json", "3", "skipped", None, 2), (1, "4.json", None, "skipped", "no document", 0),
        (2, "1.json", "1", "skipped", None, 1), (2, "2.json", None, "skipped", "malformed", 1),
        (2, "3.json", "3", "skipped", None, 2), (2, "4.json", None, "skipped", "no document", 0),
    ]
    tracked = spark.createDataFrame([("0000000001", "ONE"), ("0000000003", "THREE"), ("0000000009", "NINE")], "cik string, ticker string")
    first = ingest.run_outcomes(read_ledger(spark, filings.bronze).filter("run = 0"), tracked)
    assert sorted((r["cik"], r["ticker"], r["status"], r["error"]) for r in first.collect() if r["cik"]) == [
        ("0000000001", "ONE", "fetched", None), ("0000000003", "THREE", "fetched", None)]
    assert {r["status"]: r["companies"] for r in ingest.ingest_summary(first).collect()} == {"fetched": 2, "failed": 2}
    with pytest.raises(RuntimeError, match="2 companies failed"):
        ingest.fail_on_any_failure(first)
    last = ingest.run_outcomes(ingest.last_run(read_ledger(spark, filings.bronze)), tracked)
    ingest.fail_on_any_failure(last)
    landings = ingest.last_landings(read_ledger(spark, filings.bronze))
    due = ingest.refresh_candidates(tracked, landings, landings.agg({"landed_at": "max"}).first()[0])
    assert [r["cik"] for r in due.collect()] == ["0000000009"]


def test_a_batch_that_failed_lands_again(filings, spark, monkeypatch):
    from factloom.streaming import landing

    filings.put("1", (1, {}))
    note = landing._note
    monkeypatch.setattr(landing, "_note", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        filings.land()
    monkeypatch.setattr(landing, "_note", note)
    assert filings.land() == 1 and landed(spark, filings.bronze).count() == 1


def test_many_files_land_in_bounded_batches(filings, spark):
    for i in range(7):
        filings.put(str(i), (i, {}))
    assert filings.land(files_at_once=3) == 7
    ledger = read_ledger(spark, filings.bronze)
    assert sorted((r["run"], r["batch"], r["count"]) for r in ledger.groupBy("run", "batch").count().collect()) == [
        (0, 0, 3), (0, 1, 3), (0, 2, 1)]
    assert newest_versions(landed(spark, filings.bronze)).count() == 7
