import datetime as dt
import json
import os

from pyspark.sql import functions as F

from factloom.plans.silver import SILVER_COLUMNS, silver_financials
from factloom.registry import base
from factloom.streaming.landing import document_stream, land_changed, land_stream, landed, newest_versions
from factloom.streaming.latest import compact, current_table, keep_latest
from factloom.streaming.monitor import append_to, arrival_windows, count_arrivals, silences, suppress_repeats


def test_landing_takes_each_document_once(spark, tmp_path):
    inbox, root = tmp_path / "in", tmp_path / "out"
    inbox.mkdir()

    def arrive(cik, text=None):
        body = text or json.dumps({"cik": cik, "entityName": "E", "facts": {"us-gaap": {}}}, indent=1)
        (inbox / f"{cik}.json").write_text(body)

    def run():
        stream = document_stream(spark, str(inbox), files_per_trigger=1)
        land_stream(stream, f"{root}/bronze", f"{root}/ckpt").awaitTermination()
        return sorted(r["cik_raw"] for r in landed(spark, f"{root}/bronze").collect())

    arrive(1), arrive(2), arrive(3, '{"cik": 3')
    assert run() == ["1", "2"]
    assert run() == ["1", "2"]
    arrive(4)
    assert run() == ["1", "2", "4"]
    rejected = spark.read.parquet(f"{root}/bronze").filter("status = 'rejected'").collect()
    assert [r["reason"] for r in rejected] == ["malformed"]


def test_latest_table_over_many_batches_equals_batch(spark, small, tmp_path):
    facts = base.facts(spark, small)
    facts.repartition(5).write.parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema(facts.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        keep_latest(stream, str(tmp_path / "changes"), str(tmp_path / "ckpt")).awaitTermination()
        return current_table(spark, str(tmp_path / "changes"))

    def same(current, batch):
        columns = [*SILVER_COLUMNS, "normalized_value"]
        a, b = current.select(columns), batch.select(columns)
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    assert same(run(), silver_financials(facts))
    changes = tmp_path / "changes"
    assert len(list(changes.glob("log/batch_id=*"))) > 1
    last = compact(spark, str(changes))
    assert list(changes.glob("log/batch_id=*")) == [] and compact(spark, str(changes)) == last
    assert same(current_table(spark, str(changes)), silver_financials(facts))
    later = facts.withColumn("filed_date", F.date_add("filed_date", 1000)).withColumn(
        "reported_value", F.col("reported_value") + 1).limit(40)
    later.cache()
    later.write.mode("append").parquet(str(tmp_path / "in"))
    assert same(run(), silver_financials(facts.unionByName(later)))
    compact(spark, str(changes))
    assert [p.name for p in changes.glob("merged_to=*")] != [f"merged_to={last}"]
    assert len(list(changes.glob("merged_to=*"))) == 1 and list(changes.glob("log/batch_id=*")) == []
    assert same(current_table(spark, str(changes)), silver_financials(facts.unionByName(later)))


SCHEMA = "ts timestamp, kind string, id string"


def arrivals(spark, folder, *batches):
    """One file per batch, read one at a time in the order given."""
    for i, rows in enumerate(batches):
        path = folder / f"b{i}"
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.parquet(str(path))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", False)
    return stream.parquet(str(folder / "b*"))


def at(hour, minute=0, day=1):
    return dt.datetime(2024, 1, day, hour, minute)


def test_every_late_row_is_counted_and_no_window_is_left_out(spark, tmp_path):
    first = [(at(1), "a", "1"), (at(2), "a", "2")]
    second = [(at(12, day=3), "a", "3")]
    after = [(at(1), "a", f"late{i}") for i in range(50)] + [(at(14, day=3), "a", "5"), (at(11, 30, day=3), "a", "6")]
    last = [(at(1), "b", "late")] * 2
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    stream = arrivals(spark, tmp_path, first, second, after, last)
    count_arrivals(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), "ts", ["kind"]).awaitTermination()
    rows = {(r["window_start"].day, r["kind"]): (r["arrivals"], r["late"])
            for r in arrival_windows(spark, str(tmp_path / "out"), ["kind"]).collect()}
    assert rows == {(1, "a"): (52, 50), (3, "a"): (3, 0), (1, "b"): (2, 2)}


def test_replaced_files_land_again(spark, tmp_path):
    inbox, bronze = tmp_path / "in", str(tmp_path / "bronze")
    inbox.mkdir()

    def arrive(cik, concepts, moment):
        body = json.dumps({"cik": cik, "entityName": "E", "facts": {"us-gaap": dict.fromkeys(concepts, {})}}, indent=1)
        (inbox / f"{cik}.json").write_text(body)
        os.utime(inbox / f"{cik}.json", (moment, moment))

    arrive(1, "A", 1000), arrive(2, "A", 1000)
    assert land_changed(spark, str(inbox), bronze) == 2
    assert land_changed(spark, str(inbox), bronze) == 0
    arrive(1, "AB", 2000), arrive(3, "A", 2000)
    (inbox / "4.json").write_text('{"cik": 4')
    assert land_changed(spark, str(inbox), bronze) == 3
    good = landed(spark, bronze)
    assert sorted(r["cik_raw"] for r in good.collect()) == ["1", "1", "2", "3"]
    newest = {r["cik_raw"]: r["facts_blob"] for r in newest_versions(good).collect()}
    assert sorted(newest) == ["1", "2", "3"] and '"B"' in newest["1"]
    rejected = spark.read.parquet(bronze).filter("status = 'rejected'").collect()
    assert [r["reason"] for r in rejected] == ["malformed"]


def test_a_source_that_falls_silent_is_a_row(spark, tmp_path):
    first = [(at(1), "a", "1"), (at(20), "a", "2"), (at(1), "b", "3")]
    # b comes back after 26 hours, a goes on and stops, c keeps all moving.
    second = [(at(3, day=2), "b", "4"), (at(10, day=2), "a", "5"), (at(4, day=3), "c", "6")]
    third = [(at(2, day=4), "c", "7"), (at(1, day=5), "c", "8")]
    stream = arrivals(spark, tmp_path, first, second, third)
    append_to(silences(stream, "ts", ["kind"]), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["kind"], r["first_seen"], r["last_seen"], r["arrivals"], r["overdue_at"]) for r in rows) == [
        ("a", at(1), at(10, day=2), 3, at(11, day=3)), ("b", at(1), at(1), 1, at(2, day=2)),
        ("b", at(3, day=2), at(3, day=2), 1, at(4, day=3))]


def test_repeated_deliveries_are_suppressed_across_batches(spark, tmp_path):
    batch = [(at(1), "a", "1"), (at(2), "a", "2"), (at(1), "a", "1")]
    stream = arrivals(spark, tmp_path, batch, batch, [(at(3), "a", "3")])
    unique = suppress_repeats(stream, "ts", ["id"])
    append_to(unique, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2", "3"]


def test_refreshed_files_hold_a_bounded_number_of_documents(spark, medium, monkeypatch):
    from factloom.registry import base, streams

    held, put = [], streams.put_files

    def noted(spark, df, name, *rest):
        held.append([r["count"] for r in df.groupBy(name).count().collect()])
        put(spark, df, name, *rest)

    monkeypatch.setattr(streams, "put_files", noted)
    assert streams.stream_versions(spark, medium).count() > 0
    rows = base.rows(spark, medium)
    filers, parts = (rows.select(c).distinct().count() for c in ("cik", "part"))
    assert len(held) == 2
    for sizes in held:
        assert max(sizes) <= filers * streams.PARTS_PER_FILE and len(sizes) * streams.PARTS_PER_FILE >= parts
    held.clear()
    assert streams.stream_refresh(spark, medium).count() > 0
    assert len(held) == 2 and max(map(max, held)) <= filers * streams.PARTS_PER_FILE
