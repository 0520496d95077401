"""The physical plans that the design relies on."""

import pytest

from factloom import registry
from factloom.operators import dedup
from factloom.operators.extract import extracted_facts, read_entries, unnest_all, unnest_tracked, unreadable
from factloom.plans import anomalies
from factloom.registry import base


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return text.count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def stored_facts(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("facts") / "t")
    base.facts(spark, small).write.parquet(path)
    return spark.read.parquet(path)


def test_resolving_takes_one_exchange_after_map_side_maxima(stored_facts):
    text = plan(dedup.resolve_filings(stored_facts))
    assert exchanges(text) == 1 and "partial_max" in text


def test_dedup_limits_groups_before_the_shuffle(stored_facts):
    text = plan(dedup.latest_per_key(stored_facts))
    assert text.count("WindowGroupLimit") == 2 and exchanges(text) == 1


def test_all_rules_share_one_exchange_by_company(spark, small, tmp_path):
    path = str(tmp_path / "silver")
    base.silver(spark, small).write.parquet(path)
    text = plan(anomalies.fired_rules(spark.read.parquet(path), anomalies.silver_rules()))
    assert exchanges(text) == 1 and "Join" not in text


def test_seed_lookup_is_a_broadcast_join(spark, small):
    assert "BroadcastHashJoin" in plan(base.facts(spark, small))


def test_document_text_is_parsed_once(spark, seed):
    bronze = spark.createDataFrame(
        [("1", "E", "{}")], "cik_raw string, entity_name string, facts_blob string"
    )
    for df in (unnest_all(bronze), unnest_tracked(bronze, seed), extracted_facts(bronze, seed),
               unreadable(read_entries(bronze, seed))):
        text = plan(df)
        assert text.count("from_json(StructField(us-gaap") == 1 and text.count("get_json_object") == 0


@pytest.mark.parametrize("name", ["filings_flatten", "latest_load_per_company"])
def test_submissions_are_parsed_once_per_level(spark, small, name):
    assert plan(registry.queries[name](spark, small)).count("from_json") <= 2


def test_scans_read_only_the_columns_they_need(spark, small):
    text = plan(registry.queries["dq_unique"](spark, small))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_top_of_the_feed_is_no_global_sort(spark, small, tmp_path):
    path = str(tmp_path / "flags")
    registry.queries["anomaly_flags"](spark, small).write.parquet(path)
    assert "TakeOrderedAndProject" in plan(anomalies.anomaly_feed(spark.read.parquet(path), top=10))


def final_plan(df):
    """The adaptive plan that ran."""
    df.collect()
    return plan(df)


def test_flags_and_events_read_what_they_share_once(spark, small):
    for name in ("anomaly_flags", "event_window_join"):
        text = final_plan(registry.queries[name](spark, small))
        assert "orders.parquet" not in text  # read once, into the stored relation


def test_restatements_shuffle_all_rows_once(stored_facts):
    text = final_plan(anomalies.restatements(stored_facts)).split("== Initial Plan ==")[0]
    # All rows by (key, date); then one row per date by key, on either branch of the union.
    assert text.count("REPARTITION_BY_COL") == 1 or "ReusedExchange" in text
    assert "partial" not in text.split("REPARTITION_BY_COL")[1].split("Scan parquet")[0]


@pytest.mark.parametrize("name", ["anomaly_asset_jump", "anomaly_sign_flip", "overview_cards", "margin_trend"])
def test_unneeded_concepts_go_before_the_shuffle(spark, small, name):
    text = plan(registry.queries[name](spark, small))
    below = text[text.index("Exchange hashpartitioning"):]
    assert "coalesce(_canonical" in below and " IN (" in below or "= Assets" in below


BATCH = sorted(n for n in registry.queries if not n.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_query_crosses_or_nests_loops(spark, small, name):
    text = plan(registry.queries[name](spark, small))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "PythonUDF" not in text
