"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then three times; the median counts. Results go to
the no-op sink, so every row is computed and none is collected. What queries store goes to a
folder that is removed afterwards.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from factloom import registry
from factloom.plans import warehouse
from factloom.session import build_session
from factloom.sources import tables
from factloom.sources.documents import fold_fact_documents
from factloom.sources.layers import LayerStore

HEADLINES = (
    "normalize_tag",
    "json_unnest_facts",
    "silver_from_documents",
    "latest_per_key",
    "silver_financials",
    "amendment_supersede",
    "coverage_gaps",
    "missing_quarters_list",
    "latest_load_per_company",
    "filings_flatten",
    "dim_companies",
    "fact_financials",
    "fact_star_join",
    "qoq_change",
    "yoy_same_quarter",
    "trailing_stats",
    "restatements",
    "anomaly_flags",
    "event_window_join",
    "overview_cards",
    "annual_rollup",
    "peer_benchmark",
    "dq_not_null",
    "dq_unique",
    "dq_report",
)


# Timed once each and reported apart, so that the total stays comparable between rounds.
EXTRAS = (
    "stream_latest_per_key",
    "stream_arrival_windows",
    "stream_dedup",
    "stream_refresh",
    "unreadable_concepts",
    "src_json_files",
    "merge_partitions",
    "ledger_summary",
    "stream_silence",
    "anomaly_page",
)


def whole_build(spark: SparkSession, folder: str, scratch: str) -> float:
    """Seconds to build every table from one indented document per file."""
    indented = F.regexp_replace("document", r"([{\[,])", "$1\n ")
    whole = fold_fact_documents(tables.filing_facts(spark, folder).withColumn("part", F.lit(0)))
    named = whole.select(F.col("cik").cast("int").alias("file"), indented.alias("value"))
    tables.put_files(spark, named, "file", f"{scratch}/facts", "text")
    texts = tables.submission_documents(spark, folder)
    texts = texts.withColumn("file", F.pmod(F.xxhash64("document"), F.lit(32)).cast("int"))
    lists = texts.groupBy("file").agg(F.array_join(F.collect_list("document"), ",\n").alias("l"))
    named = lists.select("file", F.concat(F.lit("["), "l", F.lit("]")).alias("value"))
    tables.put_files(spark, named, "file", f"{scratch}/submissions", "text")
    start = time.perf_counter()
    store = LayerStore(spark, f"{scratch}/tables")
    warehouse.build(spark, store, f"{scratch}/facts", f"{scratch}/submissions").collect()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        spark = build_session(
            "bench",
            master=f"local[{cpus}]",
            spark__sql__shuffle__partitions=cpus,
            spark__driver__memory="16g",
            spark__checkpoint__dir=f"file://{scratch}/shared",
            # One JVM for everything: the throughput collector suits batch work best.
            spark__driver__extraJavaOptions="-XX:+UseParallelGC",
        )
        spark.sparkContext.setLogLevel("ERROR")
        seconds, extras = {}, {}
        for name in names:
            runs = []
            for _ in range(4):
                start = time.perf_counter()
                registry.queries[name](spark, folder).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - start)
            seconds[name] = round(statistics.median(runs[1:]), 4)
        for name in () if sys.argv[1:] else EXTRAS:
            start = time.perf_counter()
            registry.queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            extras[name] = round(time.perf_counter() - start, 4)
        if not sys.argv[1:]:
            extras["warehouse_build"] = round(whole_build(spark, folder, scratch), 4)
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "extras": extras,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
