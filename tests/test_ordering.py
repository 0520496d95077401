import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from factloom.operators.ordering import clustered, gray_rank, page, ranked, z_value
from factloom.operators.selection import exact_quantile
from factloom.params import Params
from factloom.plans import anomalies, reports
from factloom.registry import base
from factloom.sources.layers import LayerStore


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_are_those_of_a_sort(spark):
    chance = random.Random(1)
    rows = [(chance.choice([None, 1.5, 2.5, 7.0]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "v double, id int").repartition(6)
    ranks = ranked(df, [F.col("v").desc_nulls_last(), F.col("id")], parts=7)
    wanted = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r["v"], r["id"]) for r in ranks.orderBy("rank").collect()] == wanted
    assert sorted(r["rank"] for r in ranks.collect()) == list(range(1, 3001))
    assert "SinglePartition" not in plan(ranks) and "Window" not in plan(ranks)
    assert [r["id"] for r in page(ranks, 3, 10).orderBy("rank").collect()] == [r[1] for r in wanted[20:30]]
    assert page(ranks, 301, 10).isEmpty() and ranked(df.limit(0), [F.col("id")]).isEmpty()


def test_interleaved_bits(spark):
    row = spark.range(1).select(z_value([F.lit(0b101), F.lit(0b010), F.lit(0b111)], 3).alias("z")).first()
    assert row["z"] == 0b101_011_101
    places = {r["id"]: r["g"] for r in spark.range(64).select("id", gray_rank(F.col("id")).alias("g")).collect()}
    path = sorted(places, key=places.get)
    assert sorted(places.values()) == list(range(64)) and all((a ^ b).bit_count() == 1 for a, b in zip(path, path[1:]))


@pytest.fixture(scope="module")
def flags_file(spark, tmp_path_factory):
    """A clustered table in one file with small row groups."""
    chance = random.Random(4)
    rows = [(f"{chance.randrange(400):010d}", f"C{chance.randrange(30)}", chance.randrange(8000, 8080), i) for i in range(20_000)]
    rows += [(None, "C1", 8000, -1), ("0000000001", None, None, -2)]
    df = spark.createDataFrame(rows, "cik string, canonical_concept string, q_idx int, id int")
    path = str(tmp_path_factory.mktemp("z") / "flags")
    options = {"parquet.block.row.count.limit": "200", "parquet.page.size.row.check.min": "1"}
    clustered(df, ["cik", "canonical_concept", "q_idx"], parts=1).write.options(**options).parquet(path)
    return df, path


def test_clustering_keeps_all_rows(spark, flags_file):
    df, path = flags_file
    stored = spark.read.parquet(path)
    assert stored.columns == df.columns and stored.exceptAll(df).isEmpty() and df.exceptAll(stored).isEmpty()


def row_groups(path, column):
    """(smallest, largest) value of the column in each row group, by its statistics."""
    for file in glob.glob(f"{path}/part-*"):
        meta = pq.ParquetFile(file).metadata
        place = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(place).statistics
            yield (stats.min, stats.max) if stats.has_min_max else (None, None)


@pytest.mark.parametrize("column", ["cik", "canonical_concept", "q_idx"])
def test_filters_on_any_column_skip_most_row_groups(spark, flags_file, tmp_path, column):
    """The share of row groups that a filter on one value reads, on average over all values."""
    df, path = flags_file
    df.coalesce(1).write.option("parquet.block.row.count.limit", "200").option(
        "parquet.page.size.row.check.min", "1").parquet(str(tmp_path / "plain"))
    values = [r[0] for r in df.select(column).distinct().collect() if r[0] is not None]

    def share(folder):
        groups = list(row_groups(folder, column))
        assert len(groups) >= 90
        read = sum(low is not None and low <= v <= high for v in values for low, high in groups)
        return read / len(groups) / len(values)

    assert share(path) < 0.35 < 0.9 < share(str(tmp_path / "plain"))


def brute(values, q):
    values = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
    import math

    return values[max(1, math.ceil(len(values) * q)) - 1] if values else None


@pytest.mark.parametrize("q", [0.01, 0.5, 0.9])
def test_quantiles_by_counting(spark, q):
    chance = random.Random(8)
    inf = float("inf")
    groups = {
        "a": [chance.gauss(0, 1) for _ in range(3001)], "b": [1.0] * 500, "c": [None, None], None: [3.0, 1.0, 2.0],
        "d": [chance.choice([-inf, -1e308, 1e308, inf, 5.0, float("nan")]) for _ in range(99)], "e": [7.5],
        "f": [1e-300 * i for i in range(50)] + [1e300], "g": [float(round(chance.expovariate(1), 1)) for _ in range(2000)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    chance.shuffle(rows)
    found = exact_quantile(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", q)
    got = {r["g"]: r["quantile"] for r in found.collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g] == brute(values, q) or (got[g] != got[g] and brute(values, q) != brute(values, q)), g
    assert exact_quantile(spark.createDataFrame([], "g string, v double"), ["g"], "v").isEmpty()


def test_large_groups_are_counted_and_give_the_same(spark, small):
    silver = base.silver(spark, small)
    companies = silver.select("cik").distinct().withColumn("sic_code", F.when(F.col("cik") < "0000000009", "1").otherwise("2"))
    plain, counted = (reports.peer_benchmark(silver, companies, buffer=n) for n in (100_000, 3))
    columns = ["sic_code", "q_idx", "companies", "median_margin", F.round("avg_margin", 9), F.round("avg_growth", 9)]
    assert plain.select(columns).exceptAll(counted.select(columns)).isEmpty()
    assert counted.count() == plain.count() > 0


def test_a_third_of_the_rows_in_one_group_makes_no_large_task(spark):
    """Rows that reach the window of a pass: at most a slice each from every task."""
    rows = spark.range(90_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"), (F.col("id") * 0.37 % 1000).alias("v"))
    found = exact_quantile(rows, ["g"], "v").filter("g = 0").first()["quantile"]
    values = sorted(r["v"] for r in rows.filter("g = 0").collect())
    assert found == values[(len(values) + 1) // 2 - 1]


def test_bucketed_silver_needs_no_exchange(spark, small, tmp_path):
    store = LayerStore(spark, str(tmp_path / "t"))
    silver = base.silver(spark, small)
    table = store.write_bucketed(silver, "silver", "stg_bucketed", "cik", 4, ("canonical_concept", "period_end"))
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        placed = Params(bucketed_by_company=True)
        for measure in (anomalies.qoq_change, anomalies.yoy_change, anomalies.measures):
            bucketed, plain = measure(table, placed), measure(silver)
            assert "Exchange" not in plan(bucketed) and "Exchange" in plan(plain)
            assert bucketed.exceptAll(plain).isEmpty() and plain.exceptAll(bucketed).isEmpty()
        assert "Exchange" not in plan(table.groupBy("cik").count())
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    spark.sql("DROP TABLE silver.stg_bucketed")
    again = store.register_bucketed("silver", "stg_bucketed", "cik", 4, ("canonical_concept", "period_end"))
    assert again.count() == silver.count()
    assert store.write_bucketed(silver.limit(5), "silver", "stg_bucketed", "cik", 4).count() == 5
    spark.sql("DROP TABLE silver.stg_bucketed")
