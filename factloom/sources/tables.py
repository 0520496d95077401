"""Filing-shaped relations derived from the star-schema tables of a data folder."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.session import shared_path

# Declared, so that opening a table reads no file footer.
SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}

# Fixed values of the test relations. A derived document covers orders of one such range of keys, which bounds its size
# however many orders its company has.
KEYS_PER_FACTS_DOCUMENT = 4096
KEYS_PER_SUBMISSION = 262144


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def facts_from_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One fact entry per order, filed by the nation of its customer."""
    concept = """CASE o_orderpriority
        WHEN '1-URGENT' THEN 'Revenues'
        WHEN '2-HIGH' THEN 'SalesRevenueNet'
        WHEN '3-MEDIUM' THEN 'NetIncomeLoss'
        WHEN '4-NOT SPECIFIED' THEN 'Assets'
        ELSE if(o_orderkey % 2 = 0, 'EarningsPerShareBasic', 'UnmappedTag') END"""
    filings = orders.selectExpr(
        "o_custkey",
        "o_orderkey",
        "cast(o_orderdate AS date) AS day",
        f"{concept} AS raw_concept",
        "if(o_orderpriority = '3-MEDIUM', o_totalprice - 150000.0D, o_totalprice) AS reported_value",
    )
    filers = customers.select("c_custkey", "c_nationkey")
    return filings.join(filers, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "lpad(cast(c_nationkey AS string), 10, '0') AS cik",
        "concat('Entity ', cast(c_nationkey AS string)) AS entity_name",
        "raw_concept",
        "reported_value",
        "if(raw_concept <> 'Assets', trunc(day, 'quarter'), NULL) AS period_start",
        "last_day(add_months(trunc(day, 'quarter'), 2)) AS period_end",
        "lpad(cast(o_orderkey AS string), 10, '0') AS accession_number",
        "CASE WHEN o_orderkey % 10 = 0 THEN '8-k' WHEN o_orderkey % 10 = 1 THEN '10-K/A' "
        "WHEN o_orderkey % 10 = 2 THEN '10-Q/A' WHEN o_orderkey % 10 <= 5 THEN '10-K' "
        "ELSE '10-Q' END AS form_raw",
        "date_add(day, cast(o_orderkey % 120 AS int)) AS filed_date",
        "if(quarter(day) = 4, 'FY', concat('Q', cast(quarter(day) AS string))) "
        "AS fiscal_period_label",
        "if(raw_concept = 'EarningsPerShareBasic', 'USD/shares', 'USD') AS unit",
        f"cast(o_orderkey DIV {KEYS_PER_FACTS_DOCUMENT} AS int) AS part",
    )


def filing_facts(spark: SparkSession, folder: str) -> DataFrame:
    return facts_from_orders(table(spark, folder, "orders"), table(spark, folder, "customer"))


def submission_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Company metadata documents: (loaded_at, document).

    Each customer is a company and its orders are its filings. Even and odd keys arrive as
    separate loads, so that every company is loaded more than once.
    """
    filings = table(spark, folder, "orders").selectExpr(
        "o_custkey AS c_custkey",
        f"cast(o_orderkey DIV {KEYS_PER_SUBMISSION} * 2 + o_orderkey % 2 AS int) AS part",
        "struct(lpad(cast(o_orderkey AS string), 10, '0') AS accn, "
        "cast(date_add(cast(o_orderdate AS date), cast(o_orderkey % 120 AS int)) AS string) AS filed, "
        "CASE WHEN o_orderkey % 10 = 0 THEN '8-K' WHEN o_orderkey % 10 <= 3 THEN '10-K' "
        "ELSE '10-Q' END AS form) AS filing",
    )
    folded = filings.groupBy("c_custkey", "part").agg(F.collect_list("filing").alias("f"))
    company = table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    document = """to_json(named_struct(
        'cik', c_custkey,
        'name', concat(c_name, ' part ', cast(part AS string)),
        'sic', CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 3711 WHEN 'BUILDING' THEN 1520
                    WHEN 'FURNITURE' THEN 2510 WHEN 'HOUSEHOLD' THEN 2840 ELSE 3530 END,
        'sicDescription', c_mktsegment,
        'stateOfIncorporation', if(c_nationkey < 10, 'DE', NULL),
        'tickers', if(c_nationkey < 20, array(concat('T', cast(c_custkey AS string)),
                      concat('T', cast(c_custkey AS string), '-B')), cast(array() AS array<string>)),
        'exchanges', if(c_nationkey < 20, array(if(c_nationkey < 10, 'NYSE', 'Nasdaq')),
                        cast(array() AS array<string>)),
        'filings', named_struct('recent', named_struct(
            'accessionNumber', f.accn, 'filingDate', f.filed, 'form', f.form))))"""
    return folded.join(company, "c_custkey").selectExpr(
        "timestamp_seconds(1704067200 + part * 3600) AS loaded_at", f"{document} AS document"
    )


def put_files(spark: SparkSession, df: DataFrame, name: str, folder: str, kind: str = "parquet") -> None:
    """One file per value of column `name`, called after it; a file of that name is replaced.

    Modification times follow the order of the values, which is the order in which a stream
    takes the files. For fixtures: the values are few.
    """
    staging = shared_path(spark, "staging")
    df.repartition(name).write.partitionBy(name).format(kind).save(staging)
    paths = spark._jvm.org.apache.hadoop.fs
    target = paths.Path(folder)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target)
    found = files.globStatus(paths.Path(staging, f"{name}=*/part-*"))
    values = sorted((int(f.getPath().getParent().getName().rpartition("=")[2]), n, f.getPath()) for n, f in enumerate(found))
    now = int(time.time() * 1000) - 1000 * len(values)
    for place, (value, _, source) in enumerate(values):
        file = paths.Path(target, f"{value}.{kind}")
        files.delete(file, False)
        files.rename(source, file)
        files.setTimes(file, now + 1000 * place, -1)
