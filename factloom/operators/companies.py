"""Company metadata, filing history and ticker lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import pad_identifier, strict_date
from factloom.operators.dedup import latest_load_per_company
from factloom.schemas import FILING_HISTORY


def companies(raw: DataFrame) -> DataFrame:
    """One row per company from its freshest record; first ticker and exchange are primary."""
    # The filing history is wide and unused here; it must not travel through the shuffle.
    latest = latest_load_per_company(raw.drop("filings_blob"))
    return latest.select(
        pad_identifier("cik_raw").alias("cik"),
        F.col("company_name_raw").alias("company_name"),
        F.col("sic_raw").alias("sic_code"),
        F.col("sic_description_raw").alias("sic_description"),
        F.col("state_of_incorporation_raw").alias("state_of_incorporation"),
        F.try_element_at("tickers_raw", F.lit(1)).alias("primary_ticker"),
        F.try_element_at("exchanges_raw", F.lit(1)).alias("primary_exchange"),
        "loaded_at",
    )


def flatten_filings(raw: DataFrame) -> DataFrame:
    """Parallel history arrays -> one row per filing."""
    parsed = F.from_json("filings_blob", FILING_HISTORY)["recent"]
    history = raw.select(pad_identifier("cik_raw").alias("cik"), parsed.alias("recent"))
    zipped = F.arrays_zip("recent.accessionNumber", "recent.filingDate", "recent.form")
    return history.select("cik", F.inline(zipped)).select(
        "cik",
        F.col("accessionNumber").alias("accession_number"),
        F.upper("form").alias("form_type"),
        strict_date("filingDate").alias("filed_date"),
    )


def last_filing(filings: DataFrame) -> DataFrame:
    return filings.groupBy("cik").agg(F.max("filed_date").alias("last_filed"))


def ticker_lookup(requests: DataFrame, directory: DataFrame) -> DataFrame:
    """Requests joined to the directory by ticker, ignoring case."""
    return requests.join(
        directory.withColumnRenamed("ticker", "directory_ticker"),
        F.upper(requests["ticker"]) == F.upper("directory_ticker"),
    ).drop("directory_ticker")


def ticker_unmatched(requests: DataFrame, directory: DataFrame) -> DataFrame:
    return requests.join(
        directory.select(F.upper("ticker").alias("_known")),
        F.upper(requests["ticker"]) == F.col("_known"),
        "left_anti",
    )


def require_known_tickers(requests: DataFrame, directory: DataFrame) -> DataFrame:
    """`ticker_lookup` that refuses unknown tickers, naming a few of them."""
    unknown = ticker_unmatched(requests, directory).select("ticker").limit(5).collect()
    if unknown:
        raise ValueError(f"unknown tickers, e.g. {sorted(r[0] for r in unknown)}")
    return ticker_lookup(requests, directory)
