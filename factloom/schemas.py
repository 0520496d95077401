"""Explicit schemas. Documents are never inferred: their concept keys differ per company."""

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Every field of a fact entry is read as text and cast afterwards, so that one bad
# value costs one row and not the document.
FACT_ENTRY = _strings("val", "start", "end", "accn", "form", "filed", "fp")

FACTS_DOCUMENT = _strings("cik", "entityName", "facts", CORRUPT)

SUBMISSIONS_DOCUMENT = T.StructType(
    [
        T.StructField("cik", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("sic", T.StringType()),
        T.StructField("sicDescription", T.StringType()),
        T.StructField("stateOfIncorporation", T.StringType()),
        T.StructField("tickers", T.ArrayType(T.StringType())),
        T.StructField("exchanges", T.ArrayType(T.StringType())),
        T.StructField("filings", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

FILING_HISTORY = T.StructType(
    [
        T.StructField(
            "recent",
            T.StructType(
                [
                    T.StructField("accessionNumber", T.ArrayType(T.StringType())),
                    T.StructField("filingDate", T.ArrayType(T.StringType())),
                    T.StructField("form", T.ArrayType(T.StringType())),
                ]
            ),
        )
    ]
)

SYNONYM_SEED = _strings("canonical_tag", "synonym_tag", "statement_type", "display_label")
COMPANY_SEED = _strings("cik", "ticker", "company_name", "industry", "sic_code")


def all_concepts_type() -> T.StructType:
    """`us-gaap` as concept -> units -> entries, whatever concepts a document carries."""
    units = T.MapType(T.StringType(), T.ArrayType(FACT_ENTRY))
    concept = T.StructType([T.StructField("units", units)])
    return T.StructType([T.StructField("us-gaap", T.MapType(T.StringType(), concept))])
