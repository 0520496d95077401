"""Schemas found in the documents themselves, for sources that declare none."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.schemas import CORRUPT

# Types of semi-structured values, where they are no field names, and how they are read: values
# whose type differs between documents, or that are null in all of them, stay text.
_KINDS = re.compile(r"`(?:[^`]|``)*`|\b(OBJECT|VARIANT|VOID)\b(?!:)")
_READ_AS = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}


def read_texts(spark: SparkSession, path: str | list[str], whole_files: bool = True) -> DataFrame:
    """One row per document as text; switch `whole_files` off for one document per line."""
    return spark.read.text(path, wholetext=whole_files).select(
        F.col("value").alias("document"),
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_modification_time").alias("source_modified_at"),
        F.col("_metadata.file_size").alias("source_bytes"),
    )


def _is_object(text: str) -> Column:
    # The parse is asked for first: a text that cannot be parsed is no object.
    parsed = F.try_parse_json(text)
    return parsed.isNotNull() & F.ltrim(text).startswith("{")


def discover_schema(documents: DataFrame, text: str = "document") -> T.StructType:
    """The schema that all readable documents share, whatever columns each of them has.

    One aggregation over all documents: each task merges the schemas of its own, and only the
    merged ones travel. A column that some documents lack is null there; one whose type differs
    is wide enough for all of them, or text where no type is. Documents that are no JSON
    objects have no say. Without any document the schema has no columns.
    """
    merged = documents.filter(_is_object(text)).agg(
        F.schema_of_variant_agg(F.try_parse_json(text)).alias("merged")
    ).first()["merged"]
    if merged is None or not merged.startswith("OBJECT"):
        return T.StructType([])
    spelled = _KINDS.sub(lambda m: _READ_AS.get(m[1], m[0]), merged)
    return T.DataType.fromDDL(spelled)


def read_with(documents: DataFrame, schema: T.StructType, text: str = "document") -> DataFrame:
    """Documents as columns of `schema`; what cannot be read is kept in the corrupt column."""
    kept = [c for c in documents.columns if c != text]
    if not schema.fields:
        return documents.select(*kept, F.col(text).alias(CORRUPT))
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    read = F.from_json(text, whole, {"columnNameOfCorruptRecord": CORRUPT})
    # A field of the document may be called like a column that stands beside it.
    clash = {f.name.lower() for f in schema.fields}
    kept = [F.col(c).alias(f"_{c}") if c.lower() in clash else F.col(c) for c in kept]
    return documents.select(*kept, read.alias("_read")).select(
        *[f.name for f in documents.select(*kept).schema.fields], "_read.*"
    )


def aligned(documents: DataFrame, wanted: T.StructType) -> DataFrame:
    """The columns of `wanted` in its types, missing ones null; all other columns are kept.

    Objects and lists become their text where text is wanted.
    """
    have = {f.name: f.dataType for f in documents.schema.fields}

    def column(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType)
        nested = isinstance(have[field.name], (T.StructType, T.ArrayType, T.MapType))
        if nested and isinstance(field.dataType, T.StringType):
            return F.to_json(field.name)
        return F.col(field.name).try_cast(field.dataType)

    names = {f.name for f in wanted.fields}
    return documents.select(
        *[column(f).alias(f.name) for f in wanted.fields], *[F.col(f"`{c}`") for c in have if c not in names]
    )
