import pytest

from factloom.llm.common import bound_batches


@pytest.fixture(autouse=True)
def bounded(spark):
    bound_batches(spark)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null, empty, repeated and very long texts, null and repeated ids, clashing column names."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(6000))
    rows = [
        (1, "the cat sat on the mat today", "x"), (2, "the  cat\tsat on the mat today", "x"), (3, None, "x"),
        (4, "", None), (5, " ", "x"), (6, "the cat sat on the mat today", "x"), (7, long, "x"), (8, long + " end", "x"),
        (9, "日本語 のテキスト ﬁ é́ 😀", "x"), (None, "the cat sat on the mat today", "x"), (None, None, "x"),
        (10, "a" * 3000, "x"), (10, "a" * 3000, "x"), (11, "one two three", "x"), (11, "three two one", "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, keep_id string").withColumns(
        {}
    ).selectExpr("doc_id", "text", "keep_id", "keep_id AS n", "keep_id AS class", "keep_id AS label",
                 "keep_id AS kept", "keep_id AS score", "keep_id AS lang", "keep_id AS id", "keep_id AS _key")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def documents(spark, medium):
    return spark.read.parquet(f"{medium}/documents.parquet")
