import datetime as dt

from pyspark.sql import functions as F

from factloom import functions as fn


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x string"
    df = spark.createDataFrame([tuple(values.values()) or (None,)], schema)
    return df.select(column.alias("r")).first()["r"]


def test_identifier_padding(spark):
    cases = {"320193": ("0000320193", "0000320193"), "0000320193": ("0000320193",) * 2,
             "12345678901": ("1234567890", "12345678901"), None: (None, None)}
    for text, (padded, filled) in cases.items():
        assert one(spark, fn.pad_identifier("t"), t=text) == padded
        assert one(spark, fn.zfill_identifier("t"), t=text) == filled


def test_strict_double(spark):
    cases = {"1.5": 1.5, "-3": -3.0, "1e3": 1000.0, " 7 ": 7.0, "abc": None, "1.0d": None, "1f": None,
             "1.F": None, "0x1p3": None, "": None, None: None, "12x": None}
    for text, expected in cases.items():
        assert one(spark, fn.strict_double("t"), t=text) == expected, text
    assert one(spark, fn.strict_double("t"), t="inf") == float("inf")


def test_strict_date(spark):
    day = dt.date(2020, 1, 5)
    cases = {"2020-01-05": day, "2020-1-5": day, " 2020-01-05 ": day, "2020-01-05T10:00:00": day,
             "2020": None, "2020-01": None, "2020-01-05 x": None, "2020-1-5 x": None,
             "2020-02-30": None, "2020/01/05": None, "x": None, None: None, "20200-1-05": None}
    for text, expected in cases.items():
        assert one(spark, fn.strict_date("t"), t=text) == expected, text


def test_quarters(spark):
    def q(date, f):
        return one(spark, f(F.col("t").cast("date")), t=date)

    assert [q(f"2020-{m:02d}-01", fn.fiscal_quarter) for m in range(1, 13)] == [
        1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]
    assert q(None, fn.fiscal_quarter) is None
    assert q("2020-12-31", fn.quarter_index) + 1 == q("2021-01-01", fn.quarter_index)
    span = fn.expected_quarters(F.col("a").cast("date"), F.col("b").cast("date"))
    assert one(spark, span, a="2020-03-31", b="2020-04-01") == 2
    assert one(spark, span, a="2020-01-01", b="2020-03-31") == 1
    assert q("2020-02-29", fn.period_key) == 20200229


def test_change_form_and_key(spark):
    change = fn.pct_change(F.col("a").cast("double"), F.col("b").cast("double"))
    assert one(spark, change, a="150", b="100") == 0.5
    assert one(spark, change, a="-50", b="-100") == 0.5
    assert one(spark, change, a="1", b="0") is None
    assert one(spark, change, a="1", b=None) is None
    assert one(spark, fn.base_form("t"), t="10-K/A") == "10-K"
    assert one(spark, fn.base_form("t"), t="10-K405") == "10-K405"
    key = one(spark, fn.surrogate_key("a", "b"), a="1", b="2")
    assert len(key) == 64 and key != one(spark, fn.surrogate_key("a", "b"), a="2", b="1")


def test_value_type_reads_the_text(spark):
    assert one(spark, fn.value_type("t"), t=None) == "instant"
    assert one(spark, fn.value_type("t"), t="x") == "duration"
