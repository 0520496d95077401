"""Column -> Column functions; all JVM-side expressions inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IDENTIFIER_WIDTH = 10


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fiscal_quarter(date: Column | str) -> Column:
    """Calendar quarter 1-4 of a date; null stays null."""
    return F.quarter(_col(date))


def quarter_index(date: Column | str) -> Column:
    """Quarters counted on one line, so adjacent quarters differ by one."""
    d = _col(date)
    return F.year(d) * 4 + F.quarter(d)


def expected_quarters(first: Column | str, last: Column | str) -> Column:
    """Quarters touched from first to last, both included.

    Counts quarter boundaries; timestampdiff(QUARTER) would count full quarters.
    """
    return quarter_index(last) - quarter_index(first) + 1


def pad_identifier(identifier: Column | str) -> Column:
    """Zero-pad to 10 characters; longer input is cut to 10."""
    return F.lpad(_col(identifier).cast("string"), IDENTIFIER_WIDTH, "0")


def zfill_identifier(identifier: Column | str) -> Column:
    """Zero-pad to 10 characters; longer input is kept whole."""
    text = _col(identifier).cast("string")
    width = F.greatest(F.lit(IDENTIFIER_WIDTH), F.length(text))
    return F.lpad(text, width, F.lit("0"))


def strict_double(text: Column | str) -> Column:
    """Text to double, null when it is not a number.

    Java's type suffixes (1.0d, 1f) and hexadecimal floats are no numbers here. Plain
    digits at the end settle the usual case without the regular expression.
    """
    t = _col(text)
    last = F.substring(t, -1, 1)
    plain = (last >= "0") & (last <= "9") & (F.instr(F.lower(t), F.lit("x")) == 0)
    return F.when(plain | ~t.rlike(r"(?i)x|[0-9.][df]\s*$"), t.try_cast("double"))


def strict_date(text: Column | str) -> Column:
    """ISO text to date, null for partial dates, trailing text or days that do not exist."""
    t = _col(text)
    dash = F.lit("-")
    plain = (F.length(t) == 10) & (F.substring(t, 5, 1) == dash) & (F.substring(t, 8, 1) == dash)
    iso = r"^\s*\d{4}-\d{1,2}-\d{1,2}(T\d{2}:\d{2}:\d{2})?\s*$"
    return F.when(plain | t.rlike(iso), t.try_cast("date"))


def value_type(start_text: Column | str) -> Column:
    """Values without a start are snapshots. Takes the text: a malformed start is a start."""
    return F.when(_col(start_text).isNull(), "instant").otherwise("duration")


def pct_change(value: Column | str, previous: Column | str) -> Column:
    """Change relative to the previous magnitude; null when that is zero or unknown."""
    v, p = _col(value), _col(previous)
    return (v - p) / F.nullif(F.abs(p), F.lit(0.0))


def base_form(form: Column | str) -> Column:
    """The form an amendment amends: 10-K/A -> 10-K."""
    return F.regexp_replace(_col(form), "/A$", "")


def surrogate_key(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws("|", *[_col(p).cast("string") for p in parts]), 256)


def period_key(date: Column | str) -> Column:
    """Date as yyyymmdd integer."""
    d = _col(date)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
