from factloom.functions.columns import (
    base_form,
    expected_quarters,
    fiscal_quarter,
    pad_identifier,
    pct_change,
    period_key,
    quarter_index,
    strict_date,
    strict_double,
    surrogate_key,
    value_type,
    zfill_identifier,
)

__all__ = [
    "base_form",
    "expected_quarters",
    "fiscal_quarter",
    "pad_identifier",
    "pct_change",
    "period_key",
    "quarter_index",
    "strict_date",
    "strict_double",
    "surrogate_key",
    "value_type",
    "zfill_identifier",
]
