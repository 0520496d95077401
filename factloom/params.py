"""Run parameters shared by every layer."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # Thresholds, limits and accepted codes that results depend on.
    eps_trailing_quarters: int = 8
    eps_sigmas: float = 2.0
    revenue_qoq_threshold: float = 0.30
    asset_qoq_threshold: float = 0.40
    restatement_threshold: float = 0.10
    stale_after_hours: int = 6
    freshness_hours: int = 25
    inactive_after_months: int = 18
    event_window_days: int = 90
    # Off by default. Documents above it are rejected, and the build reports every reject.
    max_object_bytes: int | None = None
    units: tuple[str, ...] = ("USD",)
    excluded_forms: tuple[str, ...] = ("8-K", "8-K/A")
    accepted_forms: tuple[str, ...] = (
        "10-K", "10-Q", "10-K/A", "10-Q/A", "20-F", "40-F",
        "10-K405", "10-KSB", "10-KSB/A", "10-QSB", "10-KT",
    )
    accepted_value_types: tuple[str, ...] = ("instant", "duration")

    # On where silver comes from a table that `LayerStore.write_bucketed` wrote by `cik`.
    bucketed_by_company: bool = False

    # Only 80-100 day (or instant) values enter period-over-period measures when on.
    quarterly_only: bool = False


DEFAULTS = Params()

# Units under which money, per-share and share-count concepts are reported.
ALL_UNITS = ("USD", "USD/shares", "shares")
