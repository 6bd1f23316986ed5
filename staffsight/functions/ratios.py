"""Ratio features.

Spark 4 runs in ANSI mode, where ``a / 0`` raises; every ratio here goes through
``try_divide`` and falls back to a default (0) for zero, null and infinite results.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_ratio(num, den, default=0.0) -> Column:
    """``num / den``; null, zero denominator and ±inf give ``default``."""
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    r = F.when(F.abs(r) == F.lit(float("inf")), F.lit(None).cast("double")).otherwise(r)
    return r if default is None else F.coalesce(r, F.lit(default).cast("double"))


def ratio_columns(df: DataFrame, pairs: Iterable[tuple[str, str]], scale: float = 100.0,
                  skip_missing: bool = True) -> DataFrame:
    """Add ``<num>_div_<den>`` = scale·num/den for each pair in one projection.

    Pairs whose input columns are absent are skipped (the reference computes a block
    only when its inputs exist)."""
    have = set(df.columns)
    exprs = []
    for num, den in pairs:
        if skip_missing and (num not in have or den not in have):
            continue
        exprs.append(safe_ratio(F.col(num) * scale, F.col(den)).alias(f"{num}_div_{den}"))
    return df.select("*", *exprs)


# The (numerator, denominator) pairs of the time-relation ratios.
TIME_RELATION_PAIRS: Sequence[tuple[str, str]] = (
    ("time_from_first_proposals", "time_after_creation"),
    ("time_from_first_onboarding", "time_after_creation"),
    ("time_from_first_booking", "time_after_creation"),
    ("time_to_planned_start_date", "time_after_creation"),
    ("time_from_first_proposals", "planned_staffing_period"),
    ("time_from_first_onboarding", "planned_staffing_period"),
    ("time_from_first_booking", "planned_staffing_period"),
    ("time_after_creation", "planned_staffing_period"),
    ("time_to_planned_start_date", "planned_staffing_period"),
    ("time_from_last_proposals", "time_after_creation"),
    ("time_from_last_onboarding", "time_after_creation"),
    ("time_from_last_booking", "time_after_creation"),
    ("time_from_last_proposals", "time_from_first_proposals"),
    ("time_from_last_onboarding", "time_from_first_onboarding"),
    ("time_from_last_booking", "time_from_first_booking"),
    ("planned_staffing_period", "proj_duration"),
    ("planned_position_period", "proj_duration"),
    ("proj_after_created", "proj_duration"),
    ("proj_before_created", "proj_duration"),
    ("time_to_planned_end_date", "proj_duration"),
    ("end_pos_in_proj", "proj_duration"),
    ("start_pos_in_proj", "proj_duration"),
    ("time_of_assignment", "proj_duration"),
)

# The (numerator, denominator) pairs of the assignment ratios.
ASSIGNMENT_PAIRS: Sequence[tuple[str, str]] = (
    ("start_pos_in_proj", "proj_duration"),
    ("end_pos_in_proj", "proj_duration"),
    ("time_of_assignment", "proj_duration"),
    ("time_after_planned_start_date", "proj_duration"),
    ("time_to_planned_end_date", "proj_duration"),
    ("proj_before_created", "proj_duration"),
    ("proj_after_created", "proj_duration"),
    ("planned_position_period", "proj_duration"),
    ("planned_staffing_period", "proj_duration"),
)


def time_relation_ratios(df: DataFrame) -> DataFrame:
    """The time-relation ratios ×100 (undefined → 0; absent inputs skip)."""
    return ratio_columns(df, TIME_RELATION_PAIRS)


def assignment_ratios(df: DataFrame) -> DataFrame:
    """The assignment ratios ×100 (null → 0; the reference's ±inf is 0 here)."""
    return ratio_columns(df, ASSIGNMENT_PAIRS)
