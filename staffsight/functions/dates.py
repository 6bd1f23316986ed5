"""Date and time expressions. All return Columns; no UDFs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _micros(x) -> Column:
    # timestamp_ntz and date both go through timestamp so unix_micros accepts them (zone UTC)
    return F.unix_micros(_c(x).cast("timestamp"))


def days_between(start, end, null_as_zero: bool = True) -> Column:
    """Whole days from ``start`` to ``end``, floored (negative spans floor down).

    Not ``datediff`` (ignores the time of day) and not ``timestampdiff`` (truncates
    toward zero). A null input gives 0 unless ``null_as_zero`` is False.
    """
    d = F.floor((_micros(end) - _micros(start)) / F.lit(MICROS_PER_DAY))
    return F.coalesce(d, F.lit(0).cast("long")) if null_as_zero else d


def days_since_if_after(day, event) -> Column:
    """W3/D11 form: floor days from ``event`` to ``day`` when ``day`` is after it, else 0."""
    return F.when(_c(day).cast("timestamp") > _c(event).cast("timestamp"),
                  days_between(event, day)).otherwise(F.lit(0).cast("long"))


def month_index(d) -> Column:
    return F.year(_c(d)) * 12 + F.month(_c(d))


def month_offset(start, end) -> Column:
    """Months from the month of ``start`` to the month of ``end`` (calendar months)."""
    return month_index(end) - month_index(start)


def month_offset_class(snapshot, first_month, top: int = 3) -> Column:
    """Class 0/1/2 for the first billing month 0/1/2 months after the snapshot
    month; null, earlier months and later months all give ``top`` (3)."""
    k = month_offset(snapshot, first_month)
    return F.when(k.between(0, top - 1), k).otherwise(F.lit(top)).cast("int")


def subtract_business_days(d, n: int) -> Column:
    """``d`` minus ``n`` Mon–Fri business days.

    A Saturday or Sunday is first rolled to the next Monday, so from a weekend day the
    preceding Friday counts as one business day back. Closed form, no calendar table:
    with n = 5w + r, step back 7w + r days, plus 2 if r passes the weekday.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    day = _c(d).cast("date")
    wd0 = F.weekday(day)  # Monday = 0
    rolled = F.when(wd0 >= 5, F.date_add(day, 7 - wd0)).otherwise(day)
    wd = F.weekday(rolled)
    w, r = divmod(n, 5)
    back = F.lit(7 * w + r) + F.when(F.lit(r) > wd, 2).otherwise(0)
    return F.date_sub(rolled, back)


def month_end(d, k: int = 0) -> Column:
    """Last day of the month ``k`` months after ``d``."""
    return F.last_day(F.add_months(_c(d).cast("date"), k))


def week_start(d) -> Column:
    """Monday of the ISO week of ``d`` (as a date)."""
    return F.date_trunc("week", _c(d).cast("timestamp")).cast("date")


def iso_year_week(d) -> Column:
    """ISO ``year*100 + week`` (week-based year, so 2024-12-30 is 202501)."""
    dd = _c(d).cast("date")
    return F.extract(F.lit("YEAROFWEEK"), dd) * 100 + F.weekofyear(dd)


def period_bounds(run_date) -> tuple[Column, Column]:
    """First day of the month of ``run_date`` and of the following month."""
    start = F.trunc(_c(run_date).cast("date"), "MM")
    return start, F.add_months(start, 1)


def period_index(year, month, periods_per_year: int) -> Column:
    """Integer index of the month/quarter/half/year containing (year, month).

    ``periods_per_year`` is 12, 4, 2 or 1. Consecutive periods differ by one, so the
    previous / current / next period are index - 1 / 0 / + 1.
    """
    if periods_per_year not in (12, 4, 2, 1):
        raise ValueError("periods_per_year must be 12, 4, 2 or 1")
    months_per = 12 // periods_per_year
    return (_c(year) * periods_per_year
            + F.floor((_c(month) - 1) / F.lit(months_per)).cast("int")).cast("int")
