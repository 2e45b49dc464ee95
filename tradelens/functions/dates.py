"""Date/calendar expressions (P-1, P-7, K-1 helpers). All JVM-side Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradelens.params import PEAK_MONTHS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_from_parts(year, month) -> Column:
    """P-1: first-of-month DATE from (year, month); invalid month (52) -> NULL.

    ``make_date`` throws under ANSI mode, so the date is parsed with
    ``try_to_date`` from a formatted string instead.
    """
    y, m = _c(year), _c(month)
    text = F.format_string("%04d-%02d-01", y, m)
    return F.when(y.isNull() | m.isNull(), F.lit(None).cast("date")).otherwise(
        F.try_to_date(text, "yyyy-MM-dd"))


def fy_start_year(d) -> Column:
    """Start year of the April-March financial year containing ``d``."""
    d = _c(d)
    return F.year(d) - F.when(F.month(d) < 4, 1).otherwise(0)


def financial_year(d) -> Column:
    """P-7: April-March financial year label, e.g. ``FY24-25``."""
    start = fy_start_year(d)
    return F.format_string("FY%02d-%02d", F.pmod(start, F.lit(100)),
                           F.pmod(start + 1, F.lit(100)))


def is_peak(month_col, peak_months=PEAK_MONTHS) -> Column:
    return _c(month_col).isin(list(peak_months))


def date_key(d) -> Column:
    """Calendar surrogate key yyyymmdd as INT (arithmetic, no string format)."""
    d = _c(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def calendar_columns(d, peak_months=PEAK_MONTHS) -> dict[str, Column]:
    """P-7: year, month, quarter, financial_year, is_peak_season from a date."""
    d = _c(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "financial_year": financial_year(d),
        "is_peak_season": is_peak(F.month(d), peak_months),
    }


def years_between(d, first_year: int, last_year: int) -> Column:
    """first_year <= year(d) <= last_year as a plain range on ``d`` -- unlike
    ``year(d) BETWEEN ...`` this reaches the Parquet scan as a pushed filter
    and prunes row groups by their min/max statistics."""
    import datetime as _dt
    d = _c(d)
    return (d >= F.lit(_dt.date(first_year, 1, 1))) & (d < F.lit(_dt.date(last_year + 1, 1, 1)))


def month_sequence(start, end) -> Column:
    """Array of first-of-month dates from ``start`` to ``end`` inclusive."""
    return F.sequence(_c(start), _c(end), F.expr("INTERVAL 1 MONTH"))
