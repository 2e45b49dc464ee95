"""Numeric expressions with pandas-compatible NULL handling (P-4, P-6, P-12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_double(c) -> Column:
    """P-4: coercing cast; an unparsable string becomes NULL (never throws)."""
    return _c(c).try_cast("double")


def fround(c, scale: int = 0) -> Column:
    """Round a DOUBLE half away from zero on its *binary* value:
    round(x * 10^s) / 10^s.

    Spark's ``round`` on doubles rounds the shortest decimal representation,
    so 5153.62725 (binary 5153.627249999...) becomes 5153.6273; rounding the
    scaled binary value gives 5153.6272, as SQL engines that compute
    ``round(x * 10^s) / 10^s`` do.  The scaled value is rounded with scale 0,
    where both interpretations agree.
    """
    m = float(10 ** scale)
    x = _c(c).cast("double")
    return F.round(x * m, 0) / m if scale else F.round(x, 0)


def unit_price(value, qty, scale: int = 4) -> Column:
    """P-6: value / qty rounded half away from zero to ``scale`` decimals;
    qty = 0 -> NULL."""
    return fround(F.try_divide(_c(value).cast("double"), _c(qty).cast("double")), scale)


def clip(c, lower=None, upper=None) -> Column:
    """P-12: clip to [lower, upper]; NULL stays NULL (``greatest`` skips NULLs)."""
    x = _c(c)
    out = x
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def ratio_or_null(num, den) -> Column:
    """num/den, NULL when den is 0 or NULL (pandas inf/NaN -> NULL)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def cv(std_col, mean_col) -> Column:
    """Coefficient of variation: std/mean, 0 when mean <= 0 or std is NULL."""
    s, m = _c(std_col), _c(mean_col)
    return F.when(m.isNull() | (m <= 0), F.lit(0.0)).otherwise(
        F.coalesce(s / m, F.lit(0.0)))


def dbl(c, scale: int | None = None) -> Column:
    """Cast to DOUBLE, optionally rounding (half-up) first -- for exact decimals."""
    x = _c(c)
    if scale is not None:
        x = F.round(x, scale)
    return x.cast("double")


MONEY_SCALE = 10_000  # money columns carry 4 decimals
_LOW_BITS = 20


def exact_long_sum(c) -> Column:
    """Exact sum of LONGs as DECIMAL(38,0), past 2^63 too.

    The high and the low 20 bits are summed apart, each in a LONG (fixed-width,
    codegen'd buffers, where summing decimals wider than 18 digits keeps objects):
    the low part lasts for 2^43 rows, the high part for 2^63 rows of a mean below
    2^20 units and for 2^33 rows of a mean of 2^50.  NULLs are skipped; no values
    at all give NULL.
    """
    x = _c(c).cast("long")
    high = F.sum(F.shiftright(x, _LOW_BITS)).cast("decimal(19,0)")
    low = F.sum(x.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("long"))).cast("decimal(19,0)")
    return (high * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low).cast("decimal(38,0)")


def money_sum(df, value_col: str) -> Column:
    """Exact sum of a money column, as DECIMAL(38,4).

    When the frame also carries ``<value_col>_units`` (the same amount as an
    exact LONG count of 1e-4 units, see ``sources.tables.trade``) the sum is
    ``exact_long_sum`` of that, scaled once per group; else the decimal is summed.
    Both give the same exact value.
    """
    units = f"{value_col}_units"
    if units in df.columns:
        return (exact_long_sum(units) * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(38,4)")
    return F.sum(value_col)
