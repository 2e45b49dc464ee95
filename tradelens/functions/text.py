"""String expressions (P-13, P-15, Q-5, Q-7, S-5 helpers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_match(c, pattern: str) -> Column:
    """Whole-string regex match (``\\A(?:p)\\z``); NULL input -> NULL."""
    return _c(c).rlike(r"\A(?:" + pattern + r")\z")


def pad_code(c, width: int = 6) -> Column:
    """Product code as zero-padded string (codes are strings, never ints)."""
    return F.lpad(_c(c).cast("string"), width, "0")


def title_label(c, strip_suffix: str | None = None) -> Column:
    """Un-pivoted column name -> display label: strip a suffix, '_'->' ', title."""
    x = _c(c)
    if strip_suffix:
        x = F.regexp_replace(x, strip_suffix + "$", "")
    return F.initcap(F.regexp_replace(x, "_", " "))


def millions(c, decimals: int = 1) -> Column:
    """P-15: ``$12.3M`` style label."""
    return F.format_string(f"$%.{decimals}fM", _c(c).cast("double") / 1e6)


def signed_pct(c, decimals: int = 1) -> Column:
    """P-15: ``+12.3%`` style label from a fraction."""
    return F.format_string(f"%+.{decimals}f%%", _c(c).cast("double") * 100)


def crore(c, fx: float, decimals: int = 0) -> Column:
    """P-15: USD -> INR crore label."""
    return F.format_string(f"%,.{decimals}f Cr", _c(c).cast("double") * fx / 1e7)
