"""Column expressions (all JVM built-ins, codegen friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardpanel.constants import COVERAGE_START, WEEKEND_DAYS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_even(col, digits: int = 2) -> Column:
    """Scale, round half to even, unscale: the numpy/pandas ``round``.

    Spark's ``round`` is half-up and ``bround`` rounds the exact decimal
    value; neither equals the scaled-binary rounding of pandas on ties such
    as ``x.xx5``.  ``rint`` on the scaled double does.
    """
    scale = float(10 ** digits)
    return F.rint(_c(col) * F.lit(scale)) / F.lit(scale)


#: Measurements are added as decimals of eight places (20 before the point), so a
#: sum does not depend on the order in which tasks deliver its parts.  The feeds
#: carry at most five places; a ninth place would be rounded.
EXACT = "decimal(28,8)"


def exact_sum(col) -> Column:
    """Order-independent sum (see ``EXACT``), returned as double."""
    return F.sum(_c(col).cast(EXACT)).cast("double")


def zero_fill(col, dtype: str = "int") -> Column:
    """Null -> 0, then cast (the panel's counters and labels)."""
    return F.coalesce(_c(col), F.lit(0)).cast(dtype)


def month_cyclic(date_col) -> tuple[Column, Column]:
    """sin/cos(2*pi*month/12)."""
    m = F.month(_c(date_col)).cast("double")
    ang = F.lit(2 * math.pi) * m / F.lit(12.0)
    return F.sin(ang), F.cos(ang)


def weekday_cyclic(date_col) -> tuple[Column, Column, Column]:
    """sin/cos(2*pi*d/7) with Monday = 0, and the Friday/Saturday weekend flag."""
    d = F.weekday(_c(date_col))
    ang = F.lit(2 * math.pi) * d.cast("double") / F.lit(7.0)
    return F.sin(ang), F.cos(ang), d.isin(*WEEKEND_DAYS).cast("int")


def coverage_flag(date_col, start: str = COVERAGE_START) -> Column:
    """True from the first day with satellite coverage on."""
    return _c(date_col) >= F.to_date(F.lit(start))


def zero_pad(col, width: int = 2) -> Column:
    """Region codes keep their leading zero whatever type they arrive in."""
    return F.lpad(F.trim(_c(col).cast("string")), width, "0")


def source_name(col) -> Column:
    """Lower-cased, trimmed source label."""
    return F.lower(F.trim(_c(col)))
