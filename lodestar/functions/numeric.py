"""Numeric scalar expressions (F7, F10-F14, F17) kept inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    """checked string -> double (NULL when not a number)."""
    return _c(c).try_cast("double")


def softplus(theta) -> Column:
    """ln(1 + e^theta) without overflow: max(t,0) + log1p(e^-|t|)."""
    t = _c(theta)
    return F.greatest(t, F.lit(0.0)) + F.log1p(F.exp(-F.abs(t)))


def sigmoid(theta) -> Column:
    """e^t / (1 + e^t) without overflow."""
    t = _c(theta)
    return F.when(t >= 0, F.lit(1.0) / (F.lit(1.0) + F.exp(-t))) \
        .otherwise(F.exp(t) / (F.lit(1.0) + F.exp(t)))


def hinge(margin) -> Column:
    """max(0, m)."""
    return F.greatest(F.lit(0.0), _c(margin))


def safe_ratio(num, den) -> Column:
    """Division that yields NULL for a zero or NULL denominator."""
    return F.try_divide(_c(num), _c(den))


def significant(c, digits: int = 8) -> Column:
    """Round to ``digits`` significant digits (via ``%.{digits-1}e``), for
    values whose magnitude varies too much for a fixed decimal rounding."""
    return F.format_string(f"%.{digits - 1}e", _c(c).cast("double")).cast("double")
