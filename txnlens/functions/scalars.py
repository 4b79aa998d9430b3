"""Scalar column helpers (all expand to built-in, code-generated expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_range(col, start, end) -> Column:
    """Half-open range test ``start <= col < end``; either end may be None."""
    c = F.col(col) if isinstance(col, str) else col
    test = F.lit(True)
    if start is not None:
        test = test & (c >= F.lit(start))
    if end is not None:
        test = test & (c < F.lit(end))
    return test


def or_default(col, default) -> Column:
    """``col`` with NULL replaced by ``default``."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(default))


def one_hot(col, value) -> Column:
    """1 when ``col`` equals ``value``, otherwise 0 (NULL gives 0)."""
    return F.when((F.col(col) if isinstance(col, str) else col) == value, 1).otherwise(0).cast("long")


def amount_mod(amount, modulus) -> Column:
    """Amount modulo ``modulus`` in whole cents. Cents are rounded half away from zero, not truncated."""
    cents = F.round((F.col(amount) if isinstance(amount, str) else amount) * 100).cast("long")
    return (cents % F.lit(100 * modulus)) / 100


def zscore(value, mean, std) -> Column:
    """``(value - mean) / std``, or -1.0 where the statistics are missing or the spread is zero."""
    value, mean, std = (F.col(c) if isinstance(c, str) else c for c in (value, mean, std))
    return F.coalesce(F.try_divide(value - mean, std), F.lit(-1.0))


def seconds_between(start, end) -> Column:
    """Number of second boundaries between two zone-less timestamps."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def distance(x1, y1, x2, y2) -> Column:
    """Euclidean distance."""
    return F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2))


def log_ratio(num, den) -> Column:
    """``ln(num / den)`` with IEEE results: 0 on top gives -inf, 0 below gives +inf, 0/0 gives NULL."""
    inf = float("inf")
    return (F.when((num == 0) & (den == 0), F.lit(None).cast("double"))
            .when(num == 0, F.lit(-inf)).when(den == 0, F.lit(inf))
            .otherwise(F.ln(num / den)))


def try_double(col) -> Column:
    """String to double, NULL where it does not parse."""
    return (F.col(col) if isinstance(col, str) else col).try_cast("double")


def grid_cell(value, edge, guess) -> Column:
    """Cell index of ``value`` on a grid whose i-th lower edge is ``edge(i)``.

    ``guess`` is the index found by division; it can be off by one where the division rounds across an
    edge, so it is corrected by comparing with the edges themselves.
    """
    g = guess.cast("long")
    return F.when(value >= edge(g + 1), g + 1).when((g > 0) & (value < edge(g)), g - 1).otherwise(g)
