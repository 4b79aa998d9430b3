"""Helpers over nested session arrays (``array<struct>``), for tables that keep the nested form.

Each is one higher-order function per row. The feature operators do not use them: they read running
aggregates that are linear in the session length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(entries, predicate) -> Column:
    """Number of entries for which ``predicate(entry)`` is true."""
    return F.coalesce(F.size(F.filter(entries, predicate)).cast("long"), F.lit(0).cast("long"))


def values_where(entries, field, predicate) -> Column:
    """Non-null ``field`` values of the entries that satisfy ``predicate``."""
    chosen = F.filter(entries, lambda e: predicate(e) & e[field].isNotNull())
    return F.transform(chosen, lambda e: e[field])


def sum_where(entries, field, predicate) -> Column:
    values = values_where(entries, field, predicate)
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(values) > 0, total)


def avg_where(entries, field, predicate) -> Column:
    return F.try_divide(sum_where(entries, field, predicate), F.size(values_where(entries, field, predicate)))


def min_where(entries, field, predicate) -> Column:
    return F.array_min(values_where(entries, field, predicate))


def max_where(entries, field, predicate) -> Column:
    return F.array_max(values_where(entries, field, predicate))


def distinct_where(entries, field, predicate) -> Column:
    """Number of distinct non-null ``field`` values among the entries that satisfy ``predicate``."""
    n = F.size(F.array_distinct(values_where(entries, field, predicate)))
    return F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)).cast("long")


def lookup_first(entries, key_field, key, value_field) -> Column:
    """``value_field`` of the first entry whose ``key_field`` equals ``key``; NULL when there is none."""
    hits = F.filter(entries, lambda e: e[key_field] == key)
    return F.try_element_at(hits, F.lit(1))[value_field]


def element(array, ordinal) -> Column:
    """1-based array element, NULL past the end."""
    return F.try_element_at(array, F.lit(ordinal))
