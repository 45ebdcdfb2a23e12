"""Aggregate expressions with the null, empty and tie rules the feature tables rely on.

Every expression keeps a fixed-width aggregation buffer, so Spark plans hash aggregates with
map-side partials: a key that owns a third of the rows still reaches its reducer as one row per
map task.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: added to every ratio denominator
EPSILON = 1e-5


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_count() -> Column:
    return F.count(F.lit(1))


def sum_or_zero(c: Column | str) -> Column:
    """Sum that is 0, not null, for a group with no values."""
    return F.coalesce(F.sum(_col(c)), F.lit(0))


def distinct_with_null(c: Column | str) -> Column:
    """Distinct count in which null is one more value.

    ``count_distinct`` first groups on (key, value), which spreads a hot key over its values.
    """
    c = _col(c)
    return F.count_distinct(c) + F.max(c.isNull().cast("long"))


def count_where(predicate: Column) -> Column:
    return F.count_if(predicate)


def sum_where(predicate: Column, c: Column | str) -> Column:
    return sum_or_zero(F.when(predicate, _col(c)))


def max_where(predicate: Column, c: Column | str) -> Column:
    return F.max(F.when(predicate, _col(c)))


def share_where(predicate: Column) -> Column:
    return F.count_if(predicate) / F.count(F.lit(1))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator + F.lit(EPSILON))


def ratio_of_sums(numerator: Column | str, denominator: Column | str) -> Column:
    return guarded_ratio(sum_or_zero(numerator), sum_or_zero(denominator))


def recency(order: Column | str, tiebreak: Column | str) -> Column:
    """One number that sorts by ``order`` and then by the 64-bit ``tiebreak``.

    A decimal keeps ``max_by`` inside hash aggregation, which a struct key would not. Rows
    without an order value sort first, as nulls do in a sort.
    """
    lowest = F.lit(-(10**10)).cast("decimal(11,0)")
    step = F.lit(Decimal(10**20))
    major = F.coalesce(_col(order).cast("decimal(11,0)"), lowest)
    minor = F.coalesce(_col(tiebreak).cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    return (major * step).cast("decimal(36,0)") + minor


def latest(c: Column | str, key: Column) -> Column:
    """Value of the newest row; a null there stays null."""
    return F.max_by(_col(c), key)


def latest_ratio(numerator: Column | str, denominator: Column | str, key: Column) -> Column:
    return guarded_ratio(latest(numerator, key), latest(denominator, key))
