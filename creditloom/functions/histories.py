"""One definition of a history feature for two shapes of a history: rows of a group, and an array inside a request.

``GroupedHistory`` gives aggregate expressions for ``groupBy().agg()``; ``ArrayHistory`` folds an array of records inside its own row with
higher-order functions, so a request needs no shuffle. Both follow the null, empty and tie rules of ``aggregates``: sums of nothing are 0, extremes and means
skip nulls and are null without values, a distinct count takes null as one more value, and the newest record keeps a null value.

A *cell* is a function from a column getter to an expression: ``lambda c: c("AMT_PAYMENT") - c("AMT_INSTALMENT")``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditloom.functions import aggregates as A

Getter = Callable[[str], Column]
Cell = Callable[[Getter], Column]


class GroupedHistory:
    """Aggregates over the rows of a group."""

    def rows(self) -> Column:
        return A.row_count()

    def distinct(self, cell: Cell) -> Column:
        return A.distinct_with_null(cell(F.col))

    def largest(self, cell: Cell, where: Cell | None = None) -> Column:
        return F.max(cell(F.col)) if where is None else A.max_where(where(F.col), cell(F.col))

    def smallest(self, cell: Cell) -> Column:
        return F.min(cell(F.col))

    def mean(self, cell: Cell) -> Column:
        return F.avg(cell(F.col))

    def total(self, cell: Cell, where: Cell | None = None) -> Column:
        return A.sum_or_zero(cell(F.col)) if where is None else A.sum_where(where(F.col), cell(F.col))

    def count(self, where: Cell) -> Column:
        return A.count_where(where(F.col))

    def newest(self, cell: Cell, order: str, tiebreak: str) -> Column:
        return A.latest(cell(F.col), A.recency(order, tiebreak))


class ArrayHistory:
    """The same over the records of an array; a null array is an empty one."""

    def __init__(self, records: Column) -> None:
        self.records = records

    def _values(self, cell: Cell, where: Cell | None = None) -> Column:
        def value(record: Column) -> Column:
            get = record.__getitem__
            return cell(get) if where is None else F.when(where(get), cell(get))

        return F.transform(self.records, value)

    def _numbers(self, cell: Cell, where: Cell | None = None) -> Column:
        return F.filter(F.transform(self._values(cell, where), lambda v: v.cast("double")), lambda v: v.isNotNull())

    def rows(self) -> Column:
        return F.coalesce(F.size(self.records), F.lit(0)).cast("long")

    def distinct(self, cell: Cell) -> Column:
        return F.size(F.array_distinct(self._values(cell))).cast("long")

    def largest(self, cell: Cell, where: Cell | None = None) -> Column:
        return F.array_max(self._values(cell, where))

    def smallest(self, cell: Cell) -> Column:
        return F.array_min(self._values(cell))

    def total(self, cell: Cell, where: Cell | None = None) -> Column:
        return F.coalesce(F.aggregate(self._numbers(cell, where), F.lit(0.0), lambda total, v: total + v), F.lit(0.0))

    def mean(self, cell: Cell) -> Column:
        return F.try_divide(self.total(cell), F.size(self._numbers(cell)))

    def count(self, where: Cell) -> Column:
        return F.coalesce(F.size(F.filter(self.records, lambda r: where(r.__getitem__))), F.lit(0)).cast("long")

    def newest(self, cell: Cell, order: str, tiebreak: str) -> Column:
        aged = F.transform(self.records, lambda r: F.struct(A.recency(r[order], r[tiebreak]).alias("age"), cell(r.__getitem__).alias("value")))
        return F.array_max(aged)["value"]


History = GroupedHistory | ArrayHistory


def ratio_of_totals(history: History, numerator: Cell, denominator: Cell) -> Column:
    return A.guarded_ratio(history.total(numerator), history.total(denominator))


def newest_ratio(history: History, numerator: Cell, denominator: Cell, order: str, tiebreak: str) -> Column:
    return A.guarded_ratio(history.newest(numerator, order, tiebreak), history.newest(denominator, order, tiebreak))


def field(name: str) -> Cell:
    return lambda c: c(name)
