"""Filter predicates a report passes in: lists, ranges, search text, known values."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


class Predicate:
    """Condition on one column."""

    def on(self, column: Column) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class OneOf(Predicate):
    """Value list; ``None`` in the list stands for a missing value."""

    values: tuple[Any, ...]

    def on(self, column: Column) -> Column:
        present = [v for v in self.values if v is not None]
        listed = column.isin(present) if present else F.lit(False)
        if len(present) < len(self.values):
            return column.isNull() | F.coalesce(listed, F.lit(False))
        return listed


@dataclass(frozen=True)
class Known(Predicate):
    """Everything but a missing value."""

    def on(self, column: Column) -> Column:
        return column.isNotNull()


@dataclass(frozen=True)
class HalfOpen(Predicate):
    """Range with its start and without its end; either side may be open."""

    start: Any = None
    end: Any = None

    def on(self, column: Column) -> Column:
        condition = F.lit(True)
        if self.start is not None:
            condition = condition & (column >= F.lit(self.start))
        if self.end is not None:
            condition = condition & (column < F.lit(self.end))
        return condition


@dataclass(frozen=True)
class Contains(Predicate):
    """Text search that ignores case."""

    text: str

    def on(self, column: Column) -> Column:
        return F.contains(F.lower(column), F.lower(F.lit(self.text)))


@dataclass(frozen=True)
class Above(Predicate):
    bound: float

    def on(self, column: Column) -> Column:
        return column > F.lit(self.bound)


@dataclass(frozen=True)
class IsFalseOrBlank(Predicate):
    """FALSE as the measure language compares it: a blank counts as FALSE."""

    def on(self, column: Column) -> Column:
        return ~F.coalesce(column, F.lit(False))
