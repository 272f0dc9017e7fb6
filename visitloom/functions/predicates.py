"""Optional predicates: ``None`` stands for "parameter not given"."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def between(column: Column, low: int | None, high: int | None) -> Column | None:
    """Inclusive range; off unless both ends are given."""
    if low is None or high is None:
        return None
    return column.between(low, high)


def one_of(column: Column, values: Sequence[object] | None) -> Column | None:
    if values is None:
        return None
    return column.isin(*values) if values else F.lit(False)


def equal(column: Column, value: object | None) -> Column | None:
    return None if value is None else column == F.lit(value)


def any_overlap(array: Column, values: Sequence[object] | None) -> Column | None:
    """True when the array column shares an element with ``values``."""
    if values is None:
        return None
    if not values:
        return F.lit(False)
    return F.arrays_overlap(array, F.array(*(F.lit(v) for v in values)))


def all_of(predicates: Iterable[Column | None]) -> Column:
    """Conjunction of the predicates that are on; true when none is."""
    given = [p for p in predicates if p is not None]
    return reduce(lambda a, b: a & b, given, F.lit(True))
