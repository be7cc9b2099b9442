"""Small building blocks of column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row, within one projection."""
    return F.element_at(F.transform(F.array(value), body), 1)


def halvings(n: Column, most: int = 1 << 20) -> Column:
    """The steps that find a place among ``n`` sorted values, ``most`` at the most: powers of two, largest first."""
    steps = F.expr(f"array({', '.join(str(1 << k) for k in range(most.bit_length() - 1, -1, -1))})")
    return F.filter(steps, lambda step: step <= n)


def first_above(values: Column, at: Column, steps: Column) -> Column:
    """Index of the first of some sorted values that exceeds ``at``, by the :func:`halvings` of their number."""

    def search(a: Column) -> Column:
        # beyond the end get gives null, and the step is not taken
        return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(values, low + step - 1) <= a, low + step).otherwise(low))

    return let(at, search)
