"""Numeric column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(value: Column) -> Column:
    """NaN is a missing value here; Spark would order it above every number."""
    value = value.cast("double")
    return F.when(~F.isnan(value), value)


def guarded(divisor: Column) -> Column:
    """Divisor with 0 replaced by 1, so a constant column scales to 0."""
    return F.when(divisor == 0, F.lit(1.0)).otherwise(divisor)


def floor_zero(value: Column) -> Column:
    return F.greatest(F.lit(0.0), value)


def rounded(value: Column, digits: int = 2) -> Column:
    """Half-up rounding; adding 0.0 turns a negative zero into zero."""
    return F.round(value, digits) + F.lit(0.0)


def softmax_weight(energy: Column, peak: Column, total: Column) -> Column:
    """Weight of one step, given the peak energy and the sum of ``exp(energy - peak)``."""
    return F.exp(energy - peak) / total


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` with the value computed once per row.

    Inside a lambda an outer expression is computed anew for every element; a
    lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]
