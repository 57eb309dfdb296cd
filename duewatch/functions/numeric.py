"""Column expressions on numbers and months."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(columns: list[Column]) -> Column:
    return reduce(lambda left, right: left + right, columns)


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as a double, null for a zero divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def step_bucket(value: Column, edges: list[float]) -> Column:
    """Index of the first edge above ``value``; past the last edge, or null, the last index."""
    steps = [F.when(value < edge, F.lit(place)) for place, edge in enumerate(edges)]
    return F.coalesce(*steps, F.lit(len(edges)))


def row_variance(columns: list[Column], mean: Column) -> Column:
    """Population variance across the columns of one row."""
    squares = [(column - mean) * (column - mean) for column in columns]
    return total(squares) / F.lit(float(len(columns)))


def month_start(value: Column) -> Column:
    return F.trunc(value, "month")


def next_month_start(value: Column) -> Column:
    """The value itself when it is the first of a month, else the next first."""
    first = month_start(value)
    return F.when(first == value.cast("date"), first).otherwise(F.add_months(first, 1))


def one_month() -> Column:
    return F.expr("interval 1 month")
