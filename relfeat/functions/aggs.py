"""Aggregates as Spark SQL text. Each one is algebraic, so Spark combines it on the map side before any shuffle.

Quantiles and distinct counts are the exceptions: they are described here (``Quantile``, ``Distinct``) and computed by
``relfeat.operators.running`` and ``relfeat.operators.grouping`` from the values that occur.
"""

from __future__ import annotations

from dataclasses import dataclass

from relfeat.functions.expr import flag, lit, ratio

ROWS = "count(1)"


@dataclass(frozen=True)
class Quantile:
    """Exact interpolated quantile ``q`` of a column; ``minus`` gives a difference of two quantiles."""

    column: str
    q: float
    minus: float | None = None


@dataclass(frozen=True)
class Distinct:
    """Number of distinct values of a column, missing ones not counted."""

    column: str


def total(c: str) -> str:
    """Group sum in which an all-missing group is 0."""
    return f"coalesce(sum({c}), 0)"


def weighted_mean(c: str, weight: str, skip_null: bool = False) -> str:
    """Weighted mean of a group.

    By default one missing value or weight makes the result missing; with ``skip_null`` such rows are left out.
    """
    product = f"CAST({c} AS DOUBLE) * {weight}"
    # if nothing may be missing, all columns of a block share the sum and the count of their weights
    weights = f"CASE WHEN {c} IS NOT NULL THEN {weight} END" if skip_null else weight
    mean = f"try_divide(sum({product}), sum({weights}))"
    return mean if skip_null else f"CASE WHEN count({c}) = {ROWS} AND count({weight}) = {ROWS} THEN {mean} END"


def recency_weight(months: str) -> str:
    """Recent months weigh most: -1 / month for months counted backwards; month 0 has no weight."""
    return f"try_divide(-1D, CAST({months} AS DOUBLE))"


def count_if(condition: str) -> str:
    """Rows for which the condition is true; unknown counts as false."""
    return f"sum({flag(condition)})"


def count_not_zero(c: str) -> str:
    """Rows whose value is not zero; a missing value is not zero."""
    return f"sum(CASE WHEN {c} <=> 0 THEN 0 ELSE 1 END)"


def percent_if(condition: str) -> str:
    """100 x share of all rows for which the condition is true."""
    return ratio(f"100 * sum({flag(condition)})", ROWS)


def share(c: str, value: object) -> str:
    """Share of a category among the rows of the group; a missing category belongs to none."""
    return f"avg({flag(f'{c} = {lit(value)}')})"


def span(c: str) -> str:
    return f"max({c}) - min({c})"


_BY_NAME = {
    "sum": total,
    "mean": "avg({})".format,
    "max": "max({})".format,
    "min": "min({})".format,
    "std": "stddev_samp({})".format,
    "var": "var_samp({})".format,
    "count": "count({})".format,
    "skew": "skewness({})".format,
    "kurt": "kurtosis({})".format,
}


def by_name(name: str, column: str) -> str | Quantile | Distinct:
    """The aggregate a specification names: SQL text, a ``Quantile`` for median and iqr, ``Distinct`` for nunique."""
    if name == "nunique":
        return Distinct(column)
    if name == "median":
        return Quantile(column, 0.5)
    if name == "iqr":
        return Quantile(column, 0.75, minus=0.25)
    if name not in _BY_NAME:
        raise ValueError(f"unknown aggregate {name!r}")
    return _BY_NAME[name](column)
