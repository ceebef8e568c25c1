"""Filling missing values from statistics, each as a fit on one frame and a transform on another."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from relfeat.functions.aggs import by_name
from relfeat.functions.expr import columns as named
from relfeat.functions.expr import lit, with_exprs
from relfeat.operators.grouping import aggregate
from relfeat.operators.joins import as_list, attach_sized, sized


def _group_exprs(groups: Sequence[str], null_as_group: bool) -> dict[str, str]:
    """Copies of the group columns to join on; as a group, a missing value is told apart by a second column."""
    if not null_as_group:
        return {f"__g{i}": g for i, g in enumerate(groups)}
    out = {}
    for i, g in enumerate(groups):
        out[f"__g{i}"] = f"coalesce(CAST({g} AS STRING), '')"
        out[f"__n{i}"] = f"{g} IS NULL"
    return out


@dataclass(frozen=True)
class GroupStats:
    """A statistic per category, fitted on one frame and applicable to any other with the same columns."""

    keys: dict[str, str]
    columns: list[str]
    table: DataFrame
    small: bool

    def attach(self, df: DataFrame) -> DataFrame:
        return attach_sized(with_exprs(df, self.keys), self.table, self.small, list(self.keys)).drop(*self.keys)


def fit_group(
    df: DataFrame, groups: str | Sequence[str], columns: Sequence[str], how: str = "median", null_as_group: bool = False
) -> GroupStats:
    """Median or mean of each column per category."""
    keys = _group_exprs(as_list(groups), null_as_group)
    rows = df.select(*named(keys), *columns)
    stats = aggregate(rows, list(keys), {f"__fill_{c}": by_name(how, c) for c in columns})
    return GroupStats(keys, list(columns), *sized(stats))


def impute_group(df: DataFrame, stats: GroupStats) -> DataFrame:
    """Missing values become the statistic of the row's category."""
    filled = with_exprs(stats.attach(df), {c: f"coalesce({c}, __fill_{c})" for c in stats.columns})
    return filled.drop(*[f"__fill_{c}" for c in stats.columns])


def lookup_group(df: DataFrame, stats: GroupStats, column: str, name: str) -> DataFrame:
    """New column: the statistic of ``column`` for the row's category."""
    found = stats.attach(df).withColumnRenamed(f"__fill_{column}", name)
    return found.drop(*[f"__fill_{c}" for c in stats.columns])


def fit_mean(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Column means as constants: one row comes back."""
    row = df.agg(*named({c: f"avg({c})" for c in columns})).first()
    return {c: row[c] for c in columns if row[c] is not None}


def impute_mean(df: DataFrame, means: dict[str, float]) -> DataFrame:
    return with_exprs(df, {c: f"coalesce({c}, {lit(m)})" for c, m in means.items()})


def fit_missing(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """The columns that have a missing value; one scan decides."""
    names = df.columns if columns is None else list(columns)
    row = df.agg(*named({c: f"max(`{c}` IS NULL)" for c in names})).first()
    return [c for c in names if row[c]]


def missing_indicators(df: DataFrame, fitted: Sequence[str] | None = None) -> DataFrame:
    """``is_nan_<column>`` for the fitted columns, so that every frame gets the same ones; without, fitted on ``df``."""
    names = fit_missing(df) if fitted is None else fitted
    return with_exprs(df, {f"is_nan_{c}": f"CAST(`{c}` IS NULL AS INT)" for c in names})


def fit_standardize(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, as constants."""
    stats = {f"m_{c}": f"avg({c})" for c in columns} | {f"s_{c}": f"stddev_pop({c})" for c in columns}
    row = df.agg(*named(stats)).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns if row[f"m_{c}"] is not None}


def standardize(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """z-scores; a constant column is only centred."""
    return with_exprs(df, {c: f"({c} - {lit(m)}) / {lit(s)}" for c, (m, s) in fitted.items()})
