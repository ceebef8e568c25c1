"""Row-level expressions as Spark SQL text.

Arguments and results are SQL text, so expressions nest: ``ratio("a + b", "c")``. Text rather than column objects,
because a block has hundreds of expressions and building each object operator by operator costs more driver time than
planning it. ``with_exprs`` and ``columns`` hand a whole mapping of them to Spark.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lit(value: object) -> str:
    """A Python value as SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def columns(exprs: Mapping[str, str]) -> list[Column]:
    """Name -> expression as named columns."""
    return [F.expr(f"{e} AS `{n}`") for n, e in exprs.items()]


def with_exprs(df: DataFrame, exprs: Mapping[str, str]) -> DataFrame:
    """Add or replace columns; every expression sees the columns as they were before."""
    return df.withColumns({n: F.expr(e) for n, e in exprs.items()})


def safe_name(text: object) -> str:
    """A category value or label as part of a column name."""
    return re.sub(r"\W+", "_", str(text).strip()).strip("_") or "blank"


def flag(condition: str) -> str:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def flag_equals(c: str, value: object) -> str:
    return flag(f"{c} = {lit(value)}")


def flag_all(conditions: Mapping[str, object]) -> str:
    """1 when every listed column matches: a plain value means equality, a pair is (operator, value)."""
    parts = []
    for c, want in conditions.items():
        op, value = want if isinstance(want, tuple) else ("=", want)
        parts.append(f"{c} {op} {lit(value)}")
    return flag(" AND ".join(parts))


def overlapping_buckets(c: str, bounds: Sequence[tuple[float | None, float]]) -> list[str]:
    """One flag per (low, high), both ends inclusive, so a shared edge falls in two buckets."""
    return [flag(f"{c} <= {high}" + ("" if low is None else f" AND {c} >= {low}")) for low, high in bounds]


def sentinel_to_null(c: str, *sentinels: object) -> str:
    return f"CASE WHEN NOT {c} IN ({', '.join(map(lit, sentinels))}) THEN {c} END"


def replace_value(c: str, old: object, new: object) -> str:
    return f"CASE WHEN {c} = {lit(old)} THEN {lit(new)} ELSE {c} END"


def recode(c: str, mapping: Mapping[object, object]) -> str:
    """Dictionary recode; a value outside the dictionary becomes NULL."""
    return f"CASE {c} " + " ".join(f"WHEN {lit(old)} THEN {lit(new)}" for old, new in mapping.items()) + " END"


def fill(c: str, value: object = 0) -> str:
    return f"coalesce({c}, {lit(value)})"


def trunc_int(c: str, kind: str = "INT") -> str:
    """Towards zero; NULL where the value does not fit instead of a failed job."""
    return f"TRY_CAST({c} AS {kind})"


def ratio(a: str, b: str) -> str:
    """a / b as double, NULL when b is zero."""
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


def row_sum(cs: Sequence[str]) -> str:
    """Sum across columns, missing counts as zero."""
    return "(" + " + ".join(f"coalesce({c}, 0)" for c in cs) + ")"


def row_count(cs: Sequence[str]) -> str:
    return "(" + " + ".join(flag(f"{c} IS NOT NULL") for c in cs) + ")"


def row_mean(cs: Sequence[str]) -> str:
    return ratio(row_sum(cs), row_count(cs))


def row_std(cs: Sequence[str]) -> str:
    """Sample standard deviation across the non-missing columns, NULL below two values."""
    mean, n = row_mean(cs), row_count(cs)
    squares = " + ".join(f"coalesce(({c} - {mean}) * ({c} - {mean}), 0D)" for c in cs)
    return f"CASE WHEN {n} >= 2 THEN sqrt(({squares}) / ({n} - 1)) END"


def row_missing_fraction(cs: Sequence[str]) -> str:
    return "(" + " + ".join(flag(f"{c} IS NULL") for c in cs) + f") / {float(len(cs))}D"


def not_past(c: str) -> str:
    """0 for a date before the reference day, 1 otherwise and when the date is unknown."""
    return f"CASE WHEN {c} < 0 THEN 0 ELSE 1 END"


def days_to_years(c: str) -> str:
    return f"abs(TRY_CAST({c} / 365 AS INT))"


def fill_all_numeric(df: DataFrame, value: float = -999) -> DataFrame:
    from relfeat.sources.tables import columns_by_type

    return df.fillna(value, subset=columns_by_type(df, "numeric"))


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Prefix every column of a block except its keys."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in set(keep)})
