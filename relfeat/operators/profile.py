"""Column profiles: missing values, frequencies, target rates, correlations, histograms."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfeat.functions.aggs import ROWS, count_if
from relfeat.functions.expr import columns as named
from relfeat.functions.expr import lit

# Rows that give the scale of sums of products; no result depends on it beyond rounding.
SCALE_ROWS = 1_000


def missing_profile(df: DataFrame) -> DataFrame:
    """Per column the number and percentage of missing rows, most missing first; one scan for all columns."""
    counts = df.agg(*named({"__n": ROWS, **{c: count_if(f"{c} IS NULL") for c in df.columns}}))
    long = counts.unpivot("__n", df.columns, "column_name", "missing")
    return long.selectExpr(
        "column_name", "coalesce(missing, 0) AS missing", "try_divide(missing * 100D, CAST(__n AS DOUBLE)) AS percent"
    ).orderBy(F.desc("missing"), "column_name")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each present value, most frequent first."""
    counts = df.where(f"{column} IS NOT NULL").groupBy(column).agg(F.expr("count(1) AS n"))
    return counts.orderBy(F.desc("n"), column)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def target_rate_by_category(df: DataFrame, category: str, target: str) -> DataFrame:
    """Rows and mean target per present category, highest rate first."""
    rates = (
        df.where(f"{category} IS NOT NULL")
        .groupBy(category)
        .agg(*named({"contracts": ROWS, "target_rate": f"avg({target})"}))
    )
    return rates.orderBy(F.desc("target_rate"), category)


def sampled_scale(df: DataFrame, columns: Sequence[str], rows: int = SCALE_ROWS) -> list[tuple[float, float]] | None:
    """A centre and a width per column from some rows; None without rows. Correlations do not depend on them; sums of products lose
    fewer digits when the values lie around 0 and are of order 1."""
    stats = {f"m{i}": f"avg({_number(c)})" for i, c in enumerate(columns)}
    stats |= {f"s{i}": f"stddev_pop({_number(c)})" for i, c in enumerate(columns)}
    found = df.select(*columns).limit(rows).agg(*named({"n": ROWS, **stats})).first()
    return None if found.n == 0 else [(found[f"m{i}"] or 0.0, found[f"s{i}"] or 1.0) for i in range(len(columns))]


def _number(c: str) -> str:
    """As double; NaN is missing."""
    return f"nullif(CAST({c} AS DOUBLE), double('NaN'))"


def moment_vectors(df: DataFrame, columns: Sequence[str], scale: Sequence[tuple[float, float]]) -> DataFrame:
    """One vector per row: the scaled values (0 where missing), which of them are present, and their squares."""
    values = ", ".join(f"({_number(c)} - {lit(m)}) / {lit(s)}" for c, (m, s) in zip(columns, scale))
    parts = ["coalesce(x, 0D)", "CASE WHEN x IS NULL THEN 0D ELSE 1D END", "coalesce(x * x, 0D)"]
    rows = df.selectExpr(f"array({values}) AS a")
    return rows.select(array_to_vector(F.concat(*[F.expr(f"transform(a, x -> {p})") for p in parts])).alias("v"))


def correlations(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """The matrix of correlations, each over the rows in which both columns are present; NaN where there is none.

    Counts, sums, squares and products of every pair are blocks of the Gram matrix of ``moment_vectors``: tasks add
    their rows to one triangle, the triangles are added up a tree, and one matrix of (3 x columns) squared numbers comes
    back. One scan, however many columns.
    """
    d = len(columns)
    scale = sampled_scale(df, columns) if d else None
    if scale is None:
        return np.full((d, d), np.nan)
    vectors = MLUtils.convertVectorColumnsFromML(moment_vectors(df, columns, scale), "v")
    gram = RowMatrix(vectors, numCols=3 * d).computeGramianMatrix().toArray()
    x, mask, square = slice(0, d), slice(d, 2 * d), slice(2 * d, 3 * d)
    n, sums, squares = gram[mask, mask], gram[x, mask], gram[square, mask]
    # entry (i, j) of sums and squares: of column i over the rows that have column j
    spread = n * squares - sums * sums
    spread[spread <= 1e-12 * n * squares] = 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        found = (n * gram[x, x] - sums * sums.T) / np.sqrt(spread * spread.T)
    found[(n < 2) | (spread * spread.T == 0)] = np.nan
    found = np.clip(found, -1.0, 1.0)
    varies = ~np.isnan(np.diag(found))
    found[varies, varies] = 1.0
    return found


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every ordered pair, over the rows in which both are present; NULL where one does not vary."""
    found = correlations(df, columns)
    table = pa.table(
        {
            "a": pa.array([a for a in columns for _ in columns], pa.string()), "b": pa.array([*columns] * len(columns), pa.string()),
            "corr": pa.array(found.ravel(), mask=np.isnan(found).ravel()),
        }
    )
    return df.sparkSession.createDataFrame(table, "a string, b string, corr double")


def correlated_columns(df: DataFrame, columns: Sequence[str], threshold: float) -> list[str]:
    """Columns to drop so that no kept pair correlates above the threshold; of a pair the earlier one stays."""
    strong = np.abs(np.nan_to_num(correlations(df, columns))) > threshold
    partners = {a: {b for j, b in enumerate(columns) if j != i and strong[i, j]} for i, a in enumerate(columns)}
    kept: list[str] = []
    for c in columns:
        if not partners[c] & set(kept):
            kept.append(c)
    return [c for c in columns if c not in kept]


def drop_correlated(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    return df.drop(*correlated_columns(df, columns, threshold))


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """(bin, n) over equal-width bins between the extremes; empty bins have no row."""
    x = f"CAST({column} AS DOUBLE)"
    low, high = df.selectExpr(f"min({x})", f"max({x})").first()
    if low is None or low == high:
        place = "0"
    else:
        place = f"CAST(least({bins - 1}, floor(({x} - {lit(low)}) / {lit(high - low)} * {bins})) AS INT)"
    numbered = df.where(f"{column} IS NOT NULL").selectExpr(f"{place} AS bin")
    return numbered.groupBy("bin").agg(F.expr("count(1) AS n"))
