"""Reading tables, choosing columns, writing predictions and feature matrices."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relfeat.functions.expr import lit

_TYPE_GROUPS = {
    "string": (T.StringType,),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "float": (T.FloatType, T.DoubleType, T.DecimalType),
}
_TYPE_GROUPS["numeric"] = _TYPE_GROUPS["integer"] + _TYPE_GROUPS["float"]


Condition = tuple[str, str, object]  # (column, operator, value)
_OPERATORS = ("=", "<>", "<", "<=", ">", ">=", "in")


def scan_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    guard_nan: bool = True,
    where: Sequence[Condition] = (),
) -> DataFrame:
    """Read a parquet table or a headered CSV.

    CSV wants an explicit ``schema`` so that no inference pass reads the file twice; without one the types are inferred.
    ``guard_nan`` turns NaN into NULL. A filter on a guarded column does not reach the scan, so the conditions of
    ``where``, all of which must hold, are applied below the guard: the comparison itself is pushed into the scan, and
    NaN, which is missing and meets no condition, is ruled out beside it.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    df = reader.load(path)
    for text in conditions(df, where, guard_nan):
        df = df.where(text)
    return nan_to_null(df) if guard_nan else df


def conditions(df: DataFrame, where: Sequence[Condition], guard_nan: bool = True) -> list[str]:
    """The conditions as SQL text; with ``guard_nan`` a NaN meets none of them. A missing value never does."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for column, operator, value in where:
        if column not in kinds or operator not in _OPERATORS:
            raise ValueError(f"no condition on a column of this table: {column!r} {operator!r}")
        values = f"({', '.join(map(lit, value))})" if operator == "in" else lit(value)
        out.append(f"`{column}` {operator} {values}")
        if guard_nan and isinstance(kinds[column], (T.FloatType, T.DoubleType)):
            out.append(f"NOT isnan(`{column}`)")
    return out


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing is NULL everywhere in this library; Spark would treat NaN as the largest number."""
    wanted = set(columns) if columns is not None else None
    out = []
    for field in df.schema.fields:
        is_float = isinstance(field.dataType, (T.FloatType, T.DoubleType))
        c = F.col(f"`{field.name}`")
        if is_float and (wanted is None or field.name in wanted):
            c = F.when(~F.isnan(c), c).alias(field.name)
        out.append(c)
    return df.select(*out)


def columns_by_type(df: DataFrame, group: str) -> list[str]:
    """Names of the ``string``, ``integer``, ``float`` or ``numeric`` columns; reads only the schema."""
    kinds = _TYPE_GROUPS[group]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def columns_by_pattern(df: DataFrame, pattern: str) -> list[str]:
    """Names of the columns in which the regular expression occurs."""
    return [c for c in df.columns if re.search(pattern, c)]


def columns_by_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names of the columns from ``first`` to ``last``, both included."""
    names = df.columns
    return names[names.index(first) : names.index(last) + 1]


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows, number of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("int").alias("n_columns"))


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    """(name, type) of every column, from the schema alone."""
    return list(df.dtypes)


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """Some ``n`` rows; only as many partitions are read as that takes."""
    return df.limit(n)


def write_predictions(df: DataFrame, key: str, score: str, path: str, mode: str = "errorifexists") -> None:
    """Write ``(key, score)`` as headered CSV, one file per task."""
    df.select(key, score).write.mode(mode).option("header", True).csv(path)


def write_feature_matrix(df: DataFrame, path: str, split: str | None = None, mode: str = "errorifexists") -> None:
    """Write the wide matrix as parquet, optionally in one folder per split value."""
    writer = df.write.mode(mode)
    if split:
        writer = writer.partitionBy(split)
    writer.parquet(path)
