"""Joins that attach something keyed to every row, and the skew handling they share.

Plain left and inner joins between tables are left to Catalyst and adaptive execution. What needs care is
attaching an aggregate of a table to the table's own rows: the rows of one key may be a third of the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relfeat.functions.expr import columns
from relfeat.session import materialize

# A side goes to every executor only after it was counted and found to be within both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20


def as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def left_join(df: DataFrame, other: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Left equi-join; a column name that both sides have besides the keys is an error, not a suffix."""
    keys = as_list(keys)
    check_distinct_names([c for c in df.columns + other.columns if c not in keys])
    return df.join(other, keys, "left")


def inner_join(df: DataFrame, other: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    keys = as_list(keys)
    check_distinct_names([c for c in df.columns + other.columns if c not in keys])
    return df.join(other, keys, "inner")


def check_distinct_names(names: Sequence[str]) -> None:
    """Column names are compared without case, as Spark resolves them."""
    seen: dict[str, str] = {}
    for name in names:
        low = name.lower()
        if low in seen:
            raise ValueError(f"column {name!r} would clash with {seen[low]!r}; prefix one of the blocks")
        seen[low] = name


def all_known(keys: Sequence[str]) -> str:
    return " AND ".join(f"{k} IS NOT NULL" for k in keys)


def row_bytes(schema: T.StructType) -> int:
    """Rough size of a row; a string counts as 20 bytes."""
    return 8 + sum(20 if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType)) else 8 for f in schema.fields)


def sized(df: DataFrame, limit: int | None = None, expect_small: bool = True) -> tuple[DataFrame, bool]:
    """Compute a result once, count it, and mark it for broadcast only when rows and bytes are within the limits.

    A result expected to be small is fetched up to one row past the limit; only if it stays within becomes it a
    constant of the plan. Anything else is checkpointed, so that neither use recomputes it.
    """
    limit = min(BROADCAST_ROWS if limit is None else limit, BROADCAST_BYTES // row_bytes(df.schema))
    if expect_small:
        fetched = df.limit(limit + 1).toArrow()
        if fetched.num_rows <= limit and fetched.nbytes <= BROADCAST_BYTES:
            return F.broadcast(df.sparkSession.createDataFrame(fetched, df.schema)), True
        return materialize(df), False
    df = materialize(df)
    small = df.count() <= limit
    return (F.broadcast(df) if small else df), small


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool = False) -> DataFrame:
    """Equi-join that leaves the columns of ``left`` in place; ``null_safe`` lets a missing key match a missing key."""
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    op = "<=>" if null_safe else "="
    joined = left.join(right, F.expr(" AND ".join(f"{k} {op} __r_{k}" for k in keys)), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{k}" for k in keys])


def attach(
    df: DataFrame,
    stats: DataFrame,
    keys: str | Sequence[str],
    broadcast_rows: int | None = None,
    expect_small: bool = True,
) -> DataFrame:
    """Left-join ``stats`` (one row per key) to every row of ``df``.

    A ``stats`` table whose counted size is small is broadcast and ``df`` is not shuffled at all. Otherwise it is one
    join of ``df`` with a stored table: adaptive execution splits the partition of a hot key, or of missing keys, over
    tasks, which it can because neither side has been grouped by the key in the same stage.
    """
    return attach_sized(df, *sized(stats, broadcast_rows, expect_small), keys)


def attach_sized(df: DataFrame, stats: DataFrame, small: bool, keys: str | Sequence[str]) -> DataFrame:
    """``attach`` for a table that ``sized`` has been through already; ``df`` enters the plan once."""
    keys = as_list(keys)
    check_distinct_names([c for c in df.columns + stats.columns if c not in keys])
    return keyed_join(df, stats, keys, "left")


def broadcast_back(
    df: DataFrame,
    keys: str | Sequence[str],
    aggs: Mapping[str, str],
    broadcast_rows: int | None = None,
    expect_small: bool = False,
) -> DataFrame:
    """Group aggregates attached to every row; a row with a missing key gets missing aggregates."""
    keys = as_list(keys)
    stats = df.where(all_known(keys)).groupBy(*keys).agg(*columns(aggs))
    return attach(df, stats, keys, broadcast_rows, expect_small)


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, name: str, table_key: str | None = None) -> DataFrame:
    """Add column ``name``: the ``value`` that ``table`` (one row per key) holds for the row's key. A plain left join:
    Spark broadcasts ``table`` if its size is known to be small."""
    check_distinct_names([*df.columns, name])
    pairs = table.selectExpr(f"{table_key or key} AS {key}", f"{value} AS {name}")
    return keyed_join(df, pairs, [key], "left")
