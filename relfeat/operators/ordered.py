"""Operators on the time order inside a group: gaps, last value, most recent k rows, last loan, trends.

Month and day columns are relative integers, larger meaning more recent. Every order ends in a unique tie-break,
because rows of the same month are otherwise in no order at all: of equally recent rows the one with the largest
loan id counts as the most recent, everywhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relfeat.functions.aggs import by_name
from relfeat.functions.expr import columns, flag, ratio, with_exprs
from relfeat.operators.grouping import Nested, Spec, aggregate
from relfeat.operators.joins import all_known, as_list, keyed_join
from relfeat.operators.running import cut_by_range

RANK = "__rank"


def lag_diff(df: DataFrame, key: str, time: str, tie: str, name: str, parts: int | None = None) -> DataFrame:
    """Time to the next more recent row of the group; 0 for the most recent row and where the time is missing.

    Rows that share a time differ by 0 except the first of them (smallest ``tie``), so only the distinct times of a
    group are ordered. They are cut by range, a group with many of them at its own times, and scanned within a cut; the
    most recent time of a cut meets the least recent one of the group's next cut, which is carried over from one row
    per cut and group. The gaps return to their row by (key, time, tie).
    """
    times = df.where(all_known([key, time])).groupBy(key, time).agg(F.min(tie).alias(tie))
    times = cut_by_range(times, [key, time], parts)
    after = f"lead(__least) OVER (PARTITION BY {key} ORDER BY __part) AS __after"
    borders = times.groupBy(key, "__part").agg(F.min(time).alias("__least")).selectExpr(key, "__part", after)
    borders = borders.where("__after IS NOT NULL")
    next_time = f"lead({time}) OVER (PARTITION BY {key}, __part ORDER BY {time})"
    inside = times.selectExpr(key, "__part", time, tie, f"{next_time} AS __next")
    gaps = keyed_join(inside, borders, [key, "__part"], "left")
    gaps = gaps.selectExpr(key, time, tie, f"coalesce(__next, __after) - {time} AS {name}").where(f"{name} IS NOT NULL")
    return df.join(gaps, [key, time, tie], "left").withColumn(name, F.expr(f"coalesce({name}, 0)"))


def last_known(value: str, time: str, ties: Sequence[str]) -> str:
    """Aggregate: the value of the most recent row that has one."""
    return f"max_by({value}, CASE WHEN {value} IS NOT NULL THEN struct({', '.join([time, *ties])}) END)"


def last_by_order(df: DataFrame, key: str, value: str, time: str, ties: Sequence[str], name: str) -> DataFrame:
    return aggregate(df, key, {name: last_known(value, time, ties)})


def recent_rows(df: DataFrame, key: str, time: str, ties: Sequence[str], k: int) -> DataFrame:
    """The k most recent rows of each group, numbered from 1 in ``__rank``; of equally recent ones the largest ties first.

    Each task keeps at most k rows per group before the shuffle, so no group arrives whole anywhere, whatever k.
    """
    limit = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark = df.sparkSession
    if 0 <= int(spark.conf.get(limit, "1000")) < k:  # beyond it Spark would not cut before the shuffle
        spark.conf.set(limit, k)
    order = Window.partitionBy(key).orderBy(F.col(time).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties])
    return df.where(all_known([key])).withColumn(RANK, F.row_number().over(order)).where(F.col(RANK) <= k)


def within(k: int, c: str) -> str:
    return f"CASE WHEN {RANK} <= {k} THEN {c} END"


def last_k_columns(ks: Sequence[int], specs: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Aggregates over ``recent_rows``: ``last_{k}_{column}_{aggregate}`` for every k in one pass."""
    out: dict[str, str] = {}
    for k in ks:
        for c, aggs in specs.items():
            for a in aggs:
                # a median of at most k rows: the exact percentile holds them all
                out[f"last_{k}_{c}_{a}"] = (
                    f"percentile({within(k, c)}, 0.5D)" if a == "median" else by_name(a, within(k, c))
                )
    return out


def trend_columns(ks: Sequence[int], cs: Sequence[str]) -> dict[str, str]:
    """Aggregates over ``recent_rows``: least-squares slope on the row position, newest row first.

    A single row has slope 0; a missing value among the k rows makes the slope missing.
    """
    out: dict[str, str] = {}
    for k in ks:
        n = f"sum({flag(f'{RANK} <= {k}')})"
        for c in cs:
            slope = f"regr_slope(CAST({within(k, c)} AS DOUBLE), CAST({RANK} - 1 AS DOUBLE))"
            out[f"{k}_period_trend_{c}"] = (
                f"CASE WHEN count({within(k, c)}) < {n} THEN NULL WHEN {n} = 1 THEN 0D ELSE {slope} END"
            )
    return out


def last_k_aggregate(
    df: DataFrame,
    key: str,
    time: str,
    ties: Sequence[str],
    ks: Sequence[int],
    specs: Mapping[str, Sequence[str]],
    whole: bool = True,
    trends: Mapping[str, Sequence[int]] | None = None,
    **options,
) -> DataFrame:
    """Aggregates over the last k rows of each group for all k at once, over the whole history too if asked.

    The recent rows are ranked; the whole history needs no order and is a plain grouped aggregate.
    """
    aggs = last_k_columns(ks, specs)
    longest = list(ks)
    for c, periods in (trends or {}).items():
        aggs.update(trend_columns(periods, [c]))
        longest += periods
    needed = list(dict.fromkeys([key, time, *ties, *specs, *(trends or {})]))
    recent = recent_rows(df.select(*needed), key, time, ties, max(longest))
    result = recent.groupBy(key).agg(*columns(aggs))
    if whole:
        history = {f"all_installment_{c}_{a}": by_name(a, c) for c, names in specs.items() for a in names}
        result = result.join(aggregate(df, key, history, **options), key, "left")
    return result


def last_group_aggregate(
    df: DataFrame, key: str, inner: str, time: str, specs: Sequence[Spec], prefix: str = "last_loan_"
) -> DataFrame:
    """Aggregates over the rows of each group's most recent loan (largest loan id among equally recent ones).

    Every loan is aggregated, then the latest one is picked: two combinable aggregations, no ordering of rows.
    """
    return unpacked(last_group(Nested(), inner, time, specs, prefix).run(df, key, inner))


LAST = "__last"


def last_group(nested: Nested, inner: str, time: str, specs: Sequence[Spec], prefix: str = "last_loan_") -> Nested:
    """Add the aggregates of the most recent inner group to a two-level grouping; ``unpacked`` gives them their columns."""
    fields = [f"{nested.carry(by_name(a, c))} AS `{prefix}{c}_{a}`" for c, a in specs]
    nested.outer[LAST] = f"max_by(struct({', '.join(fields)}), struct({nested.carry(f'max({time})')}, {inner}))"
    return nested


def unpacked(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c != LAST], f"{LAST}.*")


def trend_slope(
    df: DataFrame, key: str, time: str, ties: Sequence[str], ks: Sequence[int], cs: Sequence[str]
) -> DataFrame:
    return last_k_aggregate(df, key, time, ties, [], {}, whole=False, trends={c: ks for c in cs})


def period_fraction(df: DataFrame, short: int, long: int) -> DataFrame:
    """Short-period features divided by the long-period ones: ``_{short}_`` becomes ``_{short}by{long}_fraction_``."""
    out: dict[str, str] = {}
    for name in df.columns:
        if f"last_{short}_" in name:
            other = name.replace(f"last_{short}_", f"last_{long}_")
            if other in df.columns:
                out[name.replace(f"_{short}_", f"_{short}by{long}_fraction_", 1)] = ratio(name, other)
    return with_exprs(df, out)


def late_flags(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """0/1 columns telling whether a days-past-due column is positive; unknown is 0."""
    return with_exprs(df, {name: flag(f"{c} > 0") for name, c in flags.items()})


def sort_rows(df: DataFrame, *order: str | Column) -> DataFrame:
    """Total order of the output; ``-name`` sorts descending."""
    keys = [F.col(o[1:]).desc() if isinstance(o, str) and o.startswith("-") else o for o in order]
    return df.orderBy(*keys)


def top_n(df: DataFrame, n: int, by: str, ties: str | Sequence[str] = ()) -> DataFrame:
    """The n rows with the largest value; every task keeps its own n first."""
    return df.orderBy(F.col(by).desc_nulls_last(), *as_list(ties)).limit(n)


def in_top(df: DataFrame, key: str, k: int) -> DataFrame:
    """The rows whose key is among the ``k`` most frequent ones (ties: the smaller key)."""
    counts = df.where(all_known([key])).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    # k rows by construction
    return df.join(F.broadcast(top_n(counts, k, "__n", key).select(key)), key, "left_semi")
