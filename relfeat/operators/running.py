"""Running totals and exact quantiles over groups of any size.

A window ordered over one huge group would run in one task. Running totals first cut the ordered values into buckets at
approximate quantiles, which are constants of the plan; quantiles and gaps cut the common order of group and value into
stored parts. Either way a recomputed task sees the same cuts, and they influence only the balance of the work.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfeat.functions.aggs import Quantile
from relfeat.functions.expr import columns
from relfeat.operators.joins import attach, keyed_join
from relfeat.session import stored

BUCKETS = 1_000


def bucketed(df: DataFrame, column: str, fit_on: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Add ``__bucket``, non-decreasing in ``column``; a bucket holds about 1/buckets of the fitted rows."""
    source = df if fit_on is None else fit_on
    probs = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(source.approxQuantile(column, probs, 1.0 / (2 * buckets)))) if probs else []
    if not cuts:
        return df.withColumn("__bucket", F.lit(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    return Bucketizer(splits=splits, inputCol=column, outputCol="__bucket", handleInvalid="keep").transform(df)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    totals: Mapping[str, str],
    descending: bool = False,
    fit_on: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Inclusive running sums per group along ``order``; ``totals`` maps new column to summed column.

    ``df`` has one row per (keys, order). Work per task is one bucket of one group; the bucket totals
    (at most ``buckets`` rows per group) are accumulated in a second, small window.
    """
    names = df.columns
    df = bucketed(df.where(f"{order} IS NOT NULL"), order, fit_on, buckets)
    by, way = ", ".join(keys), "DESC" if descending else "ASC"
    earlier = f"OVER (PARTITION BY {by} ORDER BY __bucket {way} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    before = (
        df.groupBy(*keys, "__bucket")
        .agg(*columns({f"__t_{n}": f"sum({c})" for n, c in totals.items()}))
        .selectExpr(*keys, "__bucket", *[f"coalesce(sum(__t_{n}) {earlier}, 0) AS __b_{n}" for n in totals])
    )
    inside = f"OVER (PARTITION BY {by}, __bucket ORDER BY {order} {way} ROWS UNBOUNDED PRECEDING)"
    local = df.selectExpr("*", *[f"sum({c}) {inside} AS __l_{n}" for n, c in totals.items()])
    joined = attach(local, before, [*keys, "__bucket"])
    return joined.selectExpr(*names, *[f"__l_{n} + __b_{n} AS {n}" for n in totals])


def cut_by_range(df: DataFrame, by: Sequence[str], parts: int | None = None) -> DataFrame:
    """Store ``df`` cut along the common order of the columns ``by``, with the number of the cut in ``__part``.

    The cut points are Spark's own sample of that order, so with keys first a group of many rows is cut at its own
    values and small groups share a part. They balance the work; no result depends on them. Being stored, a lost task
    cannot move a row to another part.
    """
    ranged = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    return stored(ranged.withColumn("__part", F.spark_partition_id()), "cuts")


def group_quantiles(
    df: DataFrame, keys: Sequence[str], quantiles: Mapping[str, Quantile], null_safe: bool = False, parts: int | None = None
) -> DataFrame:
    """One row per group with exact interpolated quantiles, by rank selection over counted values.

    All columns go through one scan: (keys, column number, value) with its number of rows, combined before the shuffle.
    These are cut by range, so that a group of any size is spread; counts per cut tell which cut of a group holds a
    wanted rank, and only there values are ranked, in windows of one cut that spill. A group without values has NULLs.
    """
    cs = list(dict.fromkeys(q.column for q in quantiles.values()))
    slots = ", ".join(f"{i}, CAST({c} AS DOUBLE)" for i, c in enumerate(cs))
    long = df.selectExpr(*keys, f"stack({len(cs)}, {slots}) AS (__c, __v)")
    # a missing value is a level of no rows, which keeps its group
    levels = long.groupBy(*keys, "__c", "__v").agg(F.expr("count(__v) AS __n"))
    group = [*keys, "__c"]
    levels = cut_by_range(levels, [*group, "__v"], parts)
    by = ", ".join(group)
    upto = f"sum(__n) OVER (PARTITION BY {by} ORDER BY __part ROWS UNBOUNDED PRECEDING)"
    ranges = (
        levels.groupBy(*group, "__part")
        .agg(F.expr("sum(__n) AS __n"))
        .selectExpr(*group, "__part", f"{upto} - __n AS __before", f"{upto} AS __upto", f"sum(__n) OVER (PARTITION BY {by}) AS __all")
    )
    wanted = sorted({(cs.index(q.column), p) for q in quantiles.values() for p in (q.q, q.minus) if p is not None})
    spots = {w: (f"floor({w[1]}D * (__all - 1))", f"ceil({w[1]}D * (__all - 1))") for w in wanted}
    holds = [f"(__c = {c} AND {r} >= __before AND {r} < __upto)" for (c, _), pair in spots.items() for r in pair]
    targets = ranges.where(" OR ".join(["__all = 0", *holds]))
    inside = keyed_join(levels, targets, [*group, "__part"], "inner", null_safe)
    last = f"__before + sum(__n) OVER (PARTITION BY {by}, __part ORDER BY __v ROWS UNBOUNDED PRECEDING)"
    inside = inside.selectExpr(*group, "__v", "__n", "__all", f"{last} AS __last")
    picks, at = {}, {}
    for i, ((c, p), (low, high)) in enumerate(spots.items()):
        for name, r in ((f"__lo{i}", low), (f"__hi{i}", high)):
            picks[name] = f"max(CASE WHEN __c = {c} AND {r} >= __last - __n AND {r} < __last THEN __v END)"
        picks[f"__frac{i}"] = f"max(CASE WHEN __c = {c} THEN {p}D * (__all - 1) - {low} END)"
        at[c, p] = f"__lo{i} + (__hi{i} - __lo{i}) * __frac{i}"
    result = {}
    for name, q in quantiles.items():
        c = cs.index(q.column)
        result[name] = at[c, q.q] if q.minus is None else f"({at[c, q.q]}) - ({at[c, q.minus]})"
    picked = inside.groupBy(*keys).agg(*columns(picks))
    return picked.select(*keys, *columns(result))
