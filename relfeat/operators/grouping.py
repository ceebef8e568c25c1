"""Grouped aggregation: all aggregates over the same keys in one pass, quantiles included."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relfeat.functions.aggs import ROWS, Distinct, Quantile, by_name, weighted_mean
from relfeat.functions.expr import columns, with_exprs
from relfeat.operators.joins import all_known, as_list, attach_sized, keyed_join, sized
from relfeat.operators.running import group_quantiles
from relfeat.sources.tables import columns_by_type

Spec = tuple[str, str]  # (column, aggregate name)


def aggregate(
    df: DataFrame,
    keys: str | Sequence[str],
    aggs: Mapping[str, str | Quantile | Distinct],
    null_as_group: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """One row per key with every requested aggregate, all plain ones from one shuffle.

    Sums, counts, means, extremes and moments combine on the map side, so a key with a third of all rows costs
    nothing extra. Quantiles of all columns come from one scan more, by rank selection over counted values, whatever the
    size of a group; ``parts`` is the number of cuts of these (default: that of shuffle partitions). Distinct counts of
    all columns come from another, see ``distinct_counts``.
    """
    keys = as_list(keys)
    if not null_as_group:
        df = df.where(all_known(keys))
    quantiles = {n: a for n, a in aggs.items() if isinstance(a, Quantile)}
    distinct = {n: a.column for n, a in aggs.items() if isinstance(a, Distinct)}
    plain = {n: a for n, a in aggs.items() if isinstance(a, str)}
    results = []
    if plain or not (quantiles or distinct):
        results.append(df.groupBy(*keys).agg(*columns(plain)))
    if quantiles:
        results.append(group_quantiles(df, keys, quantiles, null_as_group, parts))
    if distinct:
        results.append(distinct_counts(df, keys, distinct))
    result = reduce(lambda a, b: keyed_join(a, b, keys, "left", null_as_group), results)
    return result.select(*keys, *aggs)


def distinct_counts(df: DataFrame, keys: Sequence[str], counted: Mapping[str, str]) -> DataFrame:
    """One row per key: the number of distinct values of each column of ``counted``, 0 where all are missing.

    (key, column number, value) is made distinct once, before the shuffle as far as a task sees repeats, so a key with
    very many rows is spread over its values; what is left is a count per column. No row is copied through any other
    aggregate. Whole numbers are compared as such, anything else as text.
    """
    cs = list(dict.fromkeys(counted.values()))
    whole = [isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for f in df.selectExpr(*cs).schema.fields]
    number = [f"CAST({c} AS BIGINT)" if w else "CAST(NULL AS BIGINT)" for c, w in zip(cs, whole)]
    # adding 0 makes one value of both zeros
    real = [isinstance(f.dataType, (T.FloatType, T.DoubleType)) for f in df.selectExpr(*cs).schema.fields]
    text = ["CAST(NULL AS STRING)" if w else f"CAST({c}{' + 0' if r else ''} AS STRING)" for c, w, r in zip(cs, whole, real)]
    slots = ", ".join(f"{i}, {n}, {t}" for i, (n, t) in enumerate(zip(number, text)))
    values = df.selectExpr(*keys, f"stack({len(cs)}, {slots}) AS (__c, __i, __s)").distinct()
    counts = {n: f"count(CASE WHEN __c = {cs.index(c)} AND (__i IS NOT NULL OR __s IS NOT NULL) THEN 1 END)" for n, c in counted.items()}
    return values.groupBy(*keys).agg(*columns(counts))


def aggregate_named(
    df: DataFrame, keys: str | Sequence[str], specs: Sequence[Spec], prefix: str = "", **options
) -> DataFrame:
    """Aggregates chosen by name, called ``{prefix}{column}_{aggregate}``."""
    return aggregate(df, keys, {f"{prefix}{c}_{a}": by_name(a, c) for c, a in specs}, **options)


def all_numeric_mean(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Mean of every numeric column that is not a key."""
    keys = as_list(keys)
    return aggregate(df, keys, {c: f"avg({c})" for c in columns_by_type(df, "numeric") if c not in keys})


def all_weighted_mean(df: DataFrame, keys: str | Sequence[str], weight: str, leave: Sequence[str] = ()) -> DataFrame:
    """Weighted mean of every numeric column that is neither a key nor in ``leave``."""
    keys = as_list(keys)
    names = [c for c in columns_by_type(df, "numeric") if c not in (*keys, *leave)]
    return aggregate(df, keys, {c: weighted_mean(c, weight) for c in names})


class Nested:
    """Aggregates of a two-level grouping (customer, loan) -> customer, from one scan.

    The rows shuffle by the finer key, where a customer with very many rows is spread over the loans. Statistics of the
    outer key alone (``beside``) travel as partial states of each inner group (counts, sums, extremes) and are merged.
    """

    def __init__(self) -> None:
        self.inner: dict[str, str] = {}
        self.outer: dict[str, str] = {}

    def carry(self, inner: str) -> str:
        """The name under which an aggregate of the inner groups is known to the outer ones; equal ones are computed once."""
        known = {agg: n for n, agg in self.inner.items()}
        name = known.get(inner, f"__i{len(self.inner)}")
        self.inner[name] = inner
        return name

    def of_groups(self, name: str, inner: str, outer: str) -> Nested:
        """``outer``, a text with ``{}``, applied to the values that ``inner`` has per inner group."""
        self.outer[name] = outer.format(self.carry(inner))
        return self

    def group_count(self, name: str) -> Nested:
        self.outer[name] = ROWS
        return self

    def beside(self, aggs: Mapping[str, str]) -> Nested:
        """Aggregates over all rows of the outer key: expressions over sum, avg, count, min, max and max_by."""
        for name, text in aggs.items():
            self.outer[name] = merged_states(text, self.carry)
        return self

    def run(self, df: DataFrame, outer_keys: str | Sequence[str], inner_keys: str | Sequence[str]) -> DataFrame:
        outer_keys, inner_keys = as_list(outer_keys), as_list(inner_keys)
        level1 = df.where(all_known(outer_keys)).groupBy(*outer_keys, *inner_keys).agg(*columns(self.inner))
        return level1.groupBy(*outer_keys).agg(*columns(self.outer))


_AGGREGATE = re.compile(r"\b(sum|avg|count|min|max|max_by)\(", re.IGNORECASE)


def merged_states(text: str, carry: Callable[[str], str]) -> str:
    """An expression over aggregates of rows as one over partial states of groups of them; ``carry`` names a state.

    A mean is the sum of sums by the sum of counts; the value at the largest order is the largest (order, value).
    """
    out, at = [], 0
    while found := _AGGREGATE.search(text, at):
        args, end = arguments(text, found.end())
        call, first = found.group(1).lower(), args[0]
        if first.lstrip().upper().startswith("DISTINCT"):
            raise ValueError(f"distinct values have no partial state: {text}")
        if call == "avg":
            total, n = carry(f"sum(CAST({first} AS DOUBLE))"), carry(f"count({first})")
            state = f"try_divide(sum({total}), CAST(sum({n}) AS DOUBLE))"
        elif call == "count":
            state = f"coalesce(sum({carry(f'count({first})')}), 0)"
        elif call == "max_by":
            pair = carry(f"max(CASE WHEN {args[1]} IS NOT NULL THEN struct({args[1]} AS o, {first} AS v) END)")
            state = f"max({pair}).v"
        else:
            state = f"{call}({carry(f'{call}({first})')})"
        out += [text[at : found.start()], state]
        at = end
    return "".join([*out, text[at:]])


def arguments(text: str, start: int) -> tuple[list[str], int]:
    """The arguments of a call whose parenthesis opened before ``start``, and the place after its closing one."""
    depth, quoted, args, begin = 1, False, [], start
    for i in range(start, len(text)):
        c = text[i]
        if c == "'" and text[i - 1] != "\\":
            quoted = not quoted
        elif quoted:
            continue
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        if not quoted and (depth == 0 or (depth == 1 and c == ",")):
            args.append(text[begin:i].strip())
            begin = i + 1
            if depth == 0:
                return args, i + 1
    raise ValueError(f"unbalanced parentheses: {text}")


# --- declarative recipes -------------------------------------------------------------------------------------------

Recipe = tuple[Sequence[str], Sequence[Spec]]
_DEVIATES_FROM = ("mean", "median", "max", "min")


def recipe_name(keys: Sequence[str], column: str, agg: str) -> str:
    return f"{'_'.join(keys)}_{agg}_{column}"


def recipe_names(recipes: Sequence[Recipe]) -> list[str]:
    return [recipe_name(k, c, a) for k, specs in recipes for c, a in specs]


Fitted = list[tuple[list[str], DataFrame, bool]]


def fit_recipes(df: DataFrame, recipes: Sequence[Recipe], within: Sequence[str] = ()) -> Fitted:
    """One aggregate table per key list, all from one aggregation over the rows.

    Each row is given once per key list, with the number of the list and NULL for the keys that the list does not have;
    a pair of column and aggregate that several lists want is computed once for all. The one result is computed, and
    split by the number before anything is attached. ``within`` adds keys that separate the groups further without
    entering the column names.
    """
    merged: dict[tuple[str, ...], list[Spec]] = {}
    for keys, specs in recipes:
        merged.setdefault(tuple(keys), []).extend(specs)
    lists = [[*within, *keys] for keys in merged]
    every = list(dict.fromkeys(k for keys in lists for k in keys))
    pairs = list(dict.fromkeys(spec for specs in merged.values() for spec in specs))
    kinds = {f.name: f.dataType.simpleString() for f in df.select(*every).schema.fields}
    entries = []
    for i, keys in enumerate(lists):
        parts = [f"{k if k in keys else f'CAST(NULL AS {kinds[k]})'} AS __k{j}" for j, k in enumerate(every)]
        entries.append(f"CASE WHEN {all_known(keys)} THEN struct({i} AS __list, {', '.join(parts)}) END")
    needed = list(dict.fromkeys(c for c, _ in pairs))
    spread = df.selectExpr(*needed, f"explode(array({', '.join(entries)})) AS __in").where("__in IS NOT NULL")
    spread = spread.select(*needed, "__in.*")
    group = ["__list", *[f"__k{j}" for j in range(len(every))]]
    table, small = sized(aggregate(spread, group, {f"__a{p}": by_name(a, c) for p, (c, a) in enumerate(pairs)}, null_as_group=True))

    def part(i: int, keys: list[str], names: Mapping[str, Spec]) -> tuple[list[str], DataFrame, bool]:
        chosen = {k: f"__k{every.index(k)}" for k in keys} | {n: f"__a{pairs.index(spec)}" for n, spec in names.items()}
        rows = table.where(f"__list = {i}").select(*columns(chosen))
        return keys, F.broadcast(rows) if small else rows, small

    named = [{recipe_name(keys, c, a): (c, a) for c, a in specs} for keys, specs in merged.items()]
    return [part(i, keys, names) for i, (keys, names) in enumerate(zip(lists, named))]


def group_recipe(df: DataFrame, recipes: Sequence[Recipe], fitted: Fitted | None = None) -> DataFrame:
    """Attach every recipe aggregate to every row; ``fitted`` applies tables fitted elsewhere."""
    for keys, stats, small in fit_recipes(df, recipes) if fitted is None else fitted:
        df = attach_sized(df, stats, small, keys)
    return df


def group_deviation(df: DataFrame, recipes: Sequence[Recipe]) -> DataFrame:
    """Value minus group aggregate and its absolute value, for mean, median, max and min recipes."""
    out: dict[str, str] = {}
    for keys, specs in recipes:
        for column, agg in specs:
            if agg in _DEVIATES_FROM:
                name = recipe_name(keys, column, agg)
                out[f"{name}_diff"] = f"{column} - {name}"
                out[f"{name}_abs_diff"] = f"abs({column} - {name})"
    return with_exprs(df, out)
