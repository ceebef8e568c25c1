"""Category vocabularies and the encodings built on them. A fitted vocabulary keeps the output schema static."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relfeat.functions.aggs import Distinct, share
from relfeat.functions.expr import flag_equals, lit, safe_name, with_exprs
from relfeat.operators.joins import attach, check_distinct_names
from relfeat.session import materialize, stored
from relfeat.sources.tables import columns_by_type

# Vocabularies up to this size are looked up inside the row when codes are assigned; the codes do not depend on it.
INLINE_LABELS = 64
# Default bound of a vocabulary whose values become columns: the schema of a plan stays below some thousands.
MAX_VALUES = 200

Vocabulary = dict[str, list[str]]


def small_vocabularies(df: DataFrame, columns: Sequence[str], max_values: int) -> Vocabulary:
    """The distinct values, as text but in the order of the column's own type, of those columns that have at most
    ``max_values``. They are counted in Spark first: of a column with more nothing but their number comes back."""
    if not columns:
        return {}
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])
    ).alias("p")
    values = stored(df.select(pairs).select("p.c", "p.v").where("v is not null").distinct(), "values")
    n = {r.c: r.n for r in values.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    found: Vocabulary = {c: [] for c in columns if n.get(c, 0) <= max_values}
    for row in values.where(F.col("c").isin(list(found))).collect():
        found[row.c].append(row.v)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return {c: sorted(v, key=value_order(kinds[c])) for c, v in found.items()}


def value_order(kind: T.DataType) -> Callable[[str], tuple]:
    """Sort key that puts the text of values into the order of their type; NaN is the largest number."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return lambda v: (v == "NaN", float(v.replace("Infinity", "inf")) if v != "NaN" else 0.0)
    if isinstance(kind, T.NumericType):
        return lambda v: (Decimal(v),)
    return lambda v: (v.encode(),)


def fit_vocabulary(df: DataFrame, columns: Sequence[str] | None = None, max_values: int = MAX_VALUES) -> Vocabulary:
    """The ordered distinct values of each (string) column that has at most ``max_values`` of them.

    Each value becomes a column of every plan built on it, so the bound is one of the schema, chosen by the caller. A
    column with more, an identifier say, is not in the result and never reaches the driver: ``wide_columns`` names it and
    ``share_rows`` gives its values as rows.
    """
    columns = columns_by_type(df, "string") if columns is None else list(columns)
    return small_vocabularies(df, columns, max_values)


def wide_columns(columns: Sequence[str], vocabulary: Mapping[str, Sequence[str]]) -> list[str]:
    """The columns that have too many values for columns of their own."""
    return [c for c in columns if c not in vocabulary]


def indicator_name(prefix: str, value: str) -> str:
    return f"{prefix}_{safe_name(value)}" if prefix else safe_name(value)


def indicator_names(column: str, values: Sequence[str], prefix: str | None = None) -> dict[str, str]:
    """Column name per value; two values that would share a name are an error."""
    names = {v: indicator_name(column if prefix is None else prefix, v) for v in values}
    check_distinct_names(list(names.values()))
    return names


def onehot(df: DataFrame, vocabulary: Mapping[str, Sequence[str]], drop: bool = True) -> DataFrame:
    """A 0/1 column per value; a missing or unseen value gives all zeros."""
    out: dict[str, str] = {}
    for c, values in vocabulary.items():
        out.update({n: flag_equals(c, v) for v, n in indicator_names(c, values).items()})
    check_distinct_names([*df.columns, *out])
    encoded = with_exprs(df, out)
    return encoded.drop(*vocabulary) if drop else encoded


def share_columns(c: str, values: Sequence[str], prefix: str | None = None) -> dict[str, str]:
    """Aggregates: share of each value in the group, without building the indicators."""
    return {n: share(c, v) for v, n in indicator_names(c, values, prefix).items()}


def distinct_of_vocabulary(c: str, values: Sequence[str]) -> str:
    """Aggregate: number of distinct values of a column whose vocabulary is known, without a distinct shuffle."""
    return " + ".join([f"max({flag_equals(c, v)})" for v in values]) or "0"


def distinct_values(c: str, vocabulary: Mapping[str, Sequence[str]]) -> str | Distinct:
    """Aggregate: number of distinct values, from the vocabulary where the column has one."""
    return distinct_of_vocabulary(c, vocabulary[c]) if c in vocabulary else Distinct(c)


def onehot_share(df: DataFrame, keys: str | Sequence[str], vocabulary: Mapping[str, Sequence[str]]) -> DataFrame:
    from relfeat.operators.grouping import aggregate

    aggs: dict[str, str] = {}
    for c, values in vocabulary.items():
        aggs.update(share_columns(c, values))
    return aggregate(df, keys, aggs)


def share_rows(df: DataFrame, keys: str | Sequence[str], column: str) -> DataFrame:
    """(keys, value, n, share): share of each value among the rows of the group, one row per value that occurs.

    The long form of ``onehot_share`` for columns with any number of values; rows without the value count in the
    group but have no row of their own.
    """
    from relfeat.operators.joins import as_list, keyed_join

    keys = as_list(keys)
    counts = stored(df.groupBy(*keys, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")), "share-counts")
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("__all"))
    joined = keyed_join(counts.where("value IS NOT NULL"), totals, keys, "inner")
    return joined.select(*keys, "value", "n", (F.col("n") / F.col("__all")).alias("share"))


def wide_share_rows(df: DataFrame, keys: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, column_name, value, n, share) of several columns from one scan: what ``onehot_share`` leaves out, to be
    joined by key. Rows with a missing key belong to no group."""
    from relfeat.operators.joins import all_known, as_list

    keys = as_list(keys)
    slots = ", ".join(f"{lit(c)}, CAST(`{c}` AS STRING)" for c in columns)
    long = df.where(all_known(keys)).selectExpr(*keys, f"stack({len(columns)}, {slots}) AS (column_name, value)")
    return share_rows(long, [*keys, "column_name"], "value")


def fit_labels(df: DataFrame, column: str) -> DataFrame:
    """(column, code): the distinct values numbered from 0 in value order.

    The values are range-sorted over all tasks; each partition numbers its own rows and adds the size of the
    partitions before it. Partition ids are read back from the checkpoint, so a lost task cannot change them.
    """
    ordered = materialize(
        df.select(column)
        .where(F.col(column).isNotNull())
        .distinct()
        .orderBy(column)
        .withColumn("__part", F.spark_partition_id())
    )
    # one row per partition
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )
    inside = Window.partitionBy("__part").orderBy(column)
    return attach(ordered.withColumn("__rn", F.row_number().over(inside)), offsets, "__part").select(
        column, (F.col("__before") + F.col("__rn") - 1).cast("int").alias("code")
    )


def encode_labels(df: DataFrame, train: DataFrame, columns: Sequence[str], inline_values: int = INLINE_LABELS) -> DataFrame:
    """Integer codes for several columns, fitted on ``train``.

    Short vocabularies are found by one job for all columns and looked up in the row itself; a column with more
    values goes through ``fit_labels`` and a join.
    """
    vocabulary = small_vocabularies(train, columns, inline_values)
    coded = {}
    for c, values in vocabulary.items():
        # the position is 0 for a value outside the vocabulary
        place = f"array_position(array({', '.join(map(lit, values))}), CAST(`{c}` AS STRING))" if values else "0"
        coded[c] = f"CAST(coalesce({place} - 1, -1) AS INT)"
    df = with_exprs(df, coded)
    for c in columns:
        if c not in vocabulary:
            df = label_encode(df, fit_labels(train, c), c)
    return df


def label_encode(df: DataFrame, labels: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Replace (or, with ``name``, add) the integer code; a missing or unseen value is -1."""
    target = name or column
    coded = attach(df, labels.withColumnRenamed("code", "__code"), column, expect_small=False)
    return coded.withColumn(target, F.coalesce(F.col("__code"), F.lit(-1))).drop("__code")
