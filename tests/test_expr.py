"""Row-level semantics on hand-made rows: NULLs, zero divisors, truncation, overlapping edges."""

import math

import pytest

from relfeat.functions import expr as E
from relfeat.sources.tables import (
    columns_by_pattern,
    columns_by_range,
    columns_by_type,
    nan_to_null,
    scan_table,
    table_shape,
    write_predictions,
)


def one(spark, expression, row="1 AS x"):
    return spark.sql(f"SELECT {row}").selectExpr(f"{expression} AS r").first().r


@pytest.mark.parametrize("a, b, want", [("1", "0", None), ("0", "0", None), ("3", "2", 1.5), ("NULL", "2", None)])
def test_ratio(spark, a, b, want):
    assert one(spark, E.ratio(a, b)) == want


@pytest.mark.parametrize("x, want", [("-2.7D", -2), ("2.7D", 2), ("CAST('NaN' AS DOUBLE)", None), ("NULL", None), ("1e20", None)])
def test_trunc_int(spark, x, want):
    assert one(spark, E.trunc_int(x)) == want


def test_flags_treat_unknown_as_zero(spark):
    row = "CAST(NULL AS INT) AS n, 5 AS five, 'Y' AS y"
    assert one(spark, E.flag("n > 0"), row) == 0
    assert one(spark, E.not_past("n"), row) == 1
    assert one(spark, E.flag_all({"y": "Y", "five": (">=", 5)}), row) == 1
    assert one(spark, E.flag_all({"y": "Y", "n": (">=", 5)}), row) == 0


@pytest.mark.parametrize("age, want", [(25, [1, 1, 0, 0]), (35, [0, 1, 1, 0]), (50, [0, 0, 1, 1]), (71, [0, 0, 0, 0])])
def test_buckets_share_their_edges(spark, age, want):
    flags = E.overlapping_buckets("x", [(None, 25), (25, 35), (35, 50), (50, 70)])
    assert [one(spark, f, f"{age} AS x") for f in flags] == want


def test_recodes(spark):
    assert one(spark, E.recode("x", {"a": 1.0, "it's": 2.0}), "'it\\'s' AS x") == 2.0
    assert one(spark, E.recode("x", {"a": 1.0}), "'b' AS x") is None
    assert one(spark, E.sentinel_to_null("x", 365243), "365243 AS x") is None
    assert one(spark, E.sentinel_to_null("x", 365243), "-5 AS x") == -5
    assert one(spark, E.replace_value("x", 0, 1), "0 AS x") == 1
    assert one(spark, E.days_to_years("x"), "-729 AS x") == 1


def test_row_statistics_skip_missing(spark):
    row = "1D AS a, CAST(NULL AS DOUBLE) AS b, 3D AS c"
    assert one(spark, E.row_mean(["a", "b", "c"]), row) == 2.0
    assert math.isclose(one(spark, E.row_std(["a", "b", "c"]), row), math.sqrt(2))
    assert one(spark, E.row_std(["a", "b"]), row) is None
    assert one(spark, E.row_mean(["b"]), row) is None
    assert one(spark, E.row_sum(["a", "b", "c"]), row) == 4.0
    assert math.isclose(one(spark, E.row_missing_fraction(["a", "b", "c"]), row), 1 / 3)


def test_fill_and_prefix(spark):
    df = spark.sql("SELECT 1 AS k, CAST(NULL AS DOUBLE) AS x, CAST(NULL AS STRING) AS s")
    assert E.fill_all_numeric(df).first() == (1, -999.0, None)
    assert E.prefixed(df, "p_", ["k"]).columns == ["k", "p_x", "p_s"]


def test_selectors_and_shape(spark):
    df = spark.sql("SELECT 1 AS a, 2D AS b, 'x' AS c, 4L AS FLAG_1")
    assert columns_by_type(df, "string") == ["c"]
    assert columns_by_type(df, "integer") == ["a", "FLAG_1"]
    assert columns_by_type(df, "numeric") == ["a", "b", "FLAG_1"]
    assert columns_by_pattern(df, "FLAG") == ["FLAG_1"]
    assert columns_by_range(df, "b", "FLAG_1") == ["b", "c", "FLAG_1"]
    assert table_shape(df).first() == (1, 4)


def test_csv_round_trip_and_nan(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES (1, 0.5D), (2, CAST('NaN' AS DOUBLE)), (3, NULL) AS t(k, s)")
    assert [r.s for r in nan_to_null(df).orderBy("k").collect()] == [0.5, None, None]
    write_predictions(df, "k", "s", str(tmp_path / "out"))
    back = scan_table(spark, str(tmp_path / "out"), df.schema, "csv")
    assert [tuple(r) for r in back.orderBy("k").collect()] == [(1, 0.5), (2, None), (3, None)]
