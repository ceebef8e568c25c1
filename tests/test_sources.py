"""Scans: missing values, conditions that reach the files, and what they mean for NaN."""

import pytest

from relfeat.sources.tables import scan_table


@pytest.fixture
def measured(spark, tmp_path):
    path = str(tmp_path / "measured")
    rows = [(1, 1.0, 1.5, "a"), (2, float("nan"), float("nan"), "b"), (3, None, None, None), (4, -2.0, 0.0, "b"), (5, float("inf"), 7.0, "c")]
    spark.createDataFrame(rows, "id int, x double, f float, s string").coalesce(1).write.parquet(path)
    return path


def ids(df):
    return sorted(r.id for r in df.collect())


def test_nan_is_missing_on_parquet_by_default(spark, measured):
    df = scan_table(spark, measured)
    assert ids(df.where("x > 0")) == [1, 5] and ids(df.where("x IS NULL")) == [2, 3]
    assert [r.n for r in df.selectExpr("CASE WHEN x > 0 THEN 1 ELSE 0 END AS n").collect()] == [1, 0, 0, 0, 1]
    assert ids(scan_table(spark, measured, guard_nan=False).where("x > 0")) == [1, 2, 5]


@pytest.mark.parametrize(
    "where,found",
    [
        ([("x", ">", 0)], [1, 5]), ([("x", "<>", 1.0)], [4, 5]), ([("f", ">=", 0.0), ("s", "in", ["a", "b"])], [1, 4]),
        ([("x", "<", 0), ("f", "=", 0)], [4]), ([("s", "=", "b")], [2, 4]), ([("id", "<=", 2)], [1, 2]), ([], [1, 2, 3, 4, 5]),
    ],
)
def test_conditions_equal_a_filter_above_the_guard(spark, measured, where, found):
    from relfeat.functions.expr import lit

    text = " AND ".join(f"{c} {op} {'(' + ', '.join(map(lit, v)) + ')' if op == 'in' else lit(v)}" for c, op, v in where) or "true"
    assert ids(scan_table(spark, measured, where=where)) == found == ids(scan_table(spark, measured).where(text))


def test_the_comparison_is_pushed_into_the_scan(spark, measured):
    def pushed(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return next(line for line in plan.splitlines() if "PushedFilters" in line).split("PushedFilters:")[1].split("], ")[0]

    got = pushed(scan_table(spark, measured, where=[("x", ">", 0), ("s", "=", "b")]).select("id"))
    assert "GreaterThan(x,0.0)" in got and "EqualTo(s,b)" in got
    assert "GreaterThan" not in pushed(scan_table(spark, measured).where("x > 0"))


def test_conditions_name_columns_of_the_table(spark, measured):
    with pytest.raises(ValueError):
        scan_table(spark, measured, where=[("y", ">", 0)])
    with pytest.raises(ValueError):
        scan_table(spark, measured, where=[("x", "like", "0")])
