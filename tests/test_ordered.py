"""Order inside a group: ties, single rows, histories shorter than k."""

import random

import pytest

from relfeat.operators import ordered, profile


def table(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3, 4, 5]), -rng.randint(1, 40), i, rng.choice([0, 0, 1, 5, 9])) for i in range(400)]
    rows.append((6, -3, 400, 7))
    return spark.createDataFrame(rows, "k int, m int, loan int, dpd int").cache()


def test_lag_diff(spark):
    rows = [(1, 1, -10), (1, 2, -3), (1, 3, -3), (1, 4, None), (2, 5, -7), (None, 6, -1), (1, 7, -12)]
    df = spark.createDataFrame(rows, "k int, id int, day int")
    got = ordered.lag_diff(df, "k", "day", "id", "gap").select("id", "gap")
    assert table(got, "id") == [(1, 7), (2, 0), (3, 0), (4, 0), (5, 0), (6, 0), (7, 2)]


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_gaps_across_cuts_of_one_hot_key(spark, parts):
    """One key with almost all rows is spread over the cuts; the gaps at their borders are those of a plain window."""
    rng = random.Random(5)
    rows = [(1 if rng.random() < 0.9 else rng.randint(2, 6), i, rng.choice([None, *range(-300, 0)])) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, id int, day int")
    got = ordered.lag_diff(df, "k", "day", "id", "gap", parts=parts).select("id", "gap")
    want = df.selectExpr("id", "coalesce(lag(day) OVER (PARTITION BY k ORDER BY day DESC, id) - day, 0) AS gap")
    assert table(got, "id") == table(want, "id")


def test_last_known_value(spark):
    rows = [(1, -3, 1, 5.0), (1, -1, 2, None), (1, -2, 3, 6.0), (1, -2, 4, 7.0), (2, -1, 5, None)]
    df = spark.createDataFrame(rows, "k int, m int, id int, x double")
    assert table(ordered.last_by_order(df, "k", "x", "m", ["id"], "last"), "k") == [(1, 7.0), (2, None)]


def test_last_k_against_pandas(history):
    got = ordered.last_k_aggregate(history, "k", "m", ["loan"], [1, 10, 500], {"dpd": ["sum", "mean", "median", "count"]})
    pdf = history.toPandas().sort_values(["m", "loan"], ascending=[False, False])
    for r in got.collect():
        mine = pdf[pdf.k == r.k].dpd
        for k in (1, 10, 500):
            top = mine.iloc[:k]
            assert r[f"last_{k}_dpd_sum"] == top.sum() and r[f"last_{k}_dpd_count"] == len(top)
            assert r[f"last_{k}_dpd_mean"] == pytest.approx(top.mean())
            assert r[f"last_{k}_dpd_median"] == pytest.approx(top.median())
        assert r.last_500_dpd_sum == r.all_installment_dpd_sum


def test_trend(history, spark):
    got = {r.k: r for r in ordered.trend_slope(history, "k", "m", ["loan"], [1, 6], ["dpd"]).collect()}
    assert all(r["1_period_trend_dpd"] == 0 for r in got.values()) and got[6]["6_period_trend_dpd"] == 0
    rows = spark.createDataFrame([(1, -1, 1, 2), (1, -2, 2, 4), (1, -3, 3, 6), (2, -1, 4, None), (2, -2, 5, 1)], "k int, m int, loan int, dpd int")
    slope = {r.k: r["6_period_trend_dpd"] for r in ordered.trend_slope(rows, "k", "m", ["loan"], [6], ["dpd"]).collect()}
    assert slope == {1: pytest.approx(2.0), 2: None}


def test_last_loan(spark):
    rows = [(1, 10, -5, 1), (1, 10, -1, 3), (1, 11, -1, 7), (1, 12, -2, 9), (2, 20, -4, 2)]
    df = spark.createDataFrame(rows, "k int, loan int, m int, dpd int")
    got = ordered.last_group_aggregate(df, "k", "loan", "m", [("dpd", "sum"), ("dpd", "count"), ("dpd", "std")])
    assert table(got, "k") == [(1, 7, 1, None), (2, 2, 1, None)]


def test_recent_rows_are_cut_before_the_shuffle(history):
    """The limit runs on the map side too, and nothing leaves the JVM."""
    df = ordered.recent_rows(history, "k", "m", ["loan"], 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 5, Partial" in plan and "row_number(), 5, Final" in plan
    assert "Python" not in plan


def test_recent_rows_are_cut_before_the_shuffle_for_any_k(history):
    plan = ordered.recent_rows(history, "k", "m", ["loan"], 1500)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1500, Partial" in plan


def test_most_recent_row_and_most_recent_loan_agree(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 10, -1, 3), (1, 11, -1, 7), (1, 9, -2, 5) AS t(k, loan, m, dpd)")
    row = ordered.last_k_aggregate(df, "k", "m", ["loan"], [1], {"dpd": ["sum"]}, whole=False).first()
    loan = ordered.last_group_aggregate(df, "k", "loan", "m", [("dpd", "sum")]).first()
    assert (row.last_1_dpd_sum, loan.last_loan_dpd_sum) == (7, 7)


def test_period_fraction(spark):
    df = spark.sql("SELECT 1 AS k, 4 AS last_10_dpd_sum, 8 AS last_50_dpd_sum")
    assert ordered.period_fraction(df, 10, 50).first().last_10by50_fraction_dpd_sum == 0.5


def test_profiles(spark):
    df = spark.sql("SELECT * FROM VALUES (1D, 2D, 'a'), (2D, 4D, NULL), (3D, 6D, 'a'), (NULL, 1D, 'b') AS t(x, y, c)")
    got = profile.missing_profile(df).collect()
    assert [(r.column_name, r.missing, r.percent) for r in got] == [("c", 1, 25.0), ("x", 1, 25.0), ("y", 0, 0.0)]
    corr = {(r.a, r.b): r["corr"] for r in profile.correlation_matrix(df, ["x", "y"]).collect()}
    assert len(corr) == 4 and corr["x", "y"] == corr["y", "x"] == pytest.approx(1.0)
    assert profile.drop_correlated(df, ["x", "y"], 0.9).columns == ["x", "c"]
    assert table(profile.value_counts(df, "c"), "c") == [("a", 2), ("b", 1)]
    assert sum(r.n for r in profile.histogram(df, "x", 2).collect()) == 3
    rates = profile.target_rate_by_category(df, "c", "y").collect()
    assert [(r.c, r.contracts, r.target_rate) for r in rates] == [("a", 2, 4.0), ("b", 1, 1.0)]


def test_correlations_over_rows_that_have_both(spark):
    rng = random.Random(2)
    names = ["a", "b", "c", "still", "big", "none", "nan"]
    rows = []
    for i in range(400):
        a = rng.gauss(0, 1)
        rows.append((a if rng.random() < 0.8 else None, a + rng.gauss(0, 1), rng.choice([None, 1.0, 2.0]), 7.0, 1e9 + a, None, float("nan") if i % 3 == 0 else -a))
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    want = df.toPandas().astype(float).corr()
    got = {(r.a, r.b): r["corr"] for r in profile.correlation_matrix(df, names).collect()}
    assert len(got) == 49
    for (a, b), value in got.items():
        if "still" in (a, b) or "none" in (a, b):
            assert value is None
        else:
            assert value == pytest.approx(want.loc[a, b], abs=1e-6)
    assert profile.correlation_matrix(df.where("false"), names).where("corr IS NOT NULL").count() == 0


def test_a_wide_mart_is_read_once_for_its_correlations(spark, tmp_path):
    """561 columns: one relation, no Python, and the same numbers as pandas."""
    width = 561
    wide = spark.range(60).selectExpr(*[f"CASE WHEN hash(id, {i}) % 5 <> 0 THEN CAST(hash({i}, id) % 1000 AS DOUBLE) END AS c{i}" for i in range(width)])
    wide.write.parquet(str(tmp_path / "wide"))
    df = spark.read.parquet(str(tmp_path / "wide"))
    names = df.columns
    plan = profile.moment_vectors(df, names, [(0.0, 1.0)] * width)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Python" not in plan
    found = profile.correlations(df, names)
    want = df.toPandas().corr().to_numpy()
    assert found.shape == (width, width)
    assert abs(found - want).max() < 1e-9


def test_of_correlated_columns_the_earlier_stays(spark):
    df = spark.range(50).selectExpr("id AS k", "CAST(id AS DOUBLE) AS a", "hash(id) % 10 AS b", "2 * id + 1 AS c", "-id AS d")
    assert profile.drop_correlated(df, ["a", "b", "c", "d"], 0.9).columns == ["k", "a", "b"]
