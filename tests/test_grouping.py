"""Grouped aggregates, skewed keys, recipes, imputation and encoding on small frames, against pandas where it helps."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from relfeat.functions import aggs as A
from relfeat.functions.aggs import Quantile
from relfeat.operators import encode, grouping, impute, joins
from relfeat.operators.grouping import (
    Nested,
    aggregate,
    aggregate_named,
    fit_recipes,
    group_deviation,
    group_recipe,
    recipe_names,
)
from relfeat.operators.running import cut_by_range


@pytest.fixture(scope="module")
def frame(spark):
    """500 rows; key 1 holds about a third of them, some keys and values are missing, values repeat."""
    rng = random.Random(7)
    rows = []
    for i in range(500):
        key = 1 if rng.random() < 0.33 else rng.choice([None, *range(2, 12)])
        rows.append((i, key, rng.choice([None, "a", "b", "c"]), rng.choice([None, *range(-20, 20)]), rng.choice([None, 0.5, 1.25, 3.0, 7.5])))
    return spark.createDataFrame(rows, "id int, k int, c string, n int, x double").cache()


def table(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_empty_group_values(spark):
    df = spark.sql("SELECT * FROM VALUES (1, NULL), (1, NULL), (NULL, 5D) AS t(k, x)")
    specs = [("x", a) for a in ("sum", "mean", "count", "nunique", "median", "std")]
    assert table(aggregate_named(df, "k", specs), "k") == [(1, 0.0, None, 0, 0, None, None)]


def test_moments_match_pandas(frame):
    specs = [("x", a) for a in ("sum", "mean", "min", "max", "var", "std", "median", "count", "nunique")]
    got = aggregate_named(frame, "k", specs).toPandas().set_index("k").sort_index()
    want = frame.toPandas().groupby("k")["x"].agg(["sum", "mean", "min", "max", "var", "std", "median", "count", "nunique"])
    want.columns = [f"x_{c}" for c in want.columns]
    pd.testing.assert_frame_equal(got, want.set_axis(got.index), check_dtype=False)


@pytest.mark.parametrize("parts", [None, 1, 7, 40])
def test_quantiles_are_exact_wherever_groups_are_cut(frame, parts):
    aggs = {"m": Quantile("x", 0.5), "iqr": Quantile("n", 0.75, 0.25), "p": Quantile("n", 0.9), "s": "sum(n)"}
    for null_as_group in (False, True):
        got = table(aggregate(frame, "k", aggs, null_as_group, parts=parts), "k")
        rows = frame if null_as_group else frame.where("k IS NOT NULL")
        want = rows.groupBy("k").agg(*[F.expr(e) for e in ("percentile(x, 0.5)", "percentile(n, 0.75) - percentile(n, 0.25)", "percentile(n, 0.9)", "sum(n)")])
        want = table(want, "k")
        assert len(got) == len(want) and all(a == pytest.approx(b) for a, b in zip(got, want))


def test_groups_without_values_stay(spark):
    df = spark.sql("SELECT * FROM VALUES (1, NULL, 2D), (1, NULL, 4D), (2, NULL, NULL), (NULL, 1D, 1D) AS t(k, x, y)")
    aggs = {"x": Quantile("x", 0.5), "y": Quantile("y", 0.5)}
    assert table(aggregate(df, "k", aggs), "k") == [(1, None, 3.0), (2, None, None)]
    assert table(aggregate(df, "k", aggs, null_as_group=True), "k") == [(None, 1.0, 1.0), (1, None, 3.0), (2, None, None)]
    assert aggregate(df.where("false"), "k", aggs).count() == 0


def test_large_groups_in_narrow_ranges_are_cut_at_their_own_values(spark):
    """Two groups whose values lie in disjoint narrow ranges beside one wide range: no part holds much of any of them."""
    df = spark.range(60_000).selectExpr(
        "CAST(id % 3 AS INT) AS k", "CASE id % 3 WHEN 0 THEN 1000 + id / 1e9 WHEN 1 THEN -5 - id / 1e9 ELSE CAST(id * id AS DOUBLE) END AS v"
    )
    levels = cut_by_range(df.groupBy("k", "v").count(), ["k", "v"], parts=30)
    sizes = levels.groupBy("k", "__part").count().collect()
    assert max(r["count"] for r in sizes) < 5_000 and len(sizes) >= 30
    got = table(aggregate(df, "k", {"m": Quantile("v", 0.5), "q": Quantile("v", 0.999)}, parts=30), "k")
    want = table(df.groupBy("k").agg(F.expr("percentile(v, 0.5)"), F.expr("percentile(v, 0.999)")), "k")
    assert all(a == pytest.approx(b) for a, b in zip(got, want))


def test_quantiles_take_one_scan_without_python(spark, tmp_path):
    spark.range(500).selectExpr("id % 5 AS k", "id AS a", "-id AS b").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    got = aggregate(df, "k", {"a": Quantile("a", 0.5), "b": Quantile("b", 0.25)})
    after = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # what is left reads the stored cuts only; the stages before were those of one query
    assert str(tmp_path) not in got._jdf.queryExecution().toString() and "Python" not in plan
    assert after - before <= 4


@pytest.mark.parametrize("limit", [None, 0])
def test_broadcast_back_keeps_every_row(frame, limit):
    got = joins.broadcast_back(frame, "k", {"mx": "max(n)", "cnt": "count(1)"}, broadcast_rows=limit)
    pdf = frame.toPandas()
    sizes = pdf.groupby("k")["id"].count().to_dict()
    rows = got.collect()
    assert sorted(r.id for r in rows) == list(range(500))
    for r in rows:
        assert r.cnt == (None if r.k is None else sizes[r.k])


def test_large_statistics_join_without_broadcast_of_all(frame):
    """Past the limit the statistics are a stored table and the rows are joined by key."""
    got = joins.broadcast_back(frame, "k", {"cnt": "count(1)"}, broadcast_rows=0)
    small = joins.broadcast_back(frame, "k", {"cnt": "count(1)"})
    assert table(got, "id") == table(small, "id")
    assert got.columns == small.columns


def test_duplicate_names_are_refused(spark):
    df = spark.sql("SELECT 1 AS k, 2 AS total_drawings")
    other = spark.sql("SELECT 1 AS k, 3 AS TOTAL_DRAWINGS")
    with pytest.raises(ValueError):
        joins.left_join(df, other, "k")


def test_nested_and_conditions(spark):
    rows = [(1, 10, 0, 5.0), (1, 10, 3, 6.0), (1, 11, None, None), (2, 20, 0, 1.0), (None, 30, 1, 1.0)]
    df = spark.createDataFrame(rows, "c int, l int, dpd int, x double")
    n = Nested().of_groups("late", A.count_not_zero("dpd"), "avg({})").of_groups("most", "max(x)", "coalesce(sum({}), 0)")
    assert table(n.group_count("loans").run(df, "c", "l"), "c") == [(1, 1.0, 6.0, 2), (2, 0.0, 1.0, 1)]
    got = aggregate(df, "c", {"pct": A.percent_if("dpd < x"), "late": A.count_if("dpd > 0")})
    assert table(got, "c") == [(1, pytest.approx(200 / 3), 1), (2, 100.0, 0)]


def test_states_of_loans_merge_to_those_of_the_customer(frame):
    """Aggregates over rows and the same ones merged from groups of them, whatever the expression around them."""
    aggs = {
        "rows": "count(1)", "n": "count(x)", "mean": "avg(n)", "low": "min(x) - max(n)", "share": A.share("c", "a"), "sum": A.total("x"),
        "pct": A.percent_if("n < x AND c <> 'b, (c)'"), "w": A.weighted_mean("x", "abs(n)", skip_null=True), "strict": A.weighted_mean("n", "id"),
        "last": "max_by(x, CASE WHEN x IS NOT NULL THEN struct(n, id) END)", "last_c": "max_by(c, id)",
    }
    merged = Nested().beside(aggs).group_count("groups").run(frame, "k", "c")
    want = aggregate(frame, "k", {**aggs, "groups": "count(DISTINCT coalesce(c, '-'))"})
    rows, expected = table(merged.select(*want.columns), "k"), table(want, "k")
    assert len(rows) == len(expected) == 11
    for a, b in zip(rows, expected):
        assert a == pytest.approx(b)
    with pytest.raises(ValueError):
        Nested().beside({"d": "count(DISTINCT x)"})


def test_weighted_mean(spark):
    rows = [(1, -1, 2.0), (1, -2, 4.0), (2, -1, None), (2, -2, 4.0), (3, 0, 1.0), (3, -1, 2.0)]
    df = spark.createDataFrame(rows, "k int, m int, x double")
    w = A.recency_weight("m")
    got = aggregate(df, "k", {"strict": A.weighted_mean("x", w), "skip": A.weighted_mean("x", w, skip_null=True)})
    assert table(got, "k") == [(1, pytest.approx(4 / 1.5), pytest.approx(4 / 1.5)), (2, None, 4.0), (3, None, 2.0)]


RECIPES = [(["c"], [("n", "mean"), ("x", "sum")]), (["c", "k"], [("n", "max")])]


def test_recipes_and_deviations(frame):
    out = group_deviation(group_recipe(frame, RECIPES), RECIPES)
    assert set(recipe_names(RECIPES)) <= set(out.columns) and "c_sum_x_diff" not in out.columns
    rows = out.collect()
    assert len(rows) == 500
    assert all(r.c_mean_n is None for r in rows if r.c is None)
    assert all(r.c_k_max_n is None for r in rows if r.c is None or r.k is None)
    for c in "abc":
        assert sum(r.c_mean_n_diff for r in rows if r.c == c and r.n is not None) == pytest.approx(0, abs=1e-9)
    assert len(fit_recipes(frame, RECIPES)) == 2


def test_onehot(frame, spark):
    vocabulary = encode.fit_vocabulary(frame, ["c"])
    assert vocabulary == {"c": ["a", "b", "c"]}
    shares = aggregate(frame, "k", {**encode.share_columns("c", vocabulary["c"]), "known": "count(c) / count(1)"})
    for r in shares.collect():
        assert r.c_a + r.c_b + r.c_c == pytest.approx(r.known)
    unseen = spark.sql("SELECT 'z' AS c UNION ALL SELECT NULL")
    assert [tuple(r) for r in encode.onehot(unseen, vocabulary).collect()] == [(0, 0, 0)] * 2
    kinds = aggregate(frame, "k", {"a": encode.distinct_of_vocabulary("c", vocabulary["c"]), "b": "count(DISTINCT c)"})
    assert all(r.a == r.b for r in kinds.collect())


def test_recipes_of_all_key_lists_come_from_one_scan(spark, tmp_path):
    spark.range(300).selectExpr("CASE WHEN id % 11 > 0 THEN id % 7 END AS a", "CAST(id % 5 AS STRING) AS b", "id % 13 AS x", "id * 1D AS y").write.parquet(str(tmp_path / "r"))
    df = spark.read.parquet(str(tmp_path / "r"))
    recipes = [(["a"], [("x", "mean"), ("y", "max"), ("x", "nunique")]), (["a", "b"], [("x", "mean")]), (["b"], [("y", "sum"), ("x", "median")])]
    plans = []
    real = grouping.sized
    grouping.sized = lambda t: plans.append(t._jdf.queryExecution().optimizedPlan().toString()) or real(t)
    try:
        fit_recipes(df, [(["a"], [("x", "mean")]), (["b"], [("y", "sum"), ("x", "mean")])])
    finally:
        grouping.sized = real
    assert plans[0].count("Relation [") == 1 and "Union" not in plans[0]
    got = group_recipe(df, recipes).toPandas()
    pdf = df.toPandas()
    assert len(got) == 300
    for keys, specs in recipes:
        for c, agg in specs:
            want = pdf.groupby(keys)[c].agg(agg)
            for r in got.to_dict("records"):
                have, key = r[f"{'_'.join(keys)}_{agg}_{c}"], tuple(r[k] for k in keys)
                if any(k != k or k is None for k in key):
                    assert pd.isna(have)
                else:
                    assert have == pytest.approx(want.loc[key if len(key) > 1 else key[0]])


def test_distinct_counts_copy_no_rows(spark):
    rows = [(1, 1, "a", 0.0, None), (1, 2, "a", -0.0, None), (1, 2, None, float("nan"), None), (2, None, None, None, None), (None, 5, "z", 1.0, None), (None, 5, "y", 1.0, 3)]
    df = spark.createDataFrame(rows, "k int, i int, s string, d double, b bigint")
    aggs = {"n": "count(1)", **{c: A.by_name("nunique", c) for c in ("i", "s", "d", "b")}, "sum_i": "sum(i)"}
    for null_as_group in (False, True):
        got = aggregate(df, "k", aggs, null_as_group)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan and "Python" not in plan
        want = (df if null_as_group else df.where("k IS NOT NULL")).groupBy("k").agg(
            F.expr("count(1)"), *[F.expr(f"count(DISTINCT {c})") for c in ("i", "s", "d", "b")], F.expr("sum(i)")
        )
        assert table(got, "k") == table(want, "k")


def test_attaching_three_times_reads_the_rows_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 AS a", "id % 5 AS b", "id % 3 AS c").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    for k in "abc":
        df = joins.broadcast_back(df, k, {f"n_{k}": "count(1)"}, broadcast_rows=0)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert df.count() == 100


def test_broadcast_is_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1_000)
    assert not joins.sized(spark.range(20).selectExpr("id", "repeat('x', 100) AS s"))[1]
    assert joins.sized(spark.range(20).selectExpr("id"))[1]


def test_many_values(spark):
    df = spark.range(1200).selectExpr("id % 3 AS k", "format_string('v%04d', id) AS v", "CAST(id % 4 AS STRING) AS w")
    vocabulary = encode.fit_vocabulary(df, ["v"], max_values=1200)
    assert len(vocabulary["v"]) == 1200 and vocabulary["v"][:2] == ["v0000", "v0001"]
    shares = encode.share_rows(df, "k", "v").collect()
    assert len(shares) == 1200 and all(r.share == pytest.approx(1 / 400) for r in shares)


def test_an_identifier_column_stays_in_spark(spark, monkeypatch):
    """Beyond the bound only the number of values comes to the driver; the values are rows joined by key."""
    df = spark.range(3000).selectExpr("CASE WHEN id > 0 THEN id % 3 END AS k", "uuid() AS v", "CAST(id % 4 AS STRING) AS w").cache()
    fetched = []
    real = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: fetched.append(real(self)) or fetched[-1])
    vocabulary = encode.fit_vocabulary(df)
    monkeypatch.undo()
    assert vocabulary == {"w": ["0", "1", "2", "3"]} and sum(map(len, fetched)) == 2 + 4
    assert encode.wide_columns(["v", "w"], vocabulary) == ["v"]
    shares = encode.onehot_share(df, "k", vocabulary)
    assert shares.columns == ["k", "w_0", "w_1", "w_2", "w_3"]
    rows = encode.wide_share_rows(df, "k", ["v", "w"]).collect()
    assert sum(r.column_name == "v" for r in rows) == 2999 and sum(r.column_name == "w" for r in rows) == 12
    wide = {(r.k, f"w_{r.value}"): r.share for r in rows if r.column_name == "w"}
    assert all(r[n] == pytest.approx(wide[r.k, n]) for r in shares.collect() for n in shares.columns[1:])


def test_codes_follow_the_order_of_numbers_whatever_their_number(spark):
    for n in (40, 80):
        df = spark.range(n).selectExpr("id AS v", "CAST(id - 5 AS DOUBLE) / 2 AS x")
        for inline in (64, 1):
            got = encode.encode_labels(df.selectExpr("v", "x", "v AS w"), df, ["v", "x"], inline_values=inline)
            assert all(r.v == r.w == r.x for r in got.collect())


def test_missing_indicators_are_fitted(spark):
    train, test = spark.sql("SELECT 1 AS a, CAST(NULL AS INT) AS b"), spark.sql("SELECT CAST(NULL AS INT) AS a, 2 AS b")
    fitted = impute.fit_missing(train)
    assert impute.missing_indicators(test, fitted).columns == ["a", "b", "is_nan_b"] == impute.missing_indicators(train, fitted).columns


def test_label_codes(frame, spark):
    unseen = spark.sql("SELECT * FROM VALUES ('b'), ('z'), (NULL) AS t(c)")
    assert [r.c for r in encode.encode_labels(unseen, frame, ["c"]).collect()] == [1, -1, -1]
    assert [r.c for r in encode.encode_labels(unseen, frame, ["c"], inline_values=1).collect()] == [1, -1, -1]
    labels = encode.fit_labels(spark.range(1000).selectExpr("format_string('%05d', id) AS v"), "v")
    assert all(int(r.v) == r.code for r in labels.collect())


def test_imputers(spark):
    rows = [(1, "a", 1.0), (2, "a", 4.0), (3, "a", None), (4, "b", None), (5, None, 9.0), (6, None, None)]
    df = spark.createDataFrame(rows, "id int, g string, x double")
    done = impute.impute_group(df, impute.fit_group(df, "g", ["x"]))
    assert [r.x for r in done.orderBy("id").collect()] == [1.0, 4.0, 2.5, None, 9.0, None]
    done = impute.impute_group(df, impute.fit_group(df, "g", ["x"], null_as_group=True))
    assert [r.x for r in done.orderBy("id").collect()] == [1.0, 4.0, 2.5, None, 9.0, 9.0]
    full = impute.impute_mean(done, impute.fit_mean(done, ["x"]))
    assert full.orderBy("id").collect()[3].x == pytest.approx((1 + 4 + 2.5 + 9 + 9) / 5)
    flags = impute.missing_indicators(df)
    assert [c for c in flags.columns if c.startswith("is_nan")] == ["is_nan_g", "is_nan_x"]
    z = impute.standardize(full, impute.fit_standardize(full, ["x"]))
    assert z.selectExpr("avg(x)", "stddev_pop(x)").first() == pytest.approx((0, 1))
