"""Ranking metrics against brute force over all pairs; folds; models on a planted signal."""

import math
import random

import pytest

from relfeat.operators import metrics, model


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    rows = [(i, int(rng.random() < 0.3), round(rng.random(), 1 if i % 2 else 3), i % 4) for i in range(300)]
    rows += [(900 + i, 0, 0.5, 4) for i in range(3)]
    return spark.createDataFrame(rows, "id int, y int, s double, f int").cache()


def brute_auc(rows):
    pos, neg = [r.s for r in rows if r.y], [r.s for r in rows if not r.y]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(rows):
    total, ap, last = sum(r.y for r in rows), 0.0, 0.0
    for t in sorted({r.s for r in rows}, reverse=True):
        kept = [r for r in rows if r.s >= t]
        hit = sum(r.y for r in kept)
        ap += (hit / total - last) * hit / len(kept)
        last = hit / total
    return ap


@pytest.mark.parametrize("buckets", [1, 3, 1000])
def test_auc_and_ap(scored, buckets):
    rows = scored.collect()
    auc = {r.fold: r.auc for r in metrics.auc_by_fold(scored, "y", "s", "f", buckets).collect()}
    ap = {r.fold: r.ap for r in metrics.average_precision(scored, "y", "s", "f", buckets).collect()}
    assert auc[4] is None and ap[4] is None
    for fold in (0, 1, 2, 3, metrics.ALL_ROWS):
        mine = [r for r in rows if fold in (r.f, metrics.ALL_ROWS)]
        assert auc[fold] == pytest.approx(brute_auc(mine))
        assert ap[fold] == pytest.approx(brute_ap(mine))
    flipped = metrics.auc_by_fold(scored.selectExpr("y", "-s AS s"), "y", "s", buckets=buckets).first().auc
    assert flipped == pytest.approx(1 - auc[metrics.ALL_ROWS])


def test_curves(scored):
    roc = metrics.roc_curve(scored, "y", "s", buckets=7).orderBy("fpr", "tpr").collect()
    assert (roc[0].threshold, roc[0].fpr, roc[0].tpr) == (None, 0.0, 0.0) and (roc[-1].fpr, roc[-1].tpr) == (1.0, 1.0)
    area = sum((b.fpr - a.fpr) * (a.tpr + b.tpr) / 2 for a, b in zip(roc, roc[1:]))
    assert area == pytest.approx(metrics.auc_by_fold(scored, "y", "s").first().auc)
    pr = metrics.pr_curve(scored, "y", "s", buckets=7).collect()
    assert max(r.recall for r in pr) == 1.0 and (None, 1.0, 0.0) in [(r.threshold, r.prec, r.recall) for r in pr]


def test_folds_are_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = model.assign_folds(df, "k").collect()
    b = model.assign_folds(df.repartition(7), "k").collect()
    assert sorted(a) == sorted(b)
    sizes = [sum(r.fold == i for r in a) for i in range(5)]
    assert sum(sizes) == 5000 and min(sizes) > 850


def test_cross_validation_finds_a_planted_signal(spark):
    df = spark.range(600).selectExpr(
        "id AS k", "CASE WHEN id % 7 = 0 THEN NULL ELSE CAST(id % 50 AS DOUBLE) END AS a",
        "CAST(hash(id) % 100 AS DOUBLE) AS b", "CAST(id % 50 > 25 AS INT) AS y",
    )
    result = model.cross_validate(df, "k", "y", ["a", "b"], k=3, max_iter=3, max_depth=3)
    assert sorted(r.k for r in result.oof.collect()) == list(range(600))
    report = {r.fold: r for r in model.fold_report(result).collect()}
    assert report[-1].auc > 0.8 and report[-1].n_rows == 600
    scores = result.score_average(df).collect()
    assert len(scores) == 600 and all(0 <= r.score <= 1 for r in scores)
    top = metrics.mean_importance(result.importances()).orderBy("importance", ascending=False).first()
    assert top.feature == "a"


@pytest.fixture(scope="module")
def noisy(spark):
    return spark.range(500).selectExpr(
        "id AS k", "CAST(hash(id) % 50 AS DOUBLE) AS a", "CAST(hash(id, 1) % 100 AS DOUBLE) AS b",
        "CAST(hash(id) % 50 + hash(id, 2) % 60 > 0 AS INT) AS y",
    ).cache()


def test_staged_scores_are_those_of_the_first_trees(spark, noisy, tmp_path):
    rows = model.assemble(noisy, ["a", "b"]).selectExpr("k", "CAST(y AS DOUBLE) AS label", "CAST(k % 2 AS INT) AS fold", "features")
    whole = model.GBTClassifier(featuresCol="features", labelCol="label", maxIter=6, maxDepth=3, seed=3).fit(rows)
    whole.save(str(tmp_path / "m"))
    staged = model.staged_margins(whole, str(tmp_path / "m"), rows)
    margins = {r.k: r.margins for r in staged.collect()}
    auc = model.staged_auc(staged, "label", "fold")
    for n in (1, 2, 6):
        cut = model.first_trees(whole, n)
        scored = model._probability(cut, rows, "score")
        assert cut.getNumTrees == n and cut.featureImportances.size == 2
        for r in scored.collect():
            assert r.score == pytest.approx(1 / (1 + math.exp(-2 * margins[r.k][n - 1])))
        for r in metrics.auc_by_fold(scored, "label", "score", "fold").collect():
            if r.fold != metrics.ALL_ROWS:
                assert auc[r.fold][n - 1] == pytest.approx(r.auc)


def test_number_of_trees():
    assert model.best_stage([0.5, 0.7, 0.7, 0.6]) == 2
    assert model.best_stage([0.5, 0.4, 0.3, 0.9], patience=2) == 1
    assert model.best_stage([0.5, 0.4, 0.6, 0.9], patience=3) == 4
    assert model.best_stage([None, None]) == 2


def test_the_same_data_and_settings_are_fitted_once(spark, noisy, monkeypatch):
    options = {"k": 2, "max_iter": 3, "max_depth": 2}
    model.forget_models(spark)  # the shared folder may be older than this session
    first = model.cross_validate(noisy, "k", "y", ["a", "b"], **options)
    fits = []
    real = model.GBTClassifier.fit
    monkeypatch.setattr(model.GBTClassifier, "fit", lambda self, df: fits.append(1) or real(self, df))
    again = model.cross_validate(noisy.repartition(3), "k", "y", ["a", "b"], **options)
    assert not fits and sorted(again.oof.collect()) == sorted(first.oof.collect())
    assert sorted(again.importances().collect()) == sorted(first.importances().collect())
    model.cross_validate(noisy.where("k <> 7"), "k", "y", ["a", "b"], **options)
    assert len(fits) == 2
    model.cross_validate(noisy, "k", "y", ["a", "b"], **{**options, "max_depth": 1})
    assert len(fits) == 4
    model.cross_validate(noisy, "k", "y", ["a", "b"], reuse=False, **options)
    assert len(fits) == 6


def test_a_constant_score_fails_the_checks_of_the_model_queries(spark, noisy):
    same = noisy.selectExpr("k", "y AS label", "CAST(k % 3 AS INT) AS fold", "0.5D AS score")
    assert all(r.gap == 0 for r in model.separation(same, "label", "score", "fold").collect())
    assert all(r.auc == 0.5 for r in metrics.auc_by_fold(same, "label", "score", "fold").collect())


@pytest.mark.parametrize("name", ["train_gbt_cv", "oof_predict", "score_avg_folds", "feature_importance"])
def test_model_queries_hold_what_their_sql_states(spark, name):
    import __spark_entry__ as entry

    rows = entry.queries()[name](spark, "/root/testdata/sf0.01").collect()
    for flag in ("auc_above", "trees_in_range", "score_in_range", "separates", "in_range"):
        assert all(r[flag] for r in rows if flag in r.asDict())
    if name == "feature_importance":
        assert [r.feature for r in rows if r["first"]] == ["sum_price"]


def test_principal_components(spark):
    df = spark.range(50).selectExpr("id AS k", "CAST(id AS DOUBLE) AS a", "2D * id AS b", "CAST(hash(id) % 10 AS DOUBLE) AS c")
    out = model.pca_project(df, df, "k", ["a", "b", "c"], 2)
    assert out.columns == ["k", "principal_component_1", "principal_component_2"] and out.count() == 50


def test_mean_importance_of_known_values(spark):
    rows = [(0, "a", 0.75), (0, "b", 0.25), (1, "a", 0.25), (1, "b", 0.75), (2, "a", 0.5), (2, "b", 0.5), (2, "c", 0.0)]
    got = metrics.mean_importance(spark.createDataFrame(rows, "fold int, feature string, importance double"))
    assert {r.feature: r.importance for r in got.collect()} == {"a": 0.5, "b": 0.5, "c": 0.0}


def test_the_projection_of_the_mart_is_a_query(spark):
    import __spark_entry__ as entry

    row = entry.queries()["pca_project_mart"](spark, "/root/testdata/sf0.001").first()
    assert row.n_rows == 120 and row.orthogonal and row.ordered and 2 < row.variance <= 7
