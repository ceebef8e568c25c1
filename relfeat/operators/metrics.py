"""Exact ranking metrics as tables, per fold and over all rows.

Rows are first reduced to one level per (fold, score). The levels are then accumulated by ``running_totals``, which
never orders a whole fold in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfeat.operators.joins import attach
from relfeat.operators.running import BUCKETS, running_totals
from relfeat.session import materialize

# Fold number under which the metrics over all rows are reported.
ALL_ROWS = -1


def score_levels(df: DataFrame, label: str, score: str, fold: str | None = None) -> DataFrame:
    """(fold, score, p, n): positives and negatives per distinct score; fold -1 holds all rows."""
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    positive = F.sum(F.col(label).cast("long")).alias("p")
    negative = F.sum(1 - F.col(label).cast("long")).alias("n")
    s = F.col(score).cast("double").alias("score")
    if fold is None:
        return known.groupBy(F.lit(ALL_ROWS).alias("fold"), s).agg(positive, negative)
    by_fold = known.groupBy(F.col(fold).cast("int").alias("fold"), s).agg(positive, negative)
    overall = by_fold.groupBy(F.lit(ALL_ROWS).alias("fold"), "score").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    return by_fold.unionByName(overall)


def _accumulated(df, label, score, fold, descending, buckets) -> tuple[DataFrame, DataFrame]:
    # whatever made the scores runs once; all that follows works on the levels
    levels = materialize(score_levels(df, label, score, fold))
    running = running_totals(levels, ["fold"], "score", {"cp": "p", "cn": "n"}, descending=descending, buckets=buckets)
    return running, levels.groupBy("fold").agg(F.sum("p").alias("pos"), F.sum("n").alias("neg"))


def _with_totals(running: DataFrame, totals: DataFrame) -> DataFrame:
    return attach(running, totals, "fold")


def auc_by_fold(df: DataFrame, label: str, score: str, fold: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """ROC-AUC by average ranks; a fold with one class only has none."""
    running, totals = _accumulated(df, label, score, fold, False, buckets)
    below = F.col("cn") - F.col("n")
    won = F.sum(F.col("p") * (below + F.col("n") / F.lit(2.0)))
    return (
        _with_totals(running, totals)
        .groupBy("fold", "pos", "neg")
        .agg(won.alias("won"))
        .select("fold", "pos", "neg", F.try_divide("won", F.col("pos").cast("double") * F.col("neg")).alias("auc"))
    )


def roc_curve(df: DataFrame, label: str, score: str, fold: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(fold, threshold, fpr, tpr), one point per distinct score plus the start (0, 0) with no threshold."""
    running, totals = _accumulated(df, label, score, fold, True, buckets)
    points = _with_totals(running, totals).select(
        "fold",
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cn").cast("double"), F.col("neg")).alias("fpr"),
        F.try_divide(F.col("cp").cast("double"), F.col("pos")).alias("tpr"),
    )
    start = totals.select("fold", F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def pr_curve(df: DataFrame, label: str, score: str, fold: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(fold, threshold, prec, recall), one point per distinct score plus the end (1, 0) with no threshold."""
    running, totals = _accumulated(df, label, score, fold, True, buckets)
    points = _with_totals(running, totals).select(
        "fold",
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cp").cast("double"), F.col("cp") + F.col("cn")).alias("prec"),
        F.try_divide(F.col("cp").cast("double"), F.col("pos")).alias("recall"),
    )
    end = totals.select("fold", F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("prec"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def average_precision(df: DataFrame, label: str, score: str, fold: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Sum of recall steps times precision; no interpolation. Without positives there is none."""
    running, totals = _accumulated(df, label, score, fold, True, buckets)
    step = F.try_divide(F.col("p").cast("double"), F.col("pos")) * (F.col("cp") / (F.col("cp") + F.col("cn")))
    return _with_totals(running, totals).groupBy("fold").agg(F.sum(step).alias("ap"))


def fold_score_spread(auc: DataFrame) -> DataFrame:
    """Overall AUC, mean over folds and population standard deviation over folds."""
    folds = F.when(F.col("fold") != ALL_ROWS, F.col("auc"))
    return auc.agg(
        F.max(F.when(F.col("fold") == ALL_ROWS, F.col("auc"))).alias("auc_all"),
        F.avg(folds).alias("auc_mean"),
        F.stddev_pop(folds).alias("auc_std"),
    )


def mean_importance(importances: DataFrame) -> DataFrame:
    """Mean importance per feature over the folds."""
    return importances.groupBy("feature").agg(F.avg("importance").alias("importance"))
