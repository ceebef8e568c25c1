"""Imputation, encoding, scaling, profiling, folds, ranking metrics, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from relfeat.driver.registry import CUSTOMERS, LINES, Tables, query, rounded, rounded_sql
from relfeat.functions.aggs import share
from relfeat.operators import encode, impute, metrics, model, profile
from relfeat.operators.grouping import aggregate

_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "impute_group_median",
    rounded_sql(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(disc, m) AS disc FROM
    (SELECT *, l_orderkey % 5 = 0 AS test FROM {LINES}) LEFT JOIN
    (SELECT l_orderkey % 5 = 0 AS t2, o_orderpriority AS p2, median(disc) AS m FROM {LINES} GROUP BY 1, 2) ON test = t2 AND o_orderpriority = p2"""),
)
def impute_group_median(t: Tables):
    df = t.lines.select(*_ID, "disc", "o_orderpriority", (F.col("l_orderkey") % 5 == 0).alias("test"))
    groups = ["test", "o_orderpriority"]
    return rounded(impute.impute_group(df, impute.fit_group(df, groups, ["disc"])).select(*_ID, "disc"))


@query(
    "impute_group_mean",
    rounded_sql(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(disc, m) AS disc FROM {LINES} LEFT JOIN
    (SELECT flag AS f, avg(disc) AS m FROM {LINES} WHERE flag IS NOT NULL GROUP BY 1) ON flag = f"""),
)
def impute_group_mean(t: Tables):
    df = t.lines.select(*_ID, "disc", "flag")
    return rounded(impute.impute_group(df, impute.fit_group(df, "flag", ["disc"], "mean")).select(*_ID, "disc"))


@query(
    "impute_global_mean",
    rounded_sql(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(disc, (SELECT avg(disc) FROM {LINES})) AS disc FROM {LINES}"),
)
def impute_global_mean(t: Tables):
    df = t.lines.select(*_ID, "disc")
    return rounded(impute.impute_mean(df, impute.fit_mean(df, ["disc"])))


@query(
    "lookup_group_median",
    rounded_sql("SELECT o_orderkey, m AS typical_price FROM orders JOIN (SELECT o_orderpriority AS p, median(o_totalprice) AS m FROM orders GROUP BY 1) ON o_orderpriority = p", 4),
)
def lookup_group_median(t: Tables):
    stats = impute.fit_group(t.orders, "o_orderpriority", ["o_totalprice"])
    df = impute.lookup_group(t.orders, stats, "o_totalprice", "typical_price")
    return rounded(df.select("o_orderkey", "typical_price"), 4)


@query(
    "label_encode",
    """SELECT c_custkey, CAST(coalesce(code, -1) AS INTEGER) AS segment FROM customer LEFT JOIN
    (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT c_mktsegment AS v FROM customer WHERE c_nationkey < 10 AND c_mktsegment <> 'MACHINERY')) ON c_mktsegment = v""",
)
def label_encode(t: Tables):
    train = t.customer.where("c_nationkey < 10 and c_mktsegment <> 'MACHINERY'")
    df = encode.label_encode(t.customer, encode.fit_labels(train, "c_mktsegment"), "c_mktsegment", "segment")
    return df.select("c_custkey", "segment")


@query(
    "label_encode_numeric",
    """WITH c AS (SELECT c_custkey, c_nationkey, CAST(floor(c_acctbal / 20) AS BIGINT) AS band FROM customer),
    n AS (SELECT c_nationkey, row_number() OVER (ORDER BY c_nationkey) - 1 AS few FROM (SELECT DISTINCT c_nationkey FROM c)),
    b AS (SELECT band, row_number() OVER (ORDER BY band) - 1 AS many FROM (SELECT DISTINCT band FROM c))
    SELECT c_custkey, CAST(few AS INTEGER) AS few, CAST(many AS INTEGER) AS many FROM c JOIN n USING (c_nationkey) JOIN b USING (band)""",
)
def label_encode_numeric(t: Tables):
    """Integer columns below and above the size of an inline vocabulary: the same order of numbers."""
    df = t.customer.select("c_custkey", F.col("c_nationkey").alias("few"), F.floor(F.col("c_acctbal") / 20).alias("many"))
    return encode.encode_labels(df, df, ["few", "many"]).select("c_custkey", "few", "many")


@query(
    "label_encode_wide",
    """SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_name) - 1 AS INTEGER) AS c_name FROM customer""",
)
def label_encode_wide(t: Tables):
    """As many values as rows: the numbering runs over sorted partitions, not in one task."""
    return encode.label_encode(t.customer.select("c_custkey", "c_name"), encode.fit_labels(t.customer, "c_name"), "c_name")


@query(
    "missing_indicators",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN disc IS NULL THEN 1 ELSE 0 END AS is_nan_disc,
    CASE WHEN flag IS NULL THEN 1 ELSE 0 END AS is_nan_flag FROM {LINES}""",
)
def missing_indicators(t: Tables):
    return impute.missing_indicators(t.lines.select(*_ID, "dpd", "disc", "flag")).drop("dpd", "disc", "flag")


@query(
    "standardize",
    rounded_sql("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity - mq) / sq AS l_quantity, (l_tax - mt) / st AS l_tax FROM lineitem,
    (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM lineitem)"""),
)
def standardize(t: Tables):
    df = t.lineitem.select(*_ID, "l_quantity", "l_tax")
    return rounded(impute.standardize(df, impute.fit_standardize(df, ["l_quantity", "l_tax"])))


# --- profiles ------------------------------------------------------------------------------------------------------


@query(
    "missing_profile",
    f"""SELECT column_name, CAST(missing AS BIGINT) AS missing, round(100.0::DOUBLE * missing / n, 6) AS percent FROM (
    SELECT 'disc' AS column_name, sum(CASE WHEN disc IS NULL THEN 1 ELSE 0 END) AS missing, count(*) AS n FROM {LINES}
    UNION ALL SELECT 'flag', sum(CASE WHEN flag IS NULL THEN 1 ELSE 0 END), count(*) FROM {LINES}
    UNION ALL SELECT 'dpd', 0, count(*) FROM {LINES}) ORDER BY 2 DESC""",
)
def missing_profile(t: Tables):
    return rounded(profile.missing_profile(t.lines.select("disc", "flag", "dpd")))


@query(
    "target_rate_by_category",
    "SELECT r_name, count(*) AS contracts, round(avg(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END), 6) AS target_rate FROM " + CUSTOMERS + " GROUP BY 1 ORDER BY 3 DESC, 1",
)
def target_rate_by_category(t: Tables):
    df = t.customers.select("r_name", F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("target"))
    return rounded(profile.target_rate_by_category(df, "r_name", "target"))


_CORR = ["l_quantity", "l_extendedprice", "l_tax", "disc", "dpd", "o_totalprice"]


@query(
    "correlation_matrix",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 5) + 0 AS corr FROM {LINES}" for a in _CORR for b in _CORR),
)
def correlation_matrix(t: Tables):
    return rounded(profile.correlation_matrix(t.lines, _CORR), 5)


@query(
    "histogram",
    """SELECT CAST(least(99, floor((o_totalprice - lo) / (hi - lo) * 100)) AS INTEGER) AS bin, count(*) AS n FROM orders,
    (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) GROUP BY 1""",
)
def histogram(t: Tables):
    return profile.histogram(t.orders, "o_totalprice")


# --- folds and metrics: label and score of labelled documents, coarsened so that scores tie ------------------------

_FOLD = "CAST(CAST(concat('0x', substr(md5(concat({key}, ':546789')), 1, 8)) AS BIGINT) % 5 AS INTEGER)"
_SCORED = f"""(SELECT f AS fold, y, sc FROM (SELECT {_FOLD.format(key='doc_id')} AS f, toxic AS y, CAST(n_chars // 50 AS DOUBLE) AS sc
  FROM labels JOIN documents USING (doc_id)) UNION ALL SELECT -1, toxic, CAST(n_chars // 50 AS DOUBLE) FROM labels JOIN documents USING (doc_id))"""
_LEVELS = f"(SELECT fold, sc, CAST(sum(y) AS BIGINT) AS p, CAST(sum(1 - y) AS BIGINT) AS n FROM {_SCORED} GROUP BY 1, 2)"
_ASC = f"""(SELECT *, CAST(sum(n) OVER (PARTITION BY fold ORDER BY sc) AS BIGINT) - n AS nb, CAST(sum(p) OVER (PARTITION BY fold) AS BIGINT) AS pos,
  CAST(sum(n) OVER (PARTITION BY fold) AS BIGINT) AS neg FROM {_LEVELS})"""
_DESC = f"""(SELECT *, CAST(sum(p) OVER w AS BIGINT) AS cp, CAST(sum(n) OVER w AS BIGINT) AS cn, CAST(sum(p) OVER (PARTITION BY fold) AS BIGINT) AS pos,
  CAST(sum(n) OVER (PARTITION BY fold) AS BIGINT) AS neg FROM {_LEVELS} WINDOW w AS (PARTITION BY fold ORDER BY sc DESC))"""
_AUC = f"(SELECT fold, pos, neg, sum(p * (nb + n / 2.0::DOUBLE)) / nullif(CAST(pos AS DOUBLE) * neg, 0) AS auc FROM {_ASC} GROUP BY 1, 2, 3)"


def _scored(t: Tables):
    docs = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return docs.select(
        model.kfold_column("doc_id").alias("fold"), F.col("toxic").alias("y"), F.floor(F.col("n_chars") / 50).cast("double").alias("sc")
    )


@query("kfold_assign", f"SELECT c_custkey, {_FOLD.format(key='c_custkey')} AS fold FROM customer")
def kfold_assign(t: Tables):
    return model.assign_folds(t.customer.select("c_custkey"), "c_custkey")


@query("auc_by_fold", rounded_sql(f"SELECT * FROM {_AUC}"))
def auc_by_fold(t: Tables):
    return rounded(metrics.auc_by_fold(_scored(t), "y", "sc", "fold"))


@query(
    "roc_curve",
    rounded_sql(f"""SELECT fold, sc AS threshold, cn / nullif(neg, 0) AS fpr, cp / nullif(pos, 0) AS tpr FROM {_DESC}
    UNION ALL SELECT DISTINCT fold, NULL, 0, 0 FROM {_LEVELS}"""),
)
def roc_curve(t: Tables):
    return rounded(metrics.roc_curve(_scored(t), "y", "sc", "fold"))


@query(
    "pr_curve",
    rounded_sql(f"""SELECT fold, sc AS threshold, cp / nullif(cp + cn, 0) AS prec, cp / nullif(pos, 0) AS recall FROM {_DESC}
    UNION ALL SELECT DISTINCT fold, NULL, 1, 0 FROM {_LEVELS}"""),
)
def pr_curve(t: Tables):
    return rounded(metrics.pr_curve(_scored(t), "y", "sc", "fold"))


@query("average_precision", rounded_sql(f"SELECT fold, sum(p / nullif(pos, 0) * (cp / (cp + cn))) AS ap FROM {_DESC} GROUP BY 1"))
def average_precision(t: Tables):
    return rounded(metrics.average_precision(_scored(t), "y", "sc", "fold"))


@query(
    "fold_score_spread",
    rounded_sql(f"""SELECT max(auc) FILTER (WHERE fold = -1) AS auc_all, avg(auc) FILTER (WHERE fold <> -1) AS auc_mean,
    stddev_pop(auc) FILTER (WHERE fold <> -1) AS auc_std FROM {_AUC}"""),
)
def fold_score_spread(t: Tables):
    return rounded(metrics.fold_score_spread(metrics.auc_by_fold(_scored(t), "y", "sc", "fold")))


# --- models: the customer's order and line history predicts a negative balance -------------------------------------

_FEATURES = ["n_lines", "mean_qty", "mean_dpd", "sum_price", "share_R", "c_nationkey", "segment"]


def _customer_mart(t: Tables):
    history = aggregate(
        t.lines.withColumnRenamed("o_custkey", "c_custkey"),
        "c_custkey",
        {
            "n_lines": "count(1)", "mean_qty": "avg(l_quantity)", "mean_dpd": "avg(dpd)",
            "sum_price": "sum(l_extendedprice)", "share_R": share("l_returnflag", "R"),
        },
    )
    wide = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("target")).join(history, "c_custkey", "left")
    return encode.label_encode(wide, encode.fit_labels(t.customer, "c_mktsegment"), "c_mktsegment", "segment")


def _spend_mart(t: Tables):
    """What a customer spends in all years, to be told from the orders before 1999."""
    early = t.lines.where("o_orderdate < DATE '1999-01-01'").withColumnRenamed("o_custkey", "c_custkey")
    history = aggregate(
        early,
        "c_custkey",
        {
            "n_lines": "count(1)", "mean_qty": "avg(l_quantity)", "mean_dpd": "avg(dpd)",
            "sum_price": "sum(l_extendedprice)", "share_R": share("l_returnflag", "R"),
        },
    )
    spent = aggregate(t.lines.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", {"spent": "sum(l_extendedprice)"})
    wide = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment").join(history, "c_custkey", "left").join(spent, "c_custkey", "left")
    wide = wide.withColumn("target", F.when(F.col("spent") > 2_000_000, 1).otherwise(0)).drop("spent")
    return encode.label_encode(wide, encode.fit_labels(t.customer, "c_mktsegment"), "c_mktsegment", "segment")


def _cross_validated(t: Tables):
    mart = _spend_mart(t)
    train = mart.where("c_custkey % 5 <> 0")
    return mart, model.cross_validate(train, "c_custkey", "target", _FEATURES, max_iter=5, max_depth=4)


# tree growth has no SQL; what must hold of any useful fit has: folds and rows, AUC, the side on which labels score, shares
# that sum to 1. A score that is the same for all rows fails each of them
_SPEND = """(SELECT c_custkey, CAST(coalesce(spent, 0) > 2000000 AS INTEGER) AS label FROM customer LEFT JOIN
  (SELECT o_custkey, sum(l_extendedprice) AS spent FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) ON c_custkey = o_custkey)"""
_TRAIN = f"(SELECT c_custkey, label, {_FOLD.format(key='c_custkey')} AS fold FROM {_SPEND} WHERE c_custkey % 5 <> 0)"


@query(
    "train_gbt_cv",
    f"""SELECT fold, count(*) AS n_rows, true AS auc_above, true AS trees_in_range FROM (SELECT fold FROM {_TRAIN} UNION ALL SELECT -1 FROM {_TRAIN})
    GROUP BY 1""",
)
def train_gbt_cv(t: Tables):
    report = model.fold_report(_cross_validated(t)[1])
    trees = F.expr("n_trees BETWEEN 1 AND 5 OR (fold = -1 AND n_trees BETWEEN 5 AND 25)")
    return report.select("fold", "n_rows", F.expr("coalesce(auc, 0) > 0.6").alias("auc_above"), trees.alias("trees_in_range"))


@query("oof_predict", f"SELECT c_custkey, label, fold, true AS score_in_range, true AS separates FROM {_TRAIN}")
def oof_predict(t: Tables):
    oof = _cross_validated(t)[1].oof
    gaps = model.separation(oof, "label", "score", "fold")
    return oof.join(F.broadcast(gaps), "fold").select(
        "c_custkey", "label", "fold", F.expr("score BETWEEN 0 AND 1").alias("score_in_range"), F.expr("gap > 0.1").alias("separates")
    )


@query("score_avg_folds", f"SELECT c_custkey, label, true AS score_in_range, true AS separates FROM {_SPEND} WHERE c_custkey % 5 = 0")
def score_avg_folds(t: Tables):
    mart, result = _cross_validated(t)
    test = mart.where("c_custkey % 5 = 0")
    scored = result.score_average(test).join(test.selectExpr("c_custkey", "target AS label"), "c_custkey")
    gap = model.separation(scored, "label", "score")
    return scored.crossJoin(F.broadcast(gap)).select(
        "c_custkey", "label", F.expr("score BETWEEN 0 AND 1").alias("score_in_range"), F.expr("gap > 0.1").alias("separates")
    )


@query(
    "feature_importance",
    """SELECT feature, true AS in_range, 1.0::DOUBLE AS total, feature = 'sum_price' AS first
    FROM (SELECT unnest(['n_lines', 'mean_qty', 'mean_dpd', 'sum_price', 'share_R', 'c_nationkey', 'segment']) AS feature)""",
)
def feature_importance(t: Tables):
    """The early spend matters most for the whole spend."""
    from relfeat.operators.ordered import top_n

    top = top_n(metrics.mean_importance(_cross_validated(t)[1].importances()), 50, "importance", "feature")
    total = top.agg(F.round(F.sum("importance"), 6).alias("total"), F.max("importance").alias("most"))
    return top.crossJoin(F.broadcast(total)).select(
        "feature", F.expr("importance BETWEEN 0 AND 1").alias("in_range"), "total", F.expr("importance = most").alias("first")
    )


_Z = "(c_nationkey - m1) / s1 AS x, (c_acctbal - m2) / s2 AS y, sign(r) AS r"


@query(
    "pca_project",
    f"""SELECT c_custkey, round(abs(x + r * y) / sqrt(2), 6) AS principal_component_1, round(abs(x - r * y) / sqrt(2), 6) AS principal_component_2
    FROM (SELECT c_custkey, {_Z} FROM customer, (SELECT avg(c_nationkey) AS m1, stddev_pop(c_nationkey) AS s1, avg(c_acctbal) AS m2,
      stddev_pop(c_acctbal) AS s2, corr(c_nationkey, c_acctbal) AS r FROM customer WHERE c_custkey % 5 <> 0))""",
)
def pca_project(t: Tables):
    """Two standardised columns: the components are their sum and difference over the root of 2, up to the sign."""
    projected = model.pca_project(t.customer.where("c_custkey % 5 <> 0"), t.customer, "c_custkey", ["c_nationkey", "c_acctbal"], 2)
    names = ["principal_component_1", "principal_component_2"]
    return projected.select("c_custkey", *[F.round(F.abs(n), 6).alias(n) for n in names])


@query(
    "pca_project_mart",
    """SELECT count(*) AS n_rows, true AS orthogonal, true AS ordered,
      round(2 + 5 * avg(CAST(c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey) AS INTEGER)), 6) AS variance
    FROM customer WHERE c_custkey % 5 <> 0""",
)
def pca_project_mart(t: Tables):
    """All components of the mart: uncorrelated, by falling variance, and with the variance of the features in total,
    which is 1 for a feature of every customer and the share of customers with orders for one of their history."""
    train = _customer_mart(t).where("c_custkey % 5 <> 0")
    n = [f"principal_component_{i + 1}" for i in range(len(_FEATURES))]
    projected = model.pca_project(train, train, "c_custkey", _FEATURES, len(n))
    pairs = [f"abs(covar_pop({a}, {b})) < 1e-6" for i, a in enumerate(n) for b in n[:i]]
    falling = [f"var_pop({a}) >= var_pop({b})" for a, b in zip(n, n[1:])]
    return projected.agg(
        F.count(F.lit(1)).alias("n_rows"), F.expr(" AND ".join(pairs)).alias("orthogonal"), F.expr(" AND ".join(falling)).alias("ordered"),
        F.round(F.expr(" + ".join(f"var_pop({c})" for c in n)), 6).alias("variance"),
    )
