"""Grouped aggregates, recipes, ordered-group operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from relfeat.driver.registry import LINE_TIES, LINES, Tables, query, rounded, rounded_sql
from relfeat.functions import aggs as A
from relfeat.functions.expr import columns, ratio, trunc_int
from relfeat.operators import encode, ordered, profile
from relfeat.operators.grouping import Nested, aggregate, aggregate_named, all_numeric_mean, all_weighted_mean, group_deviation, group_recipe

KEY = "o_custkey"


def _per_customer(columns: str, digits: int = 6) -> str:
    return rounded_sql(f"SELECT o_custkey, {columns} FROM {LINES} GROUP BY o_custkey", digits)


@query("agg_count", _per_customer("count(*) AS n_rows, count(disc) AS n_disc, count(flag) AS n_flag"))
def agg_count(t: Tables):
    return aggregate(t.lines, KEY, {"n_rows": "count(1)", "n_disc": "count(disc)", "n_flag": "count(flag)"})


@query("agg_sum", _per_customer("coalesce(sum(disc), 0) AS sum_disc, CAST(sum(dpd) AS BIGINT) AS sum_dpd, sum(l_extendedprice) AS sum_price", 4))
def agg_sum(t: Tables):
    return rounded(aggregate(t.lines, KEY, {"sum_disc": A.total("disc"), "sum_dpd": A.total("dpd"), "sum_price": A.total("l_extendedprice")}), 4)


@query("agg_mean", _per_customer("avg(disc) AS mean_disc, avg(l_quantity) AS mean_qty, avg(dpd) AS mean_dpd"))
def agg_mean(t: Tables):
    return rounded(aggregate(t.lines, KEY, {"mean_disc": "avg(disc)", "mean_qty": "avg(l_quantity)", "mean_dpd": "avg(dpd)"}))


_SWEEP = ["l_quantity", "l_extendedprice", "l_tax", "disc", "dpd", "months"]


@query("agg_min", _per_customer(", ".join(f"min({c}) AS {c}_min" for c in _SWEEP)))
def agg_min(t: Tables):
    return rounded(aggregate_named(t.lines, KEY, [(c, "min") for c in _SWEEP]))


@query("agg_max", _per_customer(", ".join(f"max({c}) AS {c}_max" for c in _SWEEP)))
def agg_max(t: Tables):
    return rounded(aggregate_named(t.lines, KEY, [(c, "max") for c in _SWEEP]))


@query("agg_var", _per_customer("var_samp(l_quantity) AS l_quantity_var, var_samp(dpd) AS dpd_var"))
def agg_var(t: Tables):
    return rounded(aggregate_named(t.lines, KEY, [("l_quantity", "var"), ("dpd", "var")]))


@query("agg_std", _per_customer("stddev_samp(l_quantity) AS l_quantity_std, stddev_samp(dpd) AS dpd_std"))
def agg_std(t: Tables):
    return rounded(aggregate_named(t.lines, KEY, [("l_quantity", "std"), ("dpd", "std")]))


@query("agg_median", _per_customer("median(l_extendedprice) AS l_extendedprice_median, median(disc) AS disc_median, median(dpd) AS dpd_median"))
def agg_median(t: Tables):
    return rounded(aggregate_named(t.lines, KEY, [("l_extendedprice", "median"), ("disc", "median"), ("dpd", "median")]))


@query("agg_median_by_flag", rounded_sql("SELECT l_returnflag, median(l_extendedprice) AS l_extendedprice_median, quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) AS l_quantity_iqr FROM lineitem GROUP BY 1", 6, ["l_returnflag"]))
def agg_median_by_flag(t: Tables):
    """Three huge groups, cut at their own values."""
    specs = [("l_extendedprice", "median"), ("l_quantity", "iqr")]
    return rounded(aggregate_named(t.lineitem, "l_returnflag", specs))


def _moments(value: str, name: str) -> str:
    """Population moments around the customer's own mean."""
    return rounded_sql(
        f"""SELECT o_custkey, CASE WHEN m2 > 1e-9 THEN {value} END AS {name} FROM (SELECT o_custkey, avg(d * d) AS m2, avg(d * d * d) AS m3,
        avg(d * d * d * d) AS m4 FROM (SELECT o_custkey, dpd - avg(dpd) OVER (PARTITION BY o_custkey) AS d FROM {LINES}) GROUP BY 1)""",
        10,
    )


@query("agg_skew", _moments("m3 / pow(m2, 1.5)", "dpd_skew"))
def agg_skew(t: Tables):
    return rounded(aggregate_named(t.lines, KEY, [("dpd", "skew")]), 10)


@query("agg_kurt", _moments("m4 / (m2 * m2) - 3", "dpd_kurt"))
def agg_kurt(t: Tables):
    return rounded(aggregate_named(t.lines, KEY, [("dpd", "kurt")]), 10)


@query("agg_iqr", _per_customer("quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) AS l_quantity_iqr"))
def agg_iqr(t: Tables):
    return rounded(aggregate_named(t.lines, KEY, [("l_quantity", "iqr")]))


@query("agg_nunique", _per_customer("count(DISTINCT l_orderkey) AS l_orderkey_nunique, count(DISTINCT flag) AS flag_nunique, count(DISTINCT l_suppkey) AS l_suppkey_nunique"))
def agg_nunique(t: Tables):
    return aggregate_named(t.lines, KEY, [(c, "nunique") for c in ("l_orderkey", "flag", "l_suppkey")])


@query("agg_all_numeric_mean", _per_customer(", ".join(f"avg({c}) AS {c}" for c in ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "disc", "dpd", "months")), 8))
def agg_all_numeric_mean(t: Tables):
    keep = ["o_custkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "disc", "dpd", "months", "flag"]
    return rounded(all_numeric_mean(t.lines.select(*keep), KEY), 8)


_W = "(-1.0::DOUBLE / months)"


@query(
    "weighted_mean_recency",
    _per_customer(
        f"""sum(dpd * {_W}) / sum({_W}) AS wm_dpd, CASE WHEN count(disc) = count(*) THEN sum(disc * {_W}) / sum({_W}) END AS wm_disc,
    sum(disc * {_W}) / nullif(sum(CASE WHEN disc IS NOT NULL THEN {_W} END), 0) AS wm_disc_skip"""
    ),
)
def weighted_mean_recency(t: Tables):
    w = A.recency_weight("months")
    return rounded(
        aggregate(t.lines, KEY, {"wm_dpd": A.weighted_mean("dpd", w), "wm_disc": A.weighted_mean("disc", w), "wm_disc_skip": A.weighted_mean("disc", w, skip_null=True)})
    )


_NUM = ["l_quantity", "l_discount", "l_tax", "dpd", "l_linenumber"]


@query("weighted_mean_all", _per_customer(", ".join(f"sum({c} * {_W}) / sum({_W}) AS {c}" for c in _NUM)))
def weighted_mean_all(t: Tables):
    w = A.recency_weight("months")
    return rounded(all_weighted_mean(t.lines.select(KEY, "months", *_NUM), KEY, w, leave=[c for c in ["months"] if c not in _NUM]))


@query(
    "agg_two_level",
    rounded_sql(f"""SELECT o_custkey, sum(mx) AS sum_of_max, avg(n) AS mean_count, count(*) AS n_loans FROM
    (SELECT o_custkey, l_orderkey, max(l_linenumber) AS mx, count(*) AS n FROM {LINES} GROUP BY 1, 2) GROUP BY 1"""),
)
def agg_two_level(t: Tables):
    n = Nested().of_groups("sum_of_max", "max(l_linenumber)", "coalesce(sum({}), 0)")
    n.of_groups("mean_count", "count(1)", "avg({})").group_count("n_loans")
    return rounded(n.run(t.lines, KEY, "l_orderkey"))


@query(
    "agg_count_if",
    rounded_sql(f"""SELECT o_custkey, avg(c) AS dpd_count, CAST(sum(c) AS BIGINT) AS n_late FROM (SELECT o_custkey, l_orderkey,
    sum(CASE WHEN flag IS NOT NULL AND dpd = 0 THEN 0 ELSE 1 END) AS c FROM {LINES} GROUP BY 1, 2) GROUP BY 1"""),
)
def agg_count_if(t: Tables):
    late = A.count_not_zero("CASE WHEN flag IS NOT NULL THEN dpd END")
    n = Nested().of_groups("dpd_count", late, "avg({})").of_groups("n_late", late, "sum({})")
    return rounded(n.run(t.lines, KEY, "l_orderkey"))


@query("agg_pct_if", _per_customer("100.0::DOUBLE * sum(CASE WHEN l_tax < disc THEN 1 ELSE 0 END) / count(*) AS pct_below"))
def agg_pct_if(t: Tables):
    return rounded(aggregate(t.lines, KEY, {"pct_below": A.percent_if("l_tax < disc")}))


@query("agg_bool_sum", _per_customer("CAST(sum(CASE WHEN flag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned"))
def agg_bool_sum(t: Tables):
    return aggregate(t.lines, KEY, {"n_returned": A.count_if("flag = 'R'")})


_DUE, _PAID = "sum(l_extendedprice) / 1000", "sum(l_extendedprice * (1 - l_discount)) / 1000"


@query(
    "agg_ratio_of_sums",
    _per_customer(f"{_PAID} / nullif({_DUE}, 0) AS paid_ratio, {_DUE} - {_PAID} AS unpaid, ({_DUE} + {_PAID} - sum(l_tax)) / nullif({_DUE} + {_PAID}, 0) AS margin", 7),
)
def agg_ratio_of_sums(t: Tables):
    paid = A.total("l_extendedprice * (1 - l_discount)")
    sums = aggregate(t.lines, KEY, {"due": f"{A.total('l_extendedprice')} / 1000", "paid": f"{paid} / 1000", "tax": A.total("l_tax")})
    over = {"paid_ratio": ratio("paid", "due"), "unpaid": "due - paid", "margin": ratio("due + paid - tax", "due + paid")}
    return rounded(sums.select(KEY, *columns(over)), 7)


@query("agg_per_distinct", rounded_sql(f"""SELECT o_custkey, CAST(trunc(sum(mx) / count(*)) AS INTEGER) AS lines_per_order FROM
    (SELECT o_custkey, l_orderkey, max(l_linenumber) AS mx FROM {LINES} GROUP BY 1, 2) GROUP BY 1"""))
def agg_per_distinct(t: Tables):
    n = Nested().of_groups("total", "max(l_linenumber)", "coalesce(sum({}), 0)").group_count("loans")
    return n.run(t.lines, KEY, "l_orderkey").select(KEY, *columns({"lines_per_order": trunc_int(ratio("total", "loans"))}))


_RECIPES = [
    (["flag"], [("l_quantity", "mean"), ("l_quantity", "max"), ("dpd", "sum"), ("l_quantity", "median")]),
    (["flag", "o_orderpriority"], [("l_tax", "mean"), ("l_quantity", "min")]),
]
_RECIPE_SQL = f"""(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_tax, flag_mean_l_quantity, flag_max_l_quantity, flag_sum_dpd,
  flag_median_l_quantity, flag_o_orderpriority_mean_l_tax, flag_o_orderpriority_min_l_quantity FROM {LINES} x
  LEFT JOIN (SELECT flag AS f1, avg(l_quantity) AS flag_mean_l_quantity, max(l_quantity) AS flag_max_l_quantity, CAST(sum(dpd) AS BIGINT) AS flag_sum_dpd,
   median(l_quantity) AS flag_median_l_quantity FROM {LINES} WHERE flag IS NOT NULL GROUP BY 1) ON flag = f1
  LEFT JOIN (SELECT flag AS f2, o_orderpriority AS p2, avg(l_tax) AS flag_o_orderpriority_mean_l_tax, min(l_quantity) AS flag_o_orderpriority_min_l_quantity
   FROM {LINES} WHERE flag IS NOT NULL GROUP BY 1, 2) ON flag = f2 AND o_orderpriority = p2)"""
_RECIPE_IN = [*LINE_TIES, "l_quantity", "l_tax", "flag", "dpd", "o_orderpriority"]


@query("group_recipe", rounded_sql(f"SELECT * EXCLUDE (l_quantity, l_tax) FROM {_RECIPE_SQL}", 5))
def recipe(t: Tables):
    df = group_recipe(t.lines.select(*_RECIPE_IN), _RECIPES)
    return rounded(df.drop("l_quantity", "l_tax", "flag", "dpd", "o_orderpriority"), 5)


def _deviation_sql() -> str:
    parts = []
    for keys, specs in _RECIPES:
        for c, a in specs:
            if a != "sum":
                n = f"{'_'.join(keys)}_{a}_{c}"
                parts += [f"{c} - {n} AS {n}_diff", f"abs({c} - {n}) AS {n}_abs_diff"]
    return rounded_sql(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(parts)} FROM {_RECIPE_SQL}", 5)


@query("group_deviation", _deviation_sql())
def deviation(t: Tables):
    df = group_deviation(group_recipe(t.lines.select(*_RECIPE_IN), _RECIPES), _RECIPES)
    return rounded(df.select(*LINE_TIES, *[c for c in df.columns if c.endswith("_diff")]), 5)


@query(
    "onehot_share",
    rounded_sql("""SELECT o_custkey, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0 END) AS o_orderstatus_F,
    avg(CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE ELSE 0 END) AS o_orderstatus_O, avg(CASE WHEN o_orderstatus = 'P' THEN 1.0::DOUBLE ELSE 0 END) AS o_orderstatus_P
    FROM orders GROUP BY 1"""),
)
def onehot_share(t: Tables):
    return rounded(encode.onehot_share(t.orders, KEY, encode.fit_vocabulary(t.orders, ["o_orderstatus"])))


@query(
    "onehot_share_long",
    rounded_sql("""SELECT l_returnflag, l_partkey AS value, n, n / sum(n) OVER (PARTITION BY l_returnflag)::DOUBLE AS share
    FROM (SELECT l_returnflag, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2)""", 10, ["l_returnflag"]),
)
def onehot_share_long(t: Tables):
    """A column with thousands of values: rows instead of columns."""
    return rounded(encode.share_rows(t.lineitem, "l_returnflag", "l_partkey"), 10)


@query("value_counts", f"SELECT flag, count(*) AS n FROM {LINES} WHERE flag IS NOT NULL GROUP BY 1 ORDER BY 2 DESC")
def value_counts(t: Tables):
    return profile.value_counts(t.lines, "flag")


# --- order inside the group ----------------------------------------------------------------------------------------


@query(
    "lag_diff",
    """SELECT o_custkey, o_orderkey, coalesce(lag(day) OVER (PARTITION BY o_custkey ORDER BY day DESC, o_orderkey) - day, 0) AS gap
    FROM (SELECT o_custkey, o_orderkey, CAST(date_diff('day', TIMESTAMP '2002-01-01', o_orderdate) AS INTEGER) AS day FROM orders)""",
)
def lag_diff(t: Tables):
    day = F.datediff(F.col("o_orderdate"), F.lit("2002-01-01").cast("date"))
    gaps = ordered.lag_diff(t.orders.select(KEY, "o_orderkey", day.alias("day")), KEY, "day", "o_orderkey", "gap")
    return gaps.select(KEY, "o_orderkey", "gap")


_LATEST = "months DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC"


@query(
    "last_by_order",
    rounded_sql(f"""SELECT o_custkey, last_disc FROM (SELECT DISTINCT o_custkey FROM {LINES}) LEFT JOIN (SELECT o_custkey, disc AS last_disc FROM {LINES} WHERE disc IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY months DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1) USING (o_custkey)"""),
)
def last_by_order(t: Tables):
    return rounded(ordered.last_by_order(t.lines, KEY, "disc", "months", LINE_TIES, "last_disc"))


_RANKED = f"(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {_LATEST}) AS rn, CASE WHEN dpd > 5 THEN 1 ELSE 0 END AS late FROM {LINES})"
_SPECS = {"late": ["count", "mean"], "dpd": ["sum", "mean", "max", "min", "median"]}


def _last_k_sql(ks, specs=_SPECS) -> list[str]:
    sql = {"mean": "avg", "count": "count", "sum": "sum", "max": "max", "min": "min", "median": "median"}
    out = []
    for k in ks:
        where, prefix = ("", "all_installment_") if k is None else (f" FILTER (WHERE rn <= {k})", f"last_{k}_")
        for c, names in specs.items():
            for a in names:
                call = f"{sql[a]}({c}){where}"
                out.append(f"{f'CAST({call} AS BIGINT)' if a == 'sum' else call} AS {prefix}{c}_{a}")
    return out


def _late(t: Tables):
    return ordered.late_flags(t.lines.withColumn("over5", F.col("dpd") - 5), {"late": "over5"})


@query("last_k_aggregate", rounded_sql(f"SELECT o_custkey, {', '.join(_last_k_sql([1, 10, 50, None]))} FROM {_RANKED} GROUP BY 1"))
def last_k_aggregate(t: Tables):
    return rounded(ordered.last_k_aggregate(_late(t), KEY, "months", LINE_TIES, [1, 10, 50], _SPECS))


@query(
    "last_group_aggregate",
    rounded_sql(f"""SELECT o_custkey, count(dpd) AS last_loan_dpd_count, CAST(sum(dpd) AS BIGINT) AS last_loan_dpd_sum, avg(dpd) AS last_loan_dpd_mean,
    max(dpd) AS last_loan_dpd_max, min(dpd) AS last_loan_dpd_min, stddev_samp(dpd) AS last_loan_dpd_std FROM {LINES} JOIN
    (SELECT o_custkey AS k, arg_max(l_orderkey, (months, l_orderkey)) AS last_order FROM {LINES} GROUP BY 1) ON o_custkey = k AND l_orderkey = last_order GROUP BY 1"""),
)
def last_group_aggregate(t: Tables):
    specs = [("dpd", a) for a in ("count", "sum", "mean", "max", "min", "std")]
    return rounded(ordered.last_group_aggregate(t.lines, KEY, "l_orderkey", "months", specs))


_TRENDS = [1, 6, 12, 30, 60]


def _trend_sql(c: str) -> str:
    cols = [
        f"""CASE WHEN count(*) FILTER (WHERE rn <= {k}) = 1 THEN 0 ELSE regr_slope({c}, rn - 1) FILTER (WHERE rn <= {k}) END AS "{k}_period_trend_{c}\""""
        for k in _TRENDS
    ]
    return rounded_sql(f"SELECT o_custkey, {', '.join(cols)} FROM {_RANKED} GROUP BY 1")


@query("trend_slope", _trend_sql("dpd"))
def trend_slope(t: Tables):
    return rounded(ordered.trend_slope(t.lines, KEY, "months", LINE_TIES, _TRENDS, ["dpd"]))


@query(
    "period_fraction",
    rounded_sql(
        f"""SELECT o_custkey, last_10_dpd_sum / nullif(last_50_dpd_sum, 0) AS last_10by50_fraction_dpd_sum, last_10_dpd_mean / nullif(last_50_dpd_mean, 0) AS last_10by50_fraction_dpd_mean
    FROM (SELECT o_custkey, {', '.join(_last_k_sql([10, 50], {'dpd': ['sum', 'mean']}))} FROM {_RANKED} GROUP BY 1)"""
    ),
)
def period_fraction(t: Tables):
    recent = ordered.last_k_aggregate(t.lines, KEY, "months", LINE_TIES, [10, 50], {"dpd": ["sum", "mean"]}, whole=False)
    df = ordered.period_fraction(recent, 10, 50)
    return rounded(df.select(KEY, *[c for c in df.columns if "fraction" in c]))


@query("late_flags", f"SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN dpd > 0 THEN 1 ELSE 0 END AS paid_late, CASE WHEN disc > 0 THEN 1 ELSE 0 END AS paid_late_with_tolerance FROM {LINES}")
def late_flags(t: Tables):
    df = ordered.late_flags(t.lines, {"paid_late": "dpd", "paid_late_with_tolerance": "disc"})
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "paid_late", "paid_late_with_tolerance")
