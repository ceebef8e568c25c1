"""Scans, sinks, projections, filters, scalar expressions, joins, sorting, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from relfeat.driver.registry import CUSTOMERS, LINES, Tables, query, rounded, rounded_sql
from relfeat.functions import expr as E
from relfeat.operators import encode, joins, ordered, profile
from relfeat.operators.grouping import aggregate
from relfeat.plans.application import interaction_flags
from relfeat.plans.blocks import assemble_mart
from relfeat.session import fresh_dir
from relfeat.sources import tables as src


@query("scan_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_table(t: Tables):
    return t.scan("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("sink_predictions", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END AS score FROM customer")
def sink_predictions(t: Tables):
    path = fresh_dir(t.spark, "predictions")
    scored = t.customer.withColumn("score", F.when(F.col("c_acctbal") < 0, 1.0).otherwise(0.25))
    src.write_predictions(scored, "c_custkey", "score", path)
    schema = "c_custkey bigint, score double"
    return src.scan_table(t.spark, path, scored.select("c_custkey", "score").schema, "csv").selectExpr(
        *[f"CAST({c.split()[0]} AS {c.split()[1]})" for c in schema.split(", ")]
    )


@query(
    "sink_feature_matrix",
    """SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 5 = 0 THEN 'test' ELSE 'train' END AS split,
    coalesce(n, 0) AS n_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def sink_feature_matrix(t: Tables):
    path = fresh_dir(t.spark, "matrix")
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    matrix = joins.left_join(t.customer.select("c_custkey", "c_acctbal"), n, "c_custkey").fillna({"n_orders": 0})
    split = F.when(F.col("c_custkey") % 5 == 0, "test").otherwise("train")
    src.write_feature_matrix(matrix.withColumn("split", split), path, "split")
    return src.scan_table(t.spark, path)


@query("table_shape", "SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns FROM lineitem")
def table_shape(t: Tables):
    return src.table_shape(t.lineitem)


@query("project_drop", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def project_drop(t: Tables):
    return t.orders.drop("o_orderstatus", "o_orderdate", "o_orderpriority")


@query("drop_correlated", "SELECT l_orderkey, l_quantity, l_discount FROM lineitem")
def drop_correlated(t: Tables):
    df = t.lineitem.select("l_orderkey", "l_quantity", "l_discount", (F.col("l_quantity") * 2 + 1).alias("twice"))
    return profile.drop_correlated(df, ["l_quantity", "l_discount", "twice"], 0.95)


@query("rename_prefix", "SELECT o_custkey, o_orderkey AS prev_o_orderkey, o_totalprice AS prev_o_totalprice FROM orders")
def rename_prefix(t: Tables):
    return E.prefixed(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), "prev_", ["o_custkey"])


@query("filter_rows", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def filter_rows(t: Tables):
    orders = t.scan("orders", ("o_orderstatus", "=", "F"), ("o_totalprice", ">", 100000))
    return orders.select("o_orderkey", "o_totalprice")


@query("flag_threshold", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS in_debt, CASE WHEN c_nationkey >= 12 THEN 1 ELSE 0 END AS far FROM customer")
def flag_threshold(t: Tables):
    return t.customer.select("c_custkey", *E.columns({"in_debt": E.flag("c_acctbal < 0"), "far": E.flag("c_nationkey >= 12")}))


@query("flag_equals", "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS is_building FROM customer")
def flag_equals(t: Tables):
    return t.customer.select("c_custkey", *E.columns({"is_building": E.flag_equals("c_mktsegment", "BUILDING")}))


@query(
    "flag_interaction",
    f"""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND r_name = 'ASIA' THEN 1 ELSE 0 END AS is_building_asia,
    CASE WHEN c_mktsegment = 'MACHINERY' AND r_name = 'EUROPE' THEN 1 ELSE 0 END AS is_machinery_europe,
    CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal >= 5000 THEN 1 ELSE 0 END AS rich_household FROM {CUSTOMERS}""",
)
def flag_interaction(t: Tables):
    pairs = [("c_mktsegment", "BUILDING", "r_name", "ASIA"), ("c_mktsegment", "MACHINERY", "r_name", "EUROPE")]
    flags = interaction_flags(pairs)
    flags["rich_household"] = E.flag_all({"c_mktsegment": "HOUSEHOLD", "c_acctbal": (">=", 5000)})
    return t.customers.select("c_custkey", *E.columns(flags))


@query(
    "bucket_overlap",
    """SELECT p_partkey, CASE WHEN p_size <= 10 THEN 1 ELSE 0 END AS size_0_10,
    CASE WHEN p_size >= 10 AND p_size <= 25 THEN 1 ELSE 0 END AS size_10_25,
    CASE WHEN p_size >= 25 AND p_size <= 50 THEN 1 ELSE 0 END AS size_25_50 FROM part""",
)
def bucket_overlap(t: Tables):
    flags = E.overlapping_buckets("p_size", [(None, 10), (10, 25), (25, 50)])
    return t.part.select("p_partkey", *E.columns(dict(zip(("size_0_10", "size_10_25", "size_25_50"), flags))))


@query(
    "sentinel_to_null",
    """SELECT o_orderkey, nullif(CASE WHEN o_orderkey % 97 = 0 THEN 365243 ELSE CAST(year(o_orderdate) AS INTEGER) END, 365243) AS y,
    nullif(o_orderpriority, '5-LOW') AS priority FROM orders""",
)
def sentinel_to_null(t: Tables):
    raw = t.orders.withColumn("y", F.when(F.col("o_orderkey") % 97 == 0, 365243).otherwise(F.year("o_orderdate")))
    return raw.select("o_orderkey", *E.columns({"y": E.sentinel_to_null("y", 365243), "priority": E.sentinel_to_null("o_orderpriority", "5-LOW")}))


@query("replace_value", "SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN 1 ELSE c_nationkey END AS nation_no FROM customer")
def replace_value(t: Tables):
    return t.customer.select("c_custkey", *E.columns({"nation_no": E.replace_value("c_nationkey", 0, 1)}))


@query("recode_map", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0.1::DOUBLE WHEN 'O' THEN 600.0::DOUBLE END AS score FROM orders")
def recode_map(t: Tables):
    return t.orders.select("o_orderkey", *E.columns({"score": E.recode("o_orderstatus", {"F": 0.1, "O": 600.0})}))


@query(
    "fill_constant",
    f"SELECT l_orderkey, l_linenumber, l_partkey, coalesce(disc, 0) AS disc, coalesce(flag, 'none') AS flag FROM {LINES}",
)
def fill_constant(t: Tables):
    return t.lines.select("l_orderkey", "l_linenumber", "l_partkey", *E.columns({"disc": E.fill("disc", 0.0), "flag": E.fill("flag", "none")}))


@query(
    "fill_all_numeric",
    f"SELECT l_orderkey, l_linenumber, coalesce(disc, -999) AS disc, coalesce(nullif(dpd, 0), -999) AS dpd, flag FROM {LINES}",
)
def fill_all_numeric(t: Tables):
    df = t.lines.select("l_orderkey", "l_linenumber", "disc", F.nullif("dpd", F.lit(0)).alias("dpd"), "flag")
    return E.fill_all_numeric(df, -999)


@query("cast_trunc", "SELECT c_custkey, CAST(trunc(c_acctbal) AS INTEGER) AS whole, CAST(trunc(c_acctbal / 7) AS BIGINT) AS sevenths FROM customer")
def cast_trunc(t: Tables):
    return t.customer.select("c_custkey", *E.columns({"whole": E.trunc_int("c_acctbal"), "sevenths": E.trunc_int("c_acctbal / 7", "BIGINT")}))


@query("abs_value", "SELECT c_custkey, abs(c_acctbal) AS size FROM customer")
def abs_value(t: Tables):
    return t.customer.select("c_custkey", F.abs("c_acctbal").alias("size"))


@query(
    "safe_ratio",
    rounded_sql("""SELECT l_orderkey, l_linenumber, l_partkey, l_tax / nullif(l_discount, 0) AS tax_per_discount,
    l_extendedprice / nullif(l_quantity, 0) AS unit_price FROM lineitem""", 8),
)
def safe_ratio(t: Tables):
    return rounded(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", *E.columns({"tax_per_discount": E.ratio("l_tax", "l_discount"), "unit_price": E.ratio("l_extendedprice", "l_quantity")})), 8)


@query(
    "linear_combo",
    rounded_sql("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * 2 + l_discount * 3 + l_tax * 4 AS weighted,
    l_discount * l_tax AS both_rates, 1 - l_discount AS kept, l_tax - l_discount AS diff FROM lineitem"""),
)
def linear_combo(t: Tables):
    q, d, x = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    return rounded(
        t.lineitem.select(
            "l_orderkey", "l_linenumber", "l_partkey",
            (q * 2 + d * 3 + x * 4).alias("weighted"), (d * x).alias("both_rates"), (1 - d).alias("kept"), (x - d).alias("diff"),
        )
    )


_SPARSE = f"(SELECT *, CAST(dpd AS DOUBLE) AS a, CASE WHEN l_tax <> 0 THEN l_tax * 100 END AS b, disc * 100 AS c FROM {LINES})"


def _sparse(t: Tables):
    return t.lines.withColumns(
        {"a": F.col("dpd").cast("double"), "b": F.when(F.col("l_tax") != 0, F.col("l_tax") * 100), "c": F.col("disc") * 100}
    )


@query(
    "row_mean",
    rounded_sql(f"""SELECT l_orderkey, l_linenumber, l_partkey, (coalesce(b, 0) + coalesce(c, 0)) /
    nullif(CASE WHEN b IS NULL THEN 0 ELSE 1 END + CASE WHEN c IS NULL THEN 0 ELSE 1 END, 0) AS row_mean FROM {_SPARSE}"""),
)
def row_mean(t: Tables):
    return rounded(_sparse(t).select("l_orderkey", "l_linenumber", "l_partkey", *E.columns({"row_mean": E.row_mean(["b", "c"])})))


@query(
    "row_std",
    rounded_sql(f"SELECT l_orderkey, l_linenumber, l_partkey, list_stddev_samp([a, b, c]) AS row_std FROM {_SPARSE}"),
)
def row_std(t: Tables):
    return rounded(_sparse(t).select("l_orderkey", "l_linenumber", "l_partkey", *E.columns({"row_std": E.row_std(["a", "b", "c"])})))


@query(
    "row_sum_pattern",
    """SELECT p_partkey, CASE WHEN p_size > 10 THEN 1 ELSE 0 END + CASE WHEN p_size > 20 THEN 1 ELSE 0 END
    + CASE WHEN p_size > 30 THEN 1 ELSE 0 END AS n_flags FROM part""",
)
def row_sum_pattern(t: Tables):
    df = t.part.select("p_partkey", *[F.when(F.col("p_size") > n, 1).alias(f"FLAG_SIZE_{n}") for n in (10, 20, 30)])
    return df.select("p_partkey", *E.columns({"n_flags": E.row_sum(src.columns_by_pattern(df, "FLAG_SIZE"))}))


@query(
    "row_missing_fraction",
    rounded_sql(f"""SELECT l_orderkey, l_linenumber, l_partkey, (CASE WHEN a IS NULL THEN 1 ELSE 0 END + CASE WHEN b IS NULL THEN 1 ELSE 0 END
    + CASE WHEN c IS NULL THEN 1 ELSE 0 END + CASE WHEN flag IS NULL THEN 1 ELSE 0 END) / 4.0::DOUBLE AS missing FROM {_SPARSE}"""),
)
def row_missing_fraction(t: Tables):
    return rounded(_sparse(t).select("l_orderkey", "l_linenumber", "l_partkey", *E.columns({"missing": E.row_missing_fraction(["a", "b", "c", "flag"])})))


@query("binary_not_past", f"SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN disc - 0.05::DOUBLE < 0 THEN 0 ELSE 1 END AS not_past FROM {LINES}")
def binary_not_past(t: Tables):
    return t.lines.select("l_orderkey", "l_linenumber", "l_partkey", *E.columns({"not_past": E.not_past("disc - 0.05D")}))


@query("days_to_years", "SELECT o_orderkey, CAST(abs(trunc(date_diff('day', TIMESTAMP '2002-01-01', o_orderdate) / 365)) AS INTEGER) AS years FROM orders")
def days_to_years(t: Tables):
    days = "datediff(o_orderdate, DATE '2002-01-01')"
    return t.orders.select("o_orderkey", *E.columns({"years": E.days_to_years(days)}))


@query("join_left_single_key", "SELECT o_orderkey, o_custkey, c_mktsegment, c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def join_left_single_key(t: Tables):
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    return joins.left_join(t.orders.select("o_orderkey", "o_custkey"), c, "o_custkey")


@query(
    "join_left_multi_key",
    rounded_sql("""SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, m AS max_qty FROM lineitem LEFT JOIN
    (SELECT l_partkey AS p, l_suppkey AS s, max(l_quantity) AS m FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) ON l_partkey = p AND l_suppkey = s"""),
)
def join_left_multi_key(t: Tables):
    returned = t.lineitem.where("l_returnflag = 'R'").groupBy("l_partkey", "l_suppkey").agg(F.max("l_quantity").alias("max_qty"))
    return rounded(joins.left_join(t.lineitem.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber"), returned, ["l_partkey", "l_suppkey"]))


@query("join_inner", "SELECT user_id, event_id, c_mktsegment FROM events JOIN customer ON user_id = c_custkey")
def join_inner(t: Tables):
    c = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return joins.inner_join(t.events.select("user_id", "event_id"), c, "user_id")


@query(
    "lookup_map",
    "SELECT c_custkey, n_events FROM customer LEFT JOIN (SELECT user_id, count(*) AS n_events FROM events GROUP BY 1) ON user_id = c_custkey",
)
def lookup_map(t: Tables):
    counts = aggregate(t.events, "user_id", {"n": "count(event_id)"})
    return joins.lookup(t.customer.select("c_custkey"), counts, "c_custkey", "n", "n_events", table_key="user_id")


@query(
    "broadcast_back",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, flag, m AS max_dpd, n AS n_rows FROM {LINES} LEFT JOIN
    (SELECT flag AS f, max(dpd) AS m, count(*) AS n FROM {LINES} WHERE flag IS NOT NULL GROUP BY 1) ON flag = f""",
)
def broadcast_back(t: Tables):
    df = t.lines.select("l_orderkey", "l_linenumber", "l_partkey", "flag", "dpd")
    back = joins.broadcast_back(df, "flag", {"max_dpd": "max(dpd)", "n_rows": "count(1)"})
    return back.select("l_orderkey", "l_linenumber", "l_partkey", "flag", "max_dpd", "n_rows")


@query(
    "assemble_mart",
    rounded_sql(
        """SELECT c_custkey, c_acctbal, prev_n, prev_total, ev_n, ev_mean, ev_n / prev_n AS events_per_order, prev_total / nullif(c_acctbal, 0) AS total_to_balance
    FROM customer LEFT JOIN (SELECT o_custkey AS k1, count(*) AS prev_n, sum(o_totalprice) AS prev_total FROM orders GROUP BY 1) ON c_custkey = k1
    LEFT JOIN (SELECT user_id AS k2, count(*) AS ev_n, avg(value) AS ev_mean FROM events GROUP BY 1) ON c_custkey = k2""",
        6,
    ),
)
def mart(t: Tables):
    prev = aggregate(t.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", {"n": "count(1)", "total": "sum(o_totalprice)"})
    ev = aggregate(t.events.withColumnRenamed("user_id", "c_custkey"), "c_custkey", {"n": "count(1)", "mean": "avg(value)"})
    blocks = [E.prefixed(prev, "prev_", ["c_custkey"]), E.prefixed(ev, "ev_", ["c_custkey"])]
    wide = assemble_mart(t.customer.select("c_custkey", "c_acctbal"), blocks, "c_custkey")
    return rounded(E.with_exprs(wide, {"events_per_order": E.ratio("ev_n", "prev_n"), "total_to_balance": E.ratio("prev_total", "c_acctbal")}), 6)


@query("onehot", f"SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN flag = 'A' THEN 1 ELSE 0 END AS flag_A, CASE WHEN flag = 'R' THEN 1 ELSE 0 END AS flag_R FROM {LINES}")
def onehot(t: Tables):
    df = t.lines.select("l_orderkey", "l_linenumber", "l_partkey", "flag")
    return encode.onehot(df, encode.fit_vocabulary(df, ["flag"]))


@query("distinct_keys", "SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def distinct_keys(t: Tables):
    return profile.distinct_keys(t.lineitem, ["l_orderkey", "l_suppkey"])


@query("sort_multi", "SELECT o_custkey, o_orderstatus, o_totalprice, o_orderkey FROM orders ORDER BY o_custkey, o_orderstatus, o_totalprice DESC, o_orderkey")
def sort_multi(t: Tables):
    df = t.orders.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderkey")
    return ordered.sort_rows(df, "o_custkey", "o_orderstatus", "-o_totalprice", "o_orderkey")


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def top_n(t: Tables):
    return ordered.top_n(t.orders.select("o_orderkey", "o_totalprice"), 50, "o_totalprice", "o_orderkey")


@query(
    "isin_topk",
    """SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN
    (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 20)""",
)
def isin_topk(t: Tables):
    return ordered.in_top(t.orders, "o_custkey", 20).select("o_custkey", "o_orderkey")


@query(
    "union_rows",
    """SELECT s_suppkey AS id, 'supplier' AS kind, s_acctbal AS balance, NULL::VARCHAR AS segment FROM supplier
    UNION ALL SELECT c_custkey, 'customer', c_acctbal, c_mktsegment FROM customer""",
)
def union_rows(t: Tables):
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"))
    c = t.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return s.unionByName(c, allowMissingColumns=True)
