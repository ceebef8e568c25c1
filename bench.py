"""Time the headline queries: one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores. With BENCH_NAIVE=1 the card block is
also timed the way a notebook computes it: one aggregate and one join back per feature.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from relfeat.driver import load
from relfeat.driver.loan_views import loan_table
from relfeat.driver.registry import QUERIES, Tables
from relfeat.operators.model import forget_models
from relfeat.plans.blocks import CARD_SPREAD, CUSTOMER
from relfeat.session import build_session

HEADLINE = [
    "customer_order_mart", "agg_all_numeric_mean", "agg_median", "agg_median_by_flag", "agg_nunique", "agg_two_level",
    "weighted_mean_recency", "broadcast_back", "group_deviation", "lag_diff", "last_k_aggregate", "last_group_aggregate",
    "trend_slope", "impute_group_median", "correlation_matrix", "auc_by_fold", "block_bureau", "block_previous",
    "block_pos", "block_pos_history", "block_card", "block_instalments", "block_application", "feature_mart",
    "train_gbt_cv",
]


def timed(run) -> float:
    start = time.time()
    run().write.format("noop").mode("overwrite").save()
    return round(time.time() - start, 3)


def naive_card(t: Tables):
    """The card extremes and means with one aggregate joined back per feature, then a mean of everything."""
    rows = df = loan_table(t, "card")
    for name, c in CARD_SPREAD.items():
        for f, label in ((F.max, "MAX"), (F.min, "MIN")):
            df = df.join(rows.groupBy(CUSTOMER).agg(f(c).alias(f"{label}_{name}")), CUSTOMER, "left")
    numeric = [c for c in df.columns if c not in (CUSTOMER, "NAME_CONTRACT_STATUS")]
    return df.groupBy(CUSTOMER).agg(*[F.avg(c).alias(c) for c in numeric])


def fused_card(t: Tables):
    from relfeat.operators.grouping import aggregate

    df = loan_table(t, "card")
    spread = {f"{f.upper()}_{n}": f"{f}({c})" for n, c in CARD_SPREAD.items() for f in ("max", "min")}
    means = {c: f"avg({c})" for c in df.columns if c not in (CUSTOMER, "NAME_CONTRACT_STATUS")}
    return aggregate(df, CUSTOMER, {**spread, **means})


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "bench", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    load()
    timed(lambda: QUERIES["agg_mean"](spark, folder))
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            forget_models(spark)  # so that a fit is timed, not the reading of saved models
            runs.append(timed(lambda: QUERIES[name](spark, folder)))
        seconds[name] = min(runs)
    report = {
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_NAIVE"):
        t = Tables(spark, folder)
        report["comparison"] = {"card_fused": timed(lambda: fused_card(t)), "card_naive": timed(lambda: naive_card(t))}
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
