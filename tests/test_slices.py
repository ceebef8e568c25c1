"""Blocks computed slice by slice: whole results, and nothing temporary left on disk."""

import os
import time

from relfeat.driver.loan_views import loan_table, loan_tables
from relfeat.driver.registry import Tables
from relfeat.functions.aggs import by_name
from relfeat.operators.grouping import aggregate
from relfeat.operators.slices import by_slices, dealt, input_bytes, settled
from relfeat.plans import blocks
from relfeat.plans.scorecard import feature_mart
from relfeat.session import shared_dir, shuffles_freed

FOLDER = "/root/testdata/sf0.001"
AGGS = {"n": "count(1)", "total": "sum(v)", "middle": by_name("median", "v"), "loans": by_name("nunique", "loan")}


def rows_of(spark, n=3000):
    """A third of the rows has one key, some have none, and some come twice."""
    key = "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 17 = 0 THEN NULL ELSE id % 50 END"
    rows = spark.range(n).selectExpr(f"CAST({key} AS BIGINT) AS k", "id % 91 AS loan", "CAST(id % 13 AS DOUBLE) AS v")
    return rows.unionByName(rows.where("v = 5"))


def listed(df):
    return sorted(map(repr, df.collect()))


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def left_of(spark, before):
    """Shuffle files that are there for longer than their deletion takes."""
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def test_slices_give_whole_results_and_leave_only_them(spark):
    rows = rows_of(spark)
    want = listed(aggregate(rows, "k", AGGS))
    folder = shared_dir(spark)
    tables, files = set(os.listdir(folder)), shuffle_files(spark)
    for limit in (1, None):
        first, second = by_slices(rows, "k", "loan", lambda whole: [lambda r: aggregate(r, "k", AGGS)] * 2, limit)
        new = set(os.listdir(folder)) - tables
        assert len(new) == 1 and min(new).startswith("blocks-"), new
        assert not left_of(spark, files)
        assert listed(first) == listed(second) == want
        tables |= new
        files = shuffle_files(spark)


def test_a_slice_has_whole_keys_and_no_row_is_lost(spark):
    rows = rows_of(spark)
    whole, frames = dealt(rows, "k", 1)
    assert len(frames) > 4 and whole.columns == rows.columns
    assert listed(whole) == listed(rows) == sorted(x for f in frames for x in listed(f))
    keys = [{r.k for r in f.select("k").distinct().collect()} for f in frames]
    assert sum(map(len, keys)) == len(set.union(*keys))
    assert len(dealt(rows, "k")[1]) == 1


def test_no_rows(spark):
    rows = rows_of(spark).where("v < 0")
    [result] = by_slices(rows, "k", "loan", lambda whole: [lambda r: aggregate(r, "k", AGGS)])
    assert result.columns == ["k", *AGGS] and result.count() == 0


def test_setting_for_shuffle_files_returns(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with shuffles_freed(spark), shuffles_freed(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before


def test_settled_is_read_from_its_table(spark):
    result = settled(spark, lambda: aggregate(rows_of(spark), "k", AGGS))
    assert "Exchange" not in result._jdf.queryExecution().executedPlan().toString()
    assert listed(result) == listed(aggregate(rows_of(spark), "k", AGGS))


def test_states_of_a_customer_meet_before_the_shuffle_of_wide_rows(spark, tmp_path):
    """Rows cut by range of customer and loan: both levels follow in the same stage, one wide exchange is left."""
    loan_table(Tables(spark, FOLDER), "card").write.parquet(str(tmp_path / "card"))
    card = spark.read.parquet(str(tmp_path / "card")).repartitionByRange("SK_ID_CURR", "SK_ID_PREV")
    plan = blocks.card_block(card, {"NAME_CONTRACT_STATUS": ["Active"]})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == plan.count("Exchange hashpartitioning") == 1


def test_mart_joins_stored_blocks(spark):
    """What the mart leaves to its reader is the application rows and one exchange per stored block."""
    files = shuffle_files(spark)
    mart = feature_mart(loan_tables(Tables(spark, FOLDER)))
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "orders" not in plan and "events" not in plan
    assert plan.count("Exchange hashpartitioning") <= 7
    assert not left_of(spark, files)


def test_size_of_what_a_plan_reads(spark):
    t = Tables(spark, FOLDER)
    files = [os.path.getsize(f"{FOLDER}/{n}.parquet") for n in ("lineitem", "orders")]
    assert input_bytes(t.orders) == files[1] and input_bytes(loan_table(t, "card")) == sum(files)
