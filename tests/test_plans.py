"""The loan catalogue end to end, plan shapes, and a sample of the queries against their SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from relfeat.driver.loan_views import loan_table, loan_tables
from relfeat.driver.registry import ORACLES, QUERIES, Tables
from relfeat.plans import blocks, scorecard
from relfeat.plans.application import INTERACTIONS, interaction_flags

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_name_and_most_have_sql():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(queries)


def test_flagship(spark):
    assert entry.entry(spark).count() == spark.read.parquet(f"{FOLDER}/customer.parquet").count()


@pytest.mark.parametrize("name", ["customer_order_mart", "agg_two_level", "last_k_aggregate", "auc_by_fold", "block_card"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "labels", "documents", "nation", "region", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = entry.queries()[name](spark, FOLDER)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted(repr(tuple(dict(zip(names, r))[c] for c in order)) for r in cur.fetchall())
    assert sorted(repr(tuple(r[c] for c in order)) for r in df.collect()) == want


def test_fused_block_shuffles_once_and_stays_in_the_jvm(spark):
    rows = spark.createDataFrame([(1, 1, 1, 1.0, -1.0, -2.0, 5.0, 4.0)], "SK_ID_PREV int, SK_ID_CURR int, NUM_INSTALMENT_NUMBER int, NUM_INSTALMENT_VERSION double, DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double")
    plan = plan_of(blocks.instalment_block(rows))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan.replace("PythonRDD", "")


def test_blocks_with_loan_statistics_read_their_table_once(spark, tmp_path):
    """One relation for the block of snapshots; the history reads twice, once for the recent rows. Medians were stored."""
    t = Tables(spark, FOLDER)
    for name in ("pos", "card"):
        loan_table(t, name).write.parquet(str(tmp_path / name))
    pos, card = (spark.read.parquet(str(tmp_path / name)) for name in ("pos", "card"))
    status = {"NAME_CONTRACT_STATUS": ["Active", "Completed"]}
    relations = {
        "pos": blocks.pos_block(pos, status), "card": blocks.card_block(card, status), "history": blocks.pos_history_block(pos),
    }
    counts = {n: df._jdf.queryExecution().optimizedPlan().toString().count(str(tmp_path)) for n, df in relations.items()}
    scans = {n: plan_of(df).count(f"Location: InMemoryFileIndex(1 paths)[file:{tmp_path}") for n, df in relations.items()}
    assert scans == {"pos": 1, "card": 1, "history": 2}, (scans, counts)
    assert "Python" not in plan_of(relations["pos"])


def test_scan_reads_only_the_needed_columns(spark):
    df = entry.queries()["agg_bool_sum"](spark, FOLDER)
    schemas = [line for line in plan_of(df).splitlines() if "ReadSchema" in line]
    assert len(schemas) == 2
    assert all(line.split("ReadSchema:")[1].count(":") <= 2 for line in schemas)


def test_customer_without_children_stays(spark):
    t = Tables(spark, FOLDER)
    mart = blocks.assemble_mart(
        loan_table(t, "application").select("SK_ID_CURR"), [blocks.bureau_block(loan_table(t, "bureau"), loan_table(t, "bureau_balance"))]
    )
    assert mart.count() == t.customer.count()
    assert mart.where("bureau_loan_count IS NULL").count() > 0


def test_assembly_refuses_clashing_names(spark):
    root = spark.sql("SELECT 1 AS SK_ID_CURR, 2 AS x")
    with pytest.raises(ValueError):
        blocks.assemble_mart(root, [spark.sql("SELECT 1 AS SK_ID_CURR, 3 AS X")])


def test_interactions_have_distinct_names():
    assert len(interaction_flags()) == len(INTERACTIONS)


def test_csv_to_predictions(spark, tmp_path):
    """The whole run on CSV copies of the loan tables: matrix written, models fitted, every test row scored."""
    tables = loan_tables(Tables(spark, FOLDER))
    app = tables.pop("application")
    names = {k: f for k, (f, _) in scorecard.FILES.items()}
    for name, df in tables.items():
        df.write.option("header", True).csv(str(tmp_path / names[name]))
    app.where("split = 'train'").drop("split").write.option("header", True).csv(str(tmp_path / "application_train.csv"))
    app.where("split = 'test'").drop("split", "TARGET").write.option("header", True).csv(str(tmp_path / "application_test.csv"))
    scorecard.run(spark, str(tmp_path), str(tmp_path / "out"), k=2, max_iter=1, max_depth=2)
    scores = spark.read.option("header", True).csv(str(tmp_path / "out" / "predictions"))
    assert scores.columns == ["SK_ID_CURR", "TARGET"]
    assert scores.count() == app.where("split = 'test'").count()
    matrix = spark.read.parquet(str(tmp_path / "out" / "matrix"))
    assert matrix.count() == app.count() and len(matrix.columns) > 500


def test_csv_types_of_published_and_unknown_columns(spark, tmp_path):
    headers = {f: "SK_ID_CURR,SK_ID_PREV" for f, _ in scorecard.FILES.values()}
    headers["bureau.csv"] = "SK_ID_CURR,SK_ID_BUREAU,DAYS_CREDIT,CREDIT_DAY_OVERDUE,AMT_CREDIT_SUM_LIMIT,CREDIT_TYPE,DAYS_NOBODY_KNOWS\n1,1,-5,10,1.5,x,a\n1,2,-6,20,,y,b"
    for kind in ("train", "test"):
        headers[f"application_{kind}.csv"] = "SK_ID_CURR,FLOORSMIN_MEDI,FONDKAPREMONT_MODE\n1,0.5,z"
    for file, text in headers.items():
        (tmp_path / file).write_text(text + "\n")
    tables = scorecard.read_loan_tables(spark, str(tmp_path))
    kinds = dict(tables["bureau"].dtypes)
    assert kinds["CREDIT_DAY_OVERDUE"] == kinds["AMT_CREDIT_SUM_LIMIT"] == "double"
    assert kinds["DAYS_NOBODY_KNOWS"] == kinds["CREDIT_TYPE"] == "string"
    assert tables["bureau"].agg({"CREDIT_DAY_OVERDUE": "avg"}).first()[0] == 15.0
    assert {("FLOORSMIN_MEDI", "double"), ("FONDKAPREMONT_MODE", "string")} <= set(tables["application"].dtypes)
