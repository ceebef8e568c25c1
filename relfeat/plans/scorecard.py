"""From loan tables to the mart and the cross-validated scorecard."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from relfeat.functions.expr import ratio, with_exprs
from relfeat.operators.encode import Vocabulary, fit_vocabulary
from relfeat.operators.model import CrossValidation, cross_validate
from relfeat.operators.slices import SLICE_BYTES, Block, by_slices, input_bytes, settled
from relfeat.plans.application import SPLIT, application_features
from relfeat.plans.blocks import (
    CUSTOMER,
    LOAN,
    assemble_mart,
    bureau_block,
    card_block,
    instalment_block,
    pos_block,
    pos_history_block,
    previous_block,
    previous_wide_shares,
)
from relfeat.session import in_parallel
from relfeat.sources import loan_schema
from relfeat.sources.tables import scan_table, write_feature_matrix, write_predictions

# fixed values: file names of the loan tables
FILES = {
    "bureau": ("bureau.csv", loan_schema.BUREAU),
    "bureau_balance": ("bureau_balance.csv", loan_schema.BUREAU_BALANCE),
    "previous": ("previous_application.csv", loan_schema.PREVIOUS),
    "pos": ("POS_CASH_balance.csv", loan_schema.POS),
    "card": ("credit_card_balance.csv", loan_schema.CARD),
    "instalments": ("installments_payments.csv", loan_schema.INSTALMENTS),
}


def read_loan_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The loan tables from headered CSV files, every column of the file included.

    Columns are matched by header name; of a file only the header is read before the job. The schemas list
    all published columns; any other is text.
    """

    def read(file: str, schema) -> DataFrame:
        kinds = {f.name: f.dataType for f in schema.fields}
        typed = type(schema)()
        for name in spark.read.option("header", True).csv(f"{folder}/{file}").columns:
            typed.add(name, kinds.get(name) or StringType())
        return scan_table(spark, f"{folder}/{file}", typed, "csv")

    tables = {name: read(file, schema) for name, (file, schema) in FILES.items()}
    train = read("application_train.csv", loan_schema.APPLICATION).withColumn(SPLIT, F.lit("train"))
    test = read("application_test.csv", loan_schema.APPLICATION).withColumn(SPLIT, F.lit("test"))
    tables["application"] = train.unionByName(test, allowMissingColumns=True)
    return tables


def feature_mart(tables: Mapping[str, DataFrame], history: bool = True) -> DataFrame:
    """One wide row per customer: application features and every child block, plus the ratios across blocks.

    The blocks are computed and stored one after the other, so that the disk holds the temporary files of one at a time; those
    of small tables side by side. The application rows are dealt by customer while they are narrow: their features meet the
    blocks without another shuffle.
    """
    spark = tables["application"].sparkSession

    def statuses(rows: DataFrame) -> Vocabulary:
        return fit_vocabulary(rows, ["NAME_CONTRACT_STATUS"])

    def sliced(name: str, fit: Callable[[DataFrame], list[Block]]) -> Callable[[], list[DataFrame]]:
        return lambda: by_slices(tables[name], CUSTOMER, LOAN, fit)

    late = [pos_history_block] if history else []
    # the widest first, while least is stored
    steps = [
        sliced("card", lambda rows: [partial(card_block, vocabulary=statuses(rows))]),
        sliced("instalments", lambda rows: [instalment_block]),
        sliced("previous", lambda rows: [partial(previous_block, vocabulary=fit_vocabulary(rows))]),
        sliced("pos", lambda rows: [partial(pos_block, vocabulary=statuses(rows)), *late]),
        lambda: [settled(spark, lambda: bureau_block(tables["bureau"], tables["bureau_balance"]))],
    ]

    def children() -> list[DataFrame]:
        small = sum(input_bytes(df) for name, df in tables.items() if name != "application") <= SLICE_BYTES
        [card], [instalments], [previous], [pos, *rest], [bureau] = in_parallel(spark, steps, len(steps) if small else 1)
        return [bureau, previous, pos, card, instalments, *rest]

    root, blocks = in_parallel(spark, [lambda: application_features(tables["application"].repartition(CUSTOMER)), children])
    mart = assemble_mart(root, blocks)
    return with_exprs(
        mart,
        {
            "cc_bal_INCOME_RATIO": ratio("cc_bal_AMT_BALANCE", "AMT_INCOME_TOTAL"),
            "cc_payment_INCOME_RATIO": ratio("cc_bal_AMT_DRAWINGS_ATM_CURRENT", "AMT_INCOME_TOTAL"),
        },
    )


def model_features(mart: DataFrame) -> list[str]:
    return [c for c in mart.columns if c not in (CUSTOMER, "TARGET", SPLIT)]


def train_scorecard(mart: DataFrame, **options) -> CrossValidation:
    train = mart.where(f"{SPLIT} = 'train'")
    return cross_validate(train, CUSTOMER, "TARGET", model_features(mart), **options)


def run(spark: SparkSession, folder: str, out: str, **options) -> CrossValidation:
    """Read CSV tables, write the feature matrix, fit the models, write the test predictions.

    Text columns of earlier applications with too many values for columns of the matrix go to ``wide_shares`` beside it,
    as rows to be joined by customer.
    """
    tables = read_loan_tables(spark, folder)
    write_feature_matrix(feature_mart(tables), f"{out}/matrix", SPLIT)
    wide = previous_wide_shares(tables["previous"])
    if wide is not None:
        write_feature_matrix(wide, f"{out}/wide_shares")
    mart = scan_table(spark, f"{out}/matrix")
    result = train_scorecard(mart, **options)
    test = mart.where(f"{SPLIT} = 'test'")
    write_predictions(result.score_average(test).withColumnRenamed("score", "TARGET"), CUSTOMER, "TARGET", f"{out}/predictions")
    return result
