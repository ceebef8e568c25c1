from relfeat.plans.application import REDUNDANT_COLUMNS, drop_redundant


def test_redundant_columns_are_really_dropped(spark):
    df = spark.sql("SELECT 1 AS SK_ID_CURR, 0 AS FLAG_DOCUMENT_2, 0 AS FLAG_DOCUMENT_3")
    assert drop_redundant(df).columns == ["SK_ID_CURR", "FLAG_DOCUMENT_3"]
    assert len(set(REDUNDANT_COLUMNS)) == len(REDUNDANT_COLUMNS)
