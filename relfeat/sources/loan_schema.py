"""Explicit schemas of the loan tables, so that reading a CSV needs no inference pass.

``application`` is one table for training and test rows: ``split`` tells them apart and ``TARGET`` is NULL in test.
"""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: column names of the source tables; the documents are numbered 2 to 21
DOCUMENTS = [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]
ENQUIRIES = [f"AMT_REQ_CREDIT_BUREAU_{p}" for p in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR")]
SCORES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
BUILDING = ["APARTMENTS_AVG", "BASEMENTAREA_AVG", "YEARS_BUILD_AVG", "ELEVATORS_AVG", "NONLIVINGAREA_AVG"]


def _schema(ints: list[str], doubles: list[str], strings: list[str]) -> T.StructType:
    kinds = [(ints, T.IntegerType()), (doubles, T.DoubleType()), (strings, T.StringType())]
    return T.StructType([T.StructField(c, kind) for names, kind in kinds for c in names])


# fixed values: building figures, published as average, mode and median
BUILDING_FIGURES = (
    "APARTMENTS BASEMENTAREA YEARS_BEGINEXPLUATATION YEARS_BUILD COMMONAREA ELEVATORS ENTRANCES FLOORSMAX FLOORSMIN LANDAREA "
    "LIVINGAPARTMENTS LIVINGAREA NONLIVINGAPARTMENTS NONLIVINGAREA"
).split()
BUILDING_REST = [c for kind in ("AVG", "MODE", "MEDI") for f in BUILDING_FIGURES if (c := f"{f}_{kind}") not in BUILDING]

# all published columns of each file; any other column of a file is read as text
APPLICATION = _schema(
    ["SK_ID_CURR", "TARGET", "CNT_CHILDREN", "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_ID_PUBLISH", "REG_CITY_NOT_WORK_CITY"]
    + DOCUMENTS,
    ["CNT_FAM_MEMBERS", "DAYS_REGISTRATION", "DAYS_LAST_PHONE_CHANGE", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY",
     "AMT_GOODS_PRICE", "OWN_CAR_AGE", "OBS_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE",
     "DEF_30_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE", "REGION_POPULATION_RELATIVE", "FLAG_MOBIL",
     "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL", "REGION_RATING_CLIENT",
     "REGION_RATING_CLIENT_W_CITY", "HOUR_APPR_PROCESS_START", "REG_REGION_NOT_LIVE_REGION",
     "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION", "REG_CITY_NOT_LIVE_CITY", "LIVE_CITY_NOT_WORK_CITY",
     "TOTALAREA_MODE"] + SCORES + ENQUIRIES + BUILDING + BUILDING_REST,
    ["split", "CODE_GENDER", "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE",
     "OCCUPATION_TYPE", "ORGANIZATION_TYPE", "FLAG_OWN_CAR", "FLAG_OWN_REALTY", "NAME_CONTRACT_TYPE", "NAME_TYPE_SUITE",
     "WEEKDAY_APPR_PROCESS_START", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE", "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE"],
)
BUREAU = _schema(
    ["SK_ID_CURR", "SK_ID_BUREAU", "DAYS_CREDIT", "CNT_CREDIT_PROLONG"],
    ["DAYS_CREDIT_ENDDATE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_OVERDUE", "CREDIT_DAY_OVERDUE",
     "DAYS_ENDDATE_FACT", "AMT_CREDIT_MAX_OVERDUE", "AMT_CREDIT_SUM_LIMIT", "DAYS_CREDIT_UPDATE", "AMT_ANNUITY"],
    ["CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE"],
)
BUREAU_BALANCE = _schema(["SK_ID_BUREAU", "MONTHS_BALANCE"], [], ["STATUS"])
PREVIOUS = _schema(
    ["SK_ID_PREV", "SK_ID_CURR", "DAYS_DECISION"],
    ["AMT_APPLICATION", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "NFLAG_INSURED_ON_APPROVAL",
     "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION", "AMT_DOWN_PAYMENT",
     "HOUR_APPR_PROCESS_START", "NFLAG_LAST_APPL_IN_DAY", "RATE_DOWN_PAYMENT", "RATE_INTEREST_PRIMARY",
     "RATE_INTEREST_PRIVILEGED", "SELLERPLACE_AREA", "CNT_PAYMENT"],
    ["NAME_CONTRACT_TYPE", "NAME_CONTRACT_STATUS", "NAME_PORTFOLIO", "NAME_YIELD_GROUP", "PRODUCT_COMBINATION",
     "CHANNEL_TYPE", "NAME_PRODUCT_TYPE", "NAME_CLIENT_TYPE", "WEEKDAY_APPR_PROCESS_START", "FLAG_LAST_APPL_PER_CONTRACT",
     "NAME_CASH_LOAN_PURPOSE", "NAME_PAYMENT_TYPE", "CODE_REJECT_REASON", "NAME_TYPE_SUITE", "NAME_GOODS_CATEGORY",
     "NAME_SELLER_INDUSTRY"],
)
POS = _schema(
    ["SK_ID_PREV", "SK_ID_CURR", "MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"],
    ["CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE"],
    ["NAME_CONTRACT_STATUS"],
)
CARD = _schema(
    ["SK_ID_PREV", "SK_ID_CURR", "MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF", "CNT_DRAWINGS_CURRENT"],
    ["AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_CURRENT",
     "AMT_DRAWINGS_OTHER_CURRENT", "AMT_DRAWINGS_POS_CURRENT", "CNT_DRAWINGS_ATM_CURRENT",
     "CNT_DRAWINGS_OTHER_CURRENT", "CNT_DRAWINGS_POS_CURRENT", "AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_CURRENT",
     "AMT_PAYMENT_TOTAL_CURRENT", "AMT_RECEIVABLE_PRINCIPAL", "AMT_RECIVABLE", "AMT_TOTAL_RECEIVABLE",
     "CNT_INSTALMENT_MATURE_CUM"],
    ["NAME_CONTRACT_STATUS"],
)
INSTALMENTS = _schema(
    ["SK_ID_PREV", "SK_ID_CURR", "NUM_INSTALMENT_NUMBER"],
    ["NUM_INSTALMENT_VERSION", "DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT"],
    [],
)
