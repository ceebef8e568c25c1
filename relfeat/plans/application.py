"""Features of the root table: imputation, ratios, recipes, flags, encodings.

Training and test rows travel together; ``split`` keeps their statistics apart where each is fitted on its own rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from relfeat.functions.expr import (
    days_to_years,
    flag,
    flag_all,
    overlapping_buckets,
    ratio,
    row_mean,
    row_missing_fraction,
    row_std,
    row_sum,
    safe_name,
    sentinel_to_null,
    trunc_int,
    with_exprs,
)
from relfeat.operators.encode import encode_labels
from relfeat.operators.grouping import Fitted, fit_recipes, group_deviation, group_recipe
from relfeat.operators.impute import GroupStats, fit_group, impute_group, lookup_group
from relfeat.session import in_parallel
from relfeat.sources.loan_schema import ENQUIRIES, SCORES
from relfeat.sources.tables import columns_by_pattern, columns_by_type

SPLIT = "split"
CAR_AGE = {"car_age_filled": "OWN_CAR_AGE"}

# fixed values: key lists with their (column, aggregate) pairs
RECIPES = [
    (["CODE_GENDER", "NAME_EDUCATION_TYPE"],
     [("AMT_ANNUITY", "max"), ("AMT_CREDIT", "max"), ("EXT_SOURCE_1", "mean"), ("EXT_SOURCE_2", "mean"),
      ("OWN_CAR_AGE", "max"), ("OWN_CAR_AGE", "sum")]),
    (["CODE_GENDER", "ORGANIZATION_TYPE"],
     [("AMT_ANNUITY", "mean"), ("AMT_INCOME_TOTAL", "mean"), ("DAYS_REGISTRATION", "mean"), ("EXT_SOURCE_1", "mean")]),
    (["CODE_GENDER", "REG_CITY_NOT_WORK_CITY"],
     [("AMT_ANNUITY", "mean"), ("CNT_CHILDREN", "mean"), ("DAYS_ID_PUBLISH", "mean")]),
    (["CODE_GENDER", "NAME_EDUCATION_TYPE", "OCCUPATION_TYPE", "REG_CITY_NOT_WORK_CITY"],
     [("EXT_SOURCE_1", "mean"), ("EXT_SOURCE_2", "mean")]),
    (["NAME_EDUCATION_TYPE", "OCCUPATION_TYPE"],
     [(c, "mean") for c in ("AMT_CREDIT", "AMT_REQ_CREDIT_BUREAU_YEAR", "APARTMENTS_AVG", "BASEMENTAREA_AVG",
                            "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "NONLIVINGAREA_AVG", "OWN_CAR_AGE",
                            "YEARS_BUILD_AVG")]),
    (["NAME_EDUCATION_TYPE", "OCCUPATION_TYPE", "REG_CITY_NOT_WORK_CITY"],
     [("ELEVATORS_AVG", "mean"), ("EXT_SOURCE_1", "mean")]),
    (["OCCUPATION_TYPE"],
     [(c, "mean") for c in ("AMT_ANNUITY", "CNT_CHILDREN", "CNT_FAM_MEMBERS", "DAYS_BIRTH", "DAYS_EMPLOYED",
                            "DAYS_ID_PUBLISH", "DAYS_REGISTRATION", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")]),
]

# fixed values: conjunctions of category values that become flags
MARRIAGE, HOUSING, WORK, JOB, SCHOOL = (
    "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE", "NAME_INCOME_TYPE", "OCCUPATION_TYPE", "NAME_EDUCATION_TYPE"
)
INTERACTIONS = [
    (MARRIAGE, "Married", JOB, "Low-skill Laborers"),
    (MARRIAGE, "Married", WORK, "Working"),
    (MARRIAGE, "Married", WORK, "Unemployed"),
    (MARRIAGE, "Married", HOUSING, "Rented apartment"),
    (MARRIAGE, "Married", HOUSING, "House / apartment"),
    (MARRIAGE, "Married", HOUSING, "With parents"),
    (MARRIAGE, "Civil marriage", HOUSING, "Rented apartment"),
    (MARRIAGE, "Civil marriage", HOUSING, "With parents"),
    (MARRIAGE, "Civil marriage", HOUSING, "House / apartment"),
    (WORK, "Unemployed", SCHOOL, "Secondary / secondary special"),
    (WORK, "Unemployed", SCHOOL, "Incomplete higher"),
    (WORK, "Working", SCHOOL, "Secondary / secondary special"),
    (JOB, "Low-skill Laborers", SCHOOL, "Incomplete higher"),
    (JOB, "Low-skill Laborers", SCHOOL, "Higher education"),
    (JOB, "Laborers", SCHOOL, "Lower secondary"),
    (JOB, "Laborers", SCHOOL, "Secondary / secondary special"),
    (JOB, "Drivers", SCHOOL, "Lower secondary"),
    (JOB, "Drivers", SCHOOL, "Secondary / secondary special"),
    (JOB, "Low-skill Laborers", MARRIAGE, "Civil marriage"),
    (JOB, "Low-skill Laborers", MARRIAGE, "Single / not married"),
]

# fixed values: document flags judged redundant once their sum is known, and columns that repeat others
REDUNDANT_COLUMNS = [
    "FLAG_DOCUMENT_2", "FLAG_DOCUMENT_4", "FLAG_DOCUMENT_7", "FLAG_DOCUMENT_10", "FLAG_DOCUMENT_12", "FLAG_DOCUMENT_14",
    "FLAG_DOCUMENT_15", "FLAG_DOCUMENT_17", "FLAG_DOCUMENT_19", "FLAG_DOCUMENT_20", "FLAG_DOCUMENT_21", "FLAG_MOBIL",
    "FLAG_CONT_MOBILE", "FLAG_EMAIL", "LIVINGAREA_AVG", "LIVINGAPARTMENTS_AVG", "ELEVATORS_AVG", "FLOORSMIN_AVG",
    "LIVINGAPARTMENTS_MODE", "APARTMENTS_MODE", "BASEMENTAREA_MODE", "ELEVATORS_MODE", "YEARS_BEGINEXPLUATATION_MODE",
    "YEARS_BUILD_MODE", "COMMONAREA_MODE", "ENTRANCES_MODE", "FLOORSMAX_MODE", "FLOORSMIN_MODE", "LANDAREA_MODE",
    "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE", "ELEVATORS_MEDI", "ENTRANCES_MEDI", "FLOORSMAX_MEDI", "FLOORSMIN_MEDI",
    "LANDAREA_MEDI", "LIVINGAPARTMENTS_MEDI", "LIVINGAREA_MEDI", "NONLIVINGAPARTMENTS_MEDI", "NONLIVINGAREA_MEDI",
    "HOUSETYPE_MODE", "APARTMENTS_MEDI", "BASEMENTAREA_MEDI", "YEARS_BEGINEXPLUATATION_MEDI", "YEARS_BUILD_MEDI",
    "COMMONAREA_MEDI",
]


def drop_redundant(app: DataFrame) -> DataFrame:
    """Drop the columns judged redundant; call it after the features that are computed from them."""
    return app.drop(*REDUNDANT_COLUMNS)


def interaction_name(a: str, x: str, b: str, y: str) -> str:
    return f"is_{safe_name(x)}_{safe_name(y)}".lower()


def interaction_flags(interactions=INTERACTIONS) -> dict[str, str]:
    return {interaction_name(a, x, b, y): flag_all({a: x, b: y}) for a, x, b, y in interactions}


def clean(app: DataFrame) -> DataFrame:
    return with_exprs(
        app,
        {
            "CODE_GENDER": sentinel_to_null("CODE_GENDER", "XNA"),
            "DAYS_LAST_PHONE_CHANGE": sentinel_to_null("DAYS_LAST_PHONE_CHANGE", 0),
            "DAYS_EMPLOYED": sentinel_to_null("DAYS_EMPLOYED", 365243),
        },
    )


@dataclass(frozen=True)
class Statistics:
    """What the application features look up in other rows, each fitted within its split."""

    recipes: Fitted
    scores: GroupStats
    annuity: GroupStats
    income_by_org: GroupStats
    car_age: GroupStats


def fit_statistics(app: DataFrame) -> Statistics:
    """All statistics of the cleaned source columns, computed side by side."""
    by_income, by_gender, by_org = [SPLIT, "NAME_INCOME_TYPE"], [SPLIT, "CODE_GENDER"], [SPLIT, "ORGANIZATION_TYPE"]
    return Statistics(
        *in_parallel(
            app.sparkSession,
            [
                lambda: fit_recipes(app, RECIPES, [SPLIT]),
                lambda: fit_group(app, by_income, SCORES, null_as_group=True),
                lambda: fit_group(app, by_gender, ["AMT_ANNUITY"], null_as_group=True),
                lambda: fit_group(app, by_org, ["AMT_INCOME_TOTAL"]),
                lambda: fit_group(with_exprs(app, CAR_AGE), by_gender, list(CAR_AGE), "mean"),
            ],
        )
    )


def impute(app: DataFrame, stats: Statistics) -> DataFrame:
    """Scores by income type, annuity by gender, each median within its split; then score 3 by its split mean."""
    app = impute_group(impute_group(app, stats.scores), stats.annuity)
    return impute_group(app, fit_group(app, SPLIT, ["EXT_SOURCE_3"], "mean"))


def row_features(app: DataFrame) -> DataFrame:
    """Everything that needs only the row itself, after imputation."""
    income_left = "AMT_ANNUITY + AMT_INCOME_TOTAL - AMT_GOODS_PRICE"
    app = with_exprs(
        app,
        {
            "EXT_12": "EXT_SOURCE_1 * EXT_SOURCE_2",
            "EXT_23": "EXT_SOURCE_2 * EXT_SOURCE_3",
            "EXT_31": "EXT_SOURCE_1 * EXT_SOURCE_3",
            "AVG_EXT": row_mean(SCORES),
            "NEW_SOURCES_PROD": " * ".join(SCORES),
            "NEW_SCORES_STD": row_std(SCORES),
            "external_sources_weighted": "EXT_SOURCE_1 * 2 + EXT_SOURCE_2 * 3 + EXT_SOURCE_3 * 4",
            "BIRTH_CREDIT": "AMT_CREDIT * DAYS_BIRTH",
            "BIRTH_ANNUITY": "AMT_ANNUITY * DAYS_BIRTH",
            "COST_INCOME": "AMT_INCOME_TOTAL - AMT_GOODS_PRICE",
            "Ratio_of_debt_credit": ratio(income_left, "AMT_CREDIT"),
            "Ratio_of_credit_employement": ratio("AMT_CREDIT", "DAYS_EMPLOYED"),
            "income_debt_ratio": ratio(income_left, "AMT_ANNUITY + AMT_INCOME_TOTAL"),
            "CreditEmployPdt": "AMT_CREDIT * DAYS_EMPLOYED",
            "DAYS_EMPLOYED_PERC": ratio("DAYS_EMPLOYED", "DAYS_BIRTH"),
            "DAYS_UNEMPLOYED": "DAYS_BIRTH - DAYS_EMPLOYED",
            "INCOME_CREDIT_PERC": ratio("AMT_INCOME_TOTAL", "AMT_CREDIT"),
            "INCOME_PER_PERSON": ratio("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
            "ANNUITY_INCOME_PERC": ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
            "ANN_CREDIT_RATIO": ratio("AMT_ANNUITY", "AMT_CREDIT"),
            "CHILD_RATIO": ratio("CNT_CHILDREN", "CNT_FAM_MEMBERS"),
            "CREDIT_GOODS_RATIO": ratio("AMT_CREDIT", "AMT_GOODS_PRICE"),
            "NEW_INC_PER_CHLD": ratio("AMT_INCOME_TOTAL", "1 + CNT_CHILDREN"),
            "NEW_CAR_TO_BIRTH_RATIO": ratio("OWN_CAR_AGE", "DAYS_BIRTH"),
            "NEW_CAR_TO_EMPLOY_RATIO": ratio("OWN_CAR_AGE", "DAYS_EMPLOYED"),
            "NEW_PHONE_TO_BIRTH_RATIO": ratio("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
            "NEW_PHONE_TO_EMPLOY_RATIO": ratio("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
            "NEW_CREDIT_TO_INCOME_RATIO": ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
            "long_employment": flag("DAYS_EMPLOYED < -2000"),
            "retirement_age": flag("DAYS_BIRTH < -14000"),
            "cnt_non_child": "CNT_FAM_MEMBERS - CNT_CHILDREN",
            "credit_per_person": ratio("AMT_CREDIT", "CNT_FAM_MEMBERS"),
            "credit_per_child": ratio("AMT_CREDIT", "1 + CNT_CHILDREN"),
            "AGE": days_to_years("DAYS_BIRTH"),
            "TOTAL_NO_ENQUIRY": " + ".join(ENQUIRIES),
            "TOT_SOC_OBS_DPD": "OBS_30_CNT_SOCIAL_CIRCLE + OBS_60_CNT_SOCIAL_CIRCLE",
            "TOT_SOC_DEF_DPD": "DEF_30_CNT_SOCIAL_CIRCLE + DEF_60_CNT_SOCIAL_CIRCLE",
            "ANNUITY_LENGTH": ratio("AMT_CREDIT", "AMT_ANNUITY"),
            "TOTAL_DOCS_SUBMITTED": row_sum(columns_by_pattern(app, "FLAG_DOCUMENT")),
            "owns_car": flag("FLAG_OWN_CAR = 'Y'"),
            "owns_realty": flag("FLAG_OWN_REALTY = 'Y'"),
            "RICH": flag_all({"FLAG_OWN_CAR": "Y", "FLAG_OWN_REALTY": "Y"}),
            "two_or_more_children": flag("CNT_CHILDREN >= 2"),
            "family_over_4": flag("CNT_FAM_MEMBERS > 4"),
            "is_civil_marriage_3_children": flag_all({MARRIAGE: "Civil marriage", "CNT_CHILDREN": (">=", 3)}),
            **interaction_flags(),
        },
    )
    names = ["AGE_0_25", "AGE_25_35", "AGE_35_50", "AGE_50_70"]
    ages = overlapping_buckets("AGE", [(None, 25), (25, 35), (35, 50), (50, 70)])
    return with_exprs(
        app,
        {
            "DAYS_UNEMPLOYED_PERC": "1 - DAYS_EMPLOYED_PERC",
            "child_to_non_child_ratio": ratio("CNT_CHILDREN", "cnt_non_child"),
            "income_per_non_child": ratio("AMT_INCOME_TOTAL", "cnt_non_child"),
            "credit_per_non_child": ratio("AMT_CREDIT", "cnt_non_child"),
            "CAR_AGE_RATIO": ratio("OWN_CAR_AGE", "AGE"),
            "ANNUITY_EMPLOYED_RATIO": ratio("ANNUITY_LENGTH", "DAYS_EMPLOYED"),
            **dict(zip(names, ages)),
        },
    )


def fitted_features(app: DataFrame, stats: Statistics) -> DataFrame:
    """Features that look at other rows: income by organisation, filled score spread, filled car age."""
    app = lookup_group(app, stats.income_by_org, "AMT_INCOME_TOTAL", "NEW_INC_BY_ORG")
    app = impute_group(app, fit_group(app, SPLIT, ["NEW_SCORES_STD"], "mean"))
    app = impute_group(with_exprs(app, CAR_AGE), stats.car_age)
    return with_exprs(app, {"Age45": flag(f"{trunc_int('car_age_filled + 23')} >= 45")})


def encode_strings(app: DataFrame, train: DataFrame) -> DataFrame:
    """Integer codes for every string column, fitted on the training rows."""
    return encode_labels(app, train, [c for c in columns_by_type(app, "string") if c != SPLIT])


def application_features(app: DataFrame, encode: bool = True, redundant: bool = True) -> DataFrame:
    """All application features; ``redundant=False`` leaves out the raw columns of ``REDUNDANT_COLUMNS`` at the end."""
    source = clean(app)
    stats = fit_statistics(source)
    features = [c for c in source.columns if c not in (SPLIT, "TARGET")]
    app = with_exprs(source, {"missing_percent": row_missing_fraction(features)})
    app = group_deviation(group_recipe(app, RECIPES, stats.recipes), RECIPES)
    app = fitted_features(row_features(impute(app, stats)), stats)
    app = encode_strings(app, source.where(f"{SPLIT} = 'train'")) if encode else app
    return app if redundant else drop_redundant(app)
