"""Feature blocks: one per child table, each reduced to one row per customer and prefixed.

A block reads its table once: by customer, or, where it has loan statistics, by (customer, loan) with partial states that
are merged to the customer; recent rows, medians and vocabularies are further passes over the few columns they need. Ratios and differences of group sums are expressions over the
aggregates and never go back to the detail rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from relfeat.functions.aggs import (
    ROWS,
    Quantile,
    by_name,
    count_if,
    count_not_zero,
    percent_if,
    recency_weight,
    span,
    total,
    weighted_mean,
)
from relfeat.functions.expr import (
    columns,
    fill,
    flag_equals,
    not_past,
    prefixed,
    ratio,
    recode,
    sentinel_to_null,
    trunc_int,
    with_exprs,
)
from relfeat.operators.encode import Vocabulary, distinct_values, fit_vocabulary, share_columns, wide_columns, wide_share_rows
from relfeat.operators.grouping import Nested, aggregate
from relfeat.operators.joins import check_distinct_names, left_join
from relfeat.operators.ordered import last_group, last_k_columns, last_known, late_flags, recent_rows, trend_columns, unpacked
from relfeat.sources.tables import columns_by_type

CUSTOMER = "SK_ID_CURR"
LOAN = "SK_ID_PREV"
MONTH = "MONTHS_BALANCE"

# fixed values: severity of a monthly bureau status
SEVERITY = {"C": 0.0, "0": 0.1, "X": 0.0, "1": 600.0, "2": 725.0, "3": 800.0, "4": 900.0, "5": 1000.0}
# fixed value: stands for "no such day" in day columns
NO_DAY = 365243
# fixed values: history lengths of the recent-instalment features and of the trends
LAST_K = [1, 10, 50]
TREND_K = [1, 6, 12, 30, 60]


def _means(df: DataFrame, skip: Sequence[str]) -> dict[str, str]:
    return {c: f"avg({c})" for c in columns_by_type(df, "numeric") if c not in skip}


def _then(df: DataFrame, post: Mapping[str, str]) -> DataFrame:
    """Add expressions over the aggregates and drop the auxiliary ones."""
    return with_exprs(df, post).drop(*[c for c in df.columns if c.startswith("__")])


def bureau_loan_history(balance: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Monthly bureau statuses reduced to the loan: status shares, number of months, mean (weighted) severity."""
    # month 0 has no recency weight and is left out of both severities
    dated = f"CASE WHEN {MONTH} <> 0 THEN {recode('STATUS', SEVERITY)} END"
    shares = share_columns("STATUS", vocabulary.get("STATUS", []), "status")
    return aggregate(
        balance,
        "SK_ID_BUREAU",
        {
            "hist_MONTHS_BALANCE": f"avg({MONTH})",
            "hist_months": f"count({MONTH})",
            **{f"hist_{n}": a for n, a in shares.items()},
            "hist_SCORE": f"avg({dated})",
            "hist_W_SCORES": f"avg(try_divide(-({dated}), {MONTH}))",
        },
    )


def bureau_block(bureau: DataFrame, balance: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    strings = {"CREDIT_ACTIVE": "ca", "CREDIT_CURRENCY": "cu", "CREDIT_TYPE": "ty"}
    if vocabulary is None:
        vocabulary = {**fit_vocabulary(bureau, list(strings)), **fit_vocabulary(balance, ["STATUS"])}
    filled = {c: fill(c, 0) for c in ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "CNT_CREDIT_PROLONG")}
    loans = left_join(with_exprs(bureau, filled), bureau_loan_history(balance, vocabulary), "SK_ID_BUREAU")
    shares: dict[str, str] = {}
    for c, short in strings.items():
        shares.update(share_columns(c, vocabulary.get(c, []), short))
    features = aggregate(
        loans,
        CUSTOMER,
        {
            "loan_count": "count(SK_ID_BUREAU)",
            **_means(loans, [CUSTOMER, "SK_ID_BUREAU"]),
            **shares,
            # the gaps between consecutive credits of a customer add up to the span of their days
            "DAYS_DIFF": f"coalesce({span('DAYS_CREDIT')}, 0) / {ROWS}",
            "CREDIT_ENDDATE_PERCENTAGE": f"avg({not_past('DAYS_CREDIT_ENDDATE')})",
            "ACTIVE_LOANS_PERCENTAGE": "avg(CASE WHEN CREDIT_ACTIVE = 'Closed' THEN 0 ELSE 1 END)",
            "__debt": total("AMT_CREDIT_SUM_DEBT"),
            "__credit": total("AMT_CREDIT_SUM"),
            "__overdue": total("AMT_CREDIT_SUM_OVERDUE"),
            "__loans": "count(DAYS_CREDIT)",
            "__types": distinct_values("CREDIT_TYPE", vocabulary),
        },
    )
    features = _then(
        features,
        {
            "DEBT_CREDIT_RATIO": ratio("__debt", "__credit"),
            "OVERDUE_DEBT_RATIO": ratio("__overdue", "__debt"),
            "AVERAGE_LOAN_TYPE": ratio("__loans", "__types"),
        },
    )
    return prefixed(features, "bureau_", [CUSTOMER])


def previous_wide_shares(previous: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame | None:
    """(customer, column_name, value, n, share) of the text columns with too many values for ``previous_block``; None if
    there is no such column."""
    strings = columns_by_type(previous, "string")
    wide = wide_columns(strings, fit_vocabulary(previous, strings) if vocabulary is None else vocabulary)
    return wide_share_rows(previous, CUSTOMER, wide) if wide else None


def previous_block(previous: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    strings = columns_by_type(previous, "string")
    if vocabulary is None:
        vocabulary = fit_vocabulary(previous, strings)
    days = ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION"]
    rows = with_exprs(
        previous,
        {
            **{c: sentinel_to_null(c, NO_DAY) for c in days},
            "NFLAG_INSURED_ON_APPROVAL": fill("NFLAG_INSURED_ON_APPROVAL", 0),
            "IsXsell": flag_equals("NAME_PRODUCT_TYPE", "x-sell"),
            "IsRefreshed": flag_equals("NAME_CLIENT_TYPE", "Refreshed"),
        },
    )
    shares: dict[str, str] = {}
    for c in strings:
        shares.update(share_columns(c, vocabulary.get(c, [])))
    kinds = {
        "LOAN_TYPE": "NAME_CONTRACT_TYPE",
        "STATUSES": "NAME_CONTRACT_STATUS",
        "LOAN_FOR": "NAME_PORTFOLIO",
        "INT_GROUP": "NAME_YIELD_GROUP",
        "COMBINATION_COUNT": "PRODUCT_COMBINATION",
        "CHANNELS": "CHANNEL_TYPE",
    }
    spread = {}
    for name, c in {
        "AMT_APPL": "AMT_APPLICATION", "AMT_ANN": "AMT_ANNUITY", "AMT_CRE": "AMT_CREDIT", "AMT_PRICE": "AMT_GOODS_PRICE",
        "DAYS": "DAYS_DECISION", "DAYS_DUE": "DAYS_FIRST_DUE", "DAYS_LAST": "DAYS_LAST_DUE_1ST_VERSION",
        "DAYS_LAST_DUE": "DAYS_LAST_DUE", "TERMINATION": "DAYS_TERMINATION",
    }.items():
        spread[f"MAX_{name}"], spread[f"MIN_{name}"] = f"max({c})", f"min({c})"
    insured = "NFLAG_INSURED_ON_APPROVAL"
    features = aggregate(
        rows,
        CUSTOMER,
        {
            "loan_count": f"count({LOAN})",
            **_means(rows, [CUSTOMER, LOAN]),
            **shares,
            **spread,
            **{n: distinct_values(c, vocabulary) for n, c in kinds.items()},
            # the flag is 0 or 1, so its extremes tell how many values occur
            "INSURED": f"CASE WHEN max({insured}) > min({insured}) THEN 2 ELSE 1 END",
            "__credit": total("AMT_CREDIT"),
            "__applied": total("AMT_APPLICATION"),
            "__annuity": total("AMT_ANNUITY"),
            "__price": total("AMT_GOODS_PRICE"),
        },
    )
    features = _then(
        features,
        {
            "DIFF_CREDIT_APPLIED": "__credit - __applied",
            "DIFF_CREDIT_ANNUITY": "__credit - __annuity",
            "DEBT_INCOME_RATIO": ratio("__credit + __annuity - __price", "__credit + __annuity"),
            "RATIO_ANNUITY_CREDIT": ratio("__annuity", "__credit"),
            "RATIO_CREDIT_APPLIED": ratio("__applied", "__credit"),
            "CREDIT_ANNUITY_RATIO": ratio("__credit", "__annuity"),
            "CREDIT_GP_RATIO": ratio("__credit", "__price"),
        },
    )
    return prefixed(features, "prev_", [CUSTOMER])


def _extremes(named: Mapping[str, str]) -> dict[str, str]:
    return {f"{f.upper()}_{n}": f"{f}({c})" for n, c in named.items() for f in ("max", "min")}


def _recency_means(cs: Sequence[str]) -> dict[str, str]:
    return {f"WM_{c}": weighted_mean(c, recency_weight(MONTH)) for c in cs}


def pos_block(pos: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    status = "NAME_CONTRACT_STATUS"
    if vocabulary is None:
        vocabulary = fit_vocabulary(pos, [status])
    loans = Nested().beside(
        {
            "row_count": f"count({LOAN})",
            **_means(pos, [CUSTOMER, LOAN]),
            **share_columns(status, vocabulary.get(status, []), "status"),
            "RATIO_PAY_TOPAY": ratio(total("CNT_INSTALMENT"), total("CNT_INSTALMENT_FUTURE")),
            **_extremes({"BAL": MONTH, "CNT": "CNT_INSTALMENT", "CNT_FUT": "CNT_INSTALMENT_FUTURE"}),
            **_recency_means(["CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE", "SK_DPD", "SK_DPD_DEF"]),
        },
    )
    features = loans.of_groups("DPD_COUNT", count_not_zero("SK_DPD"), "avg({})").run(pos, CUSTOMER, LOAN)
    return prefixed(features, "pos_", [CUSTOMER])


def pos_history_block(pos: DataFrame, **options) -> DataFrame:
    """Recent-instalment, last-loan and trend features of the monthly snapshots."""
    late, late_tol = "paid_late", "paid_late_with_tolerance"
    rows = late_flags(pos, {late: "SK_DPD", late_tol: "SK_DPD_DEF"})
    numbers = ["sum", "mean", "max", "min", "median"]
    specs = {late: ["count", "mean"], late_tol: ["count", "mean"], "SK_DPD": numbers, "SK_DPD_DEF": numbers}
    recent = recent_rows(rows.select(CUSTOMER, MONTH, LOAN, *specs), CUSTOMER, MONTH, [LOAN], max(LAST_K + TREND_K))
    recent = recent.groupBy(CUSTOMER).agg(
        *columns({**last_k_columns(LAST_K, specs), **trend_columns(TREND_K, ["SK_DPD", "SK_DPD_DEF"])})
    )
    whole = {f"all_installment_{c}_{a}": by_name(a, c) for c, names in specs.items() for a in names}
    medians = {n: a for n, a in whole.items() if isinstance(a, Quantile)}
    spread = ["sum", "mean", "max", "min", "std"]
    loans = last_group(
        Nested(),
        LOAN,
        MONTH,
        [(late, a) for a in ("count", "sum", "mean")]
        + [(late_tol, a) for a in ("sum", "mean")]
        + [(c, a) for c in ("SK_DPD", "SK_DPD_DEF") for a in spread],
    )
    loans.beside(
        {
            "remaining_installments": last_known("CNT_INSTALMENT_FUTURE", MONTH, [LOAN]),
            "completed_contracts": count_if("NAME_CONTRACT_STATUS = 'Completed'"),
            **{n: a for n, a in whole.items() if n not in medians},
        }
    )
    features = unpacked(loans.run(rows, CUSTOMER, LOAN))
    features = features.join(aggregate(rows, CUSTOMER, medians, **options), CUSTOMER, "left").join(recent, CUSTOMER, "left")
    return prefixed(features, "pos_cash_", [CUSTOMER])


# fixed values: card columns with a recency-weighted mean, and those with a maximum and a minimum
CARD_WEIGHTED = [
    "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "SK_DPD", "SK_DPD_DEF", "AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_CURRENT",
    "AMT_DRAWINGS_OTHER_CURRENT", "AMT_DRAWINGS_POS_CURRENT", "AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_CURRENT",
    "AMT_PAYMENT_TOTAL_CURRENT", "AMT_RECEIVABLE_PRINCIPAL", "AMT_RECIVABLE", "AMT_TOTAL_RECEIVABLE",
    "CNT_INSTALMENT_MATURE_CUM",
]
CARD_SPREAD = {
    "BAL": "AMT_BALANCE", "LIM": "AMT_CREDIT_LIMIT_ACTUAL", "DRW": "AMT_DRAWINGS_ATM_CURRENT",
    "C_DRW": "AMT_DRAWINGS_CURRENT", "O_DRW": "AMT_DRAWINGS_OTHER_CURRENT", "P_DRW": "AMT_DRAWINGS_POS_CURRENT",
    "INST": "AMT_INST_MIN_REGULARITY", "PAYMENT": "AMT_PAYMENT_CURRENT", "PRIN": "AMT_RECEIVABLE_PRINCIPAL",
    "RECV": "AMT_RECIVABLE", "CNT_INSTL": "CNT_INSTALMENT_MATURE_CUM",
}
DRAWN_AMOUNTS = [f"AMT_DRAWINGS{part}_CURRENT" for part in ("_ATM", "", "_OTHER", "_POS")]
DRAWN_COUNTS = [f"CNT_DRAWINGS{part}_CURRENT" for part in ("_ATM", "", "_OTHER", "_POS")]


def card_block(card: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    status = "NAME_CONTRACT_STATUS"
    if vocabulary is None:
        vocabulary = fit_vocabulary(card, [status])
    amounts, counts = [total(c) for c in DRAWN_AMOUNTS], [total(c) for c in DRAWN_COUNTS]
    drawn, balance = "(" + " + ".join(amounts) + ")", total("AMT_BALANCE")
    loans = Nested().beside(
        {
            "row_count": f"count({LOAN})",
            **_means(card, [CUSTOMER, LOAN]),
            **share_columns(status, vocabulary.get(status, []), "status"),
            "PERCENTAGE_MISSED_PAYMENTS": percent_if("AMT_PAYMENT_CURRENT < AMT_INST_MIN_REGULARITY"),
            "CASH_CARD_RATIO": f"100 * {ratio(amounts[0], amounts[1])}",
            "DRAWINGS_RATIO": f"100 * {ratio(amounts[1], counts[1])}",
            "BALANCE_DRAWINGS_RATIO": ratio(balance, drawn),
            "BALANCE_DRAWINGS_DIFF": trunc_int(f"{balance} - {drawn}", "BIGINT"),
            "sum_drawings_cnt": f"CAST({' + '.join(counts)} AS DOUBLE)",
            "R_BAD_DEBTS": f"{total('AMT_TOTAL_RECEIVABLE')} - {total('AMT_RECEIVABLE_PRINCIPAL')}",
            **_extremes(CARD_SPREAD),
            **_recency_means(CARD_WEIGHTED),
        },
    )
    loans.group_count("__loans")
    loans.of_groups("__instalments", "max(CNT_INSTALMENT_MATURE_CUM)", "coalesce(sum({}), 0)")
    loans.of_groups("DPD_COUNT", count_not_zero("SK_DPD"), "avg({})")
    per_loan = {"INSTALLMENTS_PER_LOAN": trunc_int(ratio("__instalments", "__loans"))}
    return prefixed(_then(loans.run(card, CUSTOMER, LOAN), per_loan), "cc_bal_", [CUSTOMER])


# fixed values: the numbers of an instalment
INSTALMENT_NUMBERS = [
    "AMT_INSTALMENT", "AMT_PAYMENT", "DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT", "NUM_INSTALMENT_NUMBER",
    "NUM_INSTALMENT_VERSION",
]


def instalment_block(instalments: DataFrame) -> DataFrame:
    moments = {f"{a}_{c}": by_name(a, c) for c in INSTALMENT_NUMBERS for a in ("mean", "min", "max", "sum", "var")}
    features = aggregate(
        instalments,
        CUSTOMER,
        {
            "row_count": f"count({LOAN})",
            **moments,
            "mean_abs_DAYS_INSTALMENT": "avg(abs(DAYS_INSTALMENT))",
            "mean_abs_DAYS_ENTRY_PAYMENT": "avg(abs(DAYS_ENTRY_PAYMENT))",
            "__due_days": total("abs(DAYS_INSTALMENT)"),
            "__paid_days": total("abs(DAYS_ENTRY_PAYMENT)"),
        },
    )
    features = _then(
        features,
        {
            "DIFF_INSTALMENT_PAYMENT": "sum_AMT_INSTALMENT - sum_AMT_PAYMENT",
            "RATIO_INSTALMENT_PAYMENT": ratio("sum_AMT_PAYMENT", "sum_AMT_INSTALMENT"),
            # constant within the customer: its mean, maximum and minimum are the same number
            "DIFF_INSTALMENT_PAYMENT_DATE": "__paid_days - __due_days",
        },
    )
    return prefixed(features, "inst_", [CUSTOMER])


def assemble_mart(root: DataFrame, blocks: Sequence[DataFrame], key: str = CUSTOMER) -> DataFrame:
    """Root left-joined to its blocks, all with one row per key; two columns of one name are an error."""
    check_distinct_names([key] + [c for df in [root, *blocks] for c in df.columns if c != key])
    for block in blocks:
        root = root.join(block, key, "left")
    return root
