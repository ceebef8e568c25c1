"""The flagship mart and the feature blocks of the loan catalogue on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from relfeat.driver.loan_views import loan_sql, loan_table, loan_tables
from relfeat.driver.registry import Tables, query, rounded, rounded_sql
from relfeat.functions.aggs import total
from relfeat.functions.expr import prefixed, ratio, safe_name, with_exprs
from relfeat.operators.encode import fit_vocabulary, share_columns
from relfeat.operators.grouping import aggregate
from relfeat.plans import application, blocks
from relfeat.plans.scorecard import feature_mart
from relfeat.sources.loan_schema import BUILDING, DOCUMENTS, ENQUIRIES, SCORES

D = "::DOUBLE"


def _share(column: str, value: str, name: str) -> str:
    return f"avg(CASE WHEN {column} = '{value}' THEN 1.0{D} ELSE 0 END) AS {name}"


@query(
    "customer_order_mart",
    rounded_sql(
        f"""SELECT c_custkey, c_acctbal, c_mktsegment, n AS prev_n, total AS prev_total, mean AS prev_mean, f AS prev_o_orderstatus_F, o AS prev_o_orderstatus_O,
    p AS prev_o_orderstatus_P, total / nullif(c_acctbal, 0) AS total_to_balance FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS total,
    avg(o_totalprice) AS mean, {_share('o_orderstatus', 'F', 'f')}, {_share('o_orderstatus', 'O', 'o')}, {_share('o_orderstatus', 'P', 'p')} FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
        6,
        ["c_mktsegment"],
    ),
)
def customer_order_mart(t: Tables):
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    status = fit_vocabulary(orders, ["o_orderstatus"])["o_orderstatus"]
    block = aggregate(
        orders,
        "c_custkey",
        {"n": "count(1)", "total": total("o_totalprice"), "mean": "avg(o_totalprice)", **share_columns("o_orderstatus", status)},
    )
    root = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    mart = blocks.assemble_mart(root, [prefixed(block, "prev_", ["c_custkey"])], "c_custkey")
    return rounded(with_exprs(mart, {"total_to_balance": ratio("prev_total", "c_acctbal")}), 6)


# --- bureau --------------------------------------------------------------------------------------------------------

_SCORE = "CASE STATUS WHEN 'C' THEN 0.0{d} WHEN '0' THEN 0.1{d} WHEN 'X' THEN 0.0{d} WHEN '1' THEN 600.0{d} WHEN '2' THEN 725.0{d} WHEN '3' THEN 800.0{d} WHEN '4' THEN 900.0{d} WHEN '5' THEN 1000.0{d} END".format(d=D)
_STATUS = ["0", "1", "5", "C", "X"]
_HIST = f"""(SELECT SK_ID_BUREAU AS hk, avg(MONTHS_BALANCE) AS hist_MONTHS_BALANCE, count(MONTHS_BALANCE) AS hist_months,
  {', '.join(_share('STATUS', v, f'hist_status_{v}') for v in _STATUS)},
  avg({_SCORE}) FILTER (WHERE MONTHS_BALANCE <> 0) AS hist_SCORE, avg(-({_SCORE}) / nullif(MONTHS_BALANCE, 0)) AS hist_W_SCORES
  FROM {loan_sql('bureau_balance')} GROUP BY 1)"""
_BUREAU_NUM = ["DAYS_CREDIT", "CNT_CREDIT_PROLONG", "DAYS_CREDIT_ENDDATE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_OVERDUE",
               "hist_MONTHS_BALANCE", "hist_months", *[f"hist_status_{v}" for v in _STATUS], "hist_SCORE", "hist_W_SCORES"]
_BUREAU_SHARES = (
    [_share("CREDIT_ACTIVE", v, f"bureau_ca_{v}") for v in ("Active", "Closed", "Sold")]
    + [_share("CREDIT_CURRENCY", f"currency {i}", f"bureau_cu_currency_{i}") for i in (1, 2)]
    + [_share("CREDIT_TYPE", v, f"bureau_ty_{v}") for v in ("click", "error", "purchase", "signup", "view")]
)
_BUREAU_SQL = f"""SELECT SK_ID_CURR, count(SK_ID_BUREAU) AS bureau_loan_count, {', '.join(f'avg({c}) AS bureau_{c}' for c in _BUREAU_NUM)}, {', '.join(_BUREAU_SHARES)},
  coalesce(max(DAYS_CREDIT) - min(DAYS_CREDIT), 0) / count(*) AS bureau_DAYS_DIFF, avg(CASE WHEN DAYS_CREDIT_ENDDATE < 0 THEN 0 ELSE 1 END) AS bureau_CREDIT_ENDDATE_PERCENTAGE,
  avg(CASE WHEN CREDIT_ACTIVE = 'Closed' THEN 0 ELSE 1 END) AS bureau_ACTIVE_LOANS_PERCENTAGE, sum(AMT_CREDIT_SUM_DEBT) / nullif(sum(AMT_CREDIT_SUM), 0) AS bureau_DEBT_CREDIT_RATIO,
  sum(AMT_CREDIT_SUM_OVERDUE) / nullif(sum(AMT_CREDIT_SUM_DEBT), 0) AS bureau_OVERDUE_DEBT_RATIO, count(DAYS_CREDIT) / nullif(count(DISTINCT CREDIT_TYPE), 0) AS bureau_AVERAGE_LOAN_TYPE
  FROM (SELECT * REPLACE (coalesce(CNT_CREDIT_PROLONG, 0) AS CNT_CREDIT_PROLONG, coalesce(AMT_CREDIT_SUM, 0) AS AMT_CREDIT_SUM, coalesce(AMT_CREDIT_SUM_DEBT, 0) AS AMT_CREDIT_SUM_DEBT)
  FROM {loan_sql('bureau')} LEFT JOIN {_HIST} ON SK_ID_BUREAU = hk) GROUP BY 1"""


@query("block_bureau", rounded_sql(_BUREAU_SQL, 8))
def block_bureau(t: Tables):
    return rounded(blocks.bureau_block(loan_table(t, "bureau"), loan_table(t, "bureau_balance")), 8)


@query(
    "block_bureau_gaps",
    rounded_sql(f"""SELECT SK_ID_CURR, avg(gap) AS mean_gap FROM (SELECT SK_ID_CURR, coalesce(lag(DAYS_CREDIT) OVER
    (PARTITION BY SK_ID_CURR ORDER BY DAYS_CREDIT DESC NULLS LAST, SK_ID_BUREAU) - DAYS_CREDIT, 0) AS gap FROM {loan_sql('bureau')}) GROUP BY 1"""),
)
def block_bureau_gaps(t: Tables):
    """The block reads the mean gap off the span of the days; here it is the mean of the gaps themselves."""
    block = blocks.bureau_block(loan_table(t, "bureau"), loan_table(t, "bureau_balance"))
    return rounded(block.select("SK_ID_CURR", F.col("bureau_DAYS_DIFF").alias("mean_gap")))


# --- previous applications -----------------------------------------------------------------------------------------

_PREV_WORDS = {
    "NAME_CONTRACT_TYPE": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "NAME_CONTRACT_STATUS": ["Approved", "Refused", "Unused offer"],
    "NAME_PORTFOLIO": ["Cash", "POS"],
    "NAME_YIELD_GROUP": ["high", "low_normal", "middle"],
    "PRODUCT_COMBINATION": ["Card Street", "Cash X-Sell: low", "POS mobile with interest"],
    "CHANNEL_TYPE": ["Country-wide", "Stone"],
    "NAME_PRODUCT_TYPE": ["walk-in", "x-sell"],
    "NAME_CLIENT_TYPE": ["Refreshed", "Repeater"],
}
_PREV_DAYS = ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION"]
_PREV_NUM = ["DAYS_DECISION", "AMT_APPLICATION", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "NFLAG_INSURED_ON_APPROVAL", *_PREV_DAYS]
_PREV_SPREAD = {"AMT_APPL": "AMT_APPLICATION", "AMT_ANN": "AMT_ANNUITY", "AMT_CRE": "AMT_CREDIT", "AMT_PRICE": "AMT_GOODS_PRICE", "DAYS": "DAYS_DECISION",
                "DAYS_DUE": "DAYS_FIRST_DUE", "DAYS_LAST": "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE": "DAYS_LAST_DUE", "TERMINATION": "DAYS_TERMINATION"}
_PREV_KINDS = {"LOAN_TYPE": "NAME_CONTRACT_TYPE", "STATUSES": "NAME_CONTRACT_STATUS", "LOAN_FOR": "NAME_PORTFOLIO", "INT_GROUP": "NAME_YIELD_GROUP",
               "COMBINATION_COUNT": "PRODUCT_COMBINATION", "CHANNELS": "CHANNEL_TYPE", "INSURED": "NFLAG_INSURED_ON_APPROVAL"}
_CRE, _APP, _ANN, _PRI = (f"coalesce(sum({c}), 0)" for c in ("AMT_CREDIT", "AMT_APPLICATION", "AMT_ANNUITY", "AMT_GOODS_PRICE"))
_PREV_SQL = f"""SELECT SK_ID_CURR, count(SK_ID_PREV) AS prev_loan_count, {', '.join(f'avg({c}) AS prev_{c}' for c in _PREV_NUM)},
  {', '.join(_share(c, v, f'prev_{c}_{safe_name(v)}') for c, values in _PREV_WORDS.items() for v in values)},
  {', '.join(f'max({c}) AS prev_MAX_{n}, min({c}) AS prev_MIN_{n}' for n, c in _PREV_SPREAD.items())},
  {', '.join(f'count(DISTINCT {c}) AS prev_{n}' for n, c in _PREV_KINDS.items())},
  avg(CASE WHEN NAME_PRODUCT_TYPE = 'x-sell' THEN 1 ELSE 0 END) AS prev_IsXsell, avg(CASE WHEN NAME_CLIENT_TYPE = 'Refreshed' THEN 1 ELSE 0 END) AS prev_IsRefreshed,
  {_CRE} - {_APP} AS prev_DIFF_CREDIT_APPLIED, {_CRE} - {_ANN} AS prev_DIFF_CREDIT_ANNUITY, ({_CRE} + {_ANN} - {_PRI}) / nullif({_CRE} + {_ANN}, 0) AS prev_DEBT_INCOME_RATIO,
  {_ANN} / nullif({_CRE}, 0) AS prev_RATIO_ANNUITY_CREDIT, {_APP} / nullif({_CRE}, 0) AS prev_RATIO_CREDIT_APPLIED, {_CRE} / nullif({_ANN}, 0) AS prev_CREDIT_ANNUITY_RATIO,
  {_CRE} / nullif({_PRI}, 0) AS prev_CREDIT_GP_RATIO FROM (SELECT * REPLACE (coalesce(NFLAG_INSURED_ON_APPROVAL, 0) AS NFLAG_INSURED_ON_APPROVAL,
  {', '.join(f'nullif({c}, 365243) AS {c}' for c in _PREV_DAYS)}) FROM {loan_sql('previous')}) GROUP BY 1"""


@query("block_previous", rounded_sql(_PREV_SQL, 8))
def block_previous(t: Tables):
    return rounded(blocks.previous_block(loan_table(t, "previous")), 8)


# --- monthly snapshots ---------------------------------------------------------------------------------------------

_WEIGHT = f"(-1.0{D} / nullif(MONTHS_BALANCE, 0))"


def _wm(c: str, prefix: str) -> str:
    return f"CASE WHEN count({c} * {_WEIGHT}) = count(*) THEN sum({c} * {_WEIGHT}) / sum({_WEIGHT}) END AS {prefix}_WM_{c}"


_POS_STATUS = ["Active", "Completed", "Returned to the store"]
_POS_SQL = f"""SELECT a.* , l.pos_DPD_COUNT FROM (SELECT SK_ID_CURR, count(SK_ID_PREV) AS pos_row_count, {', '.join(f'avg({c}) AS pos_{c}' for c in ('MONTHS_BALANCE', 'CNT_INSTALMENT', 'CNT_INSTALMENT_FUTURE', 'SK_DPD', 'SK_DPD_DEF'))},
  {', '.join(_share('NAME_CONTRACT_STATUS', v, f'pos_status_{safe_name(v)}') for v in _POS_STATUS)}, coalesce(sum(CNT_INSTALMENT), 0) / nullif(coalesce(sum(CNT_INSTALMENT_FUTURE), 0), 0) AS pos_RATIO_PAY_TOPAY,
  {', '.join(f'min({c}) AS pos_MIN_{n}, max({c}) AS pos_MAX_{n}' for n, c in (('BAL', 'MONTHS_BALANCE'), ('CNT', 'CNT_INSTALMENT'), ('CNT_FUT', 'CNT_INSTALMENT_FUTURE')))},
  {', '.join(_wm(c, 'pos') for c in ('CNT_INSTALMENT', 'CNT_INSTALMENT_FUTURE', 'SK_DPD', 'SK_DPD_DEF'))} FROM {loan_sql('pos')} GROUP BY 1) a
  JOIN (SELECT SK_ID_CURR, avg(c) AS pos_DPD_COUNT FROM (SELECT SK_ID_CURR, SK_ID_PREV, sum(CASE WHEN SK_DPD = 0 THEN 0 ELSE 1 END) AS c FROM {loan_sql('pos')} GROUP BY 1, 2) GROUP BY 1) l USING (SK_ID_CURR)"""


@query("block_pos", rounded_sql(_POS_SQL, 8))
def block_pos(t: Tables):
    return rounded(blocks.pos_block(loan_table(t, "pos")), 8)


_HROWS = f"""(SELECT *, CASE WHEN SK_DPD > 0 THEN 1 ELSE 0 END AS paid_late, CASE WHEN SK_DPD_DEF > 0 THEN 1 ELSE 0 END AS paid_late_with_tolerance,
  row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY MONTHS_BALANCE DESC, SK_ID_PREV DESC) AS rn FROM {loan_sql('pos')})"""
_NUMS = ["sum", "mean", "max", "min", "median"]
_HSPECS = {"paid_late": ["count", "mean"], "paid_late_with_tolerance": ["count", "mean"], "SK_DPD": _NUMS, "SK_DPD_DEF": _NUMS}
_FN = {"sum": "sum", "mean": "avg", "max": "max", "min": "min", "median": "median", "count": "count", "std": "stddev_samp"}
_LAST_SPECS = (
    [("paid_late", a) for a in ("count", "sum", "mean")] + [("paid_late_with_tolerance", a) for a in ("sum", "mean")]
    + [(c, a) for c in ("SK_DPD", "SK_DPD_DEF") for a in ("sum", "mean", "max", "min", "std")]
)
_HIST_PARTS = [
    f"{_FN[a]}({c}){'' if k is None else f' FILTER (WHERE rn <= {k})'} AS pos_cash_{'all_installment' if k is None else f'last_{k}'}_{c}_{a}"
    for k in (1, 10, 50, None) for c, names in _HSPECS.items() for a in names
] + [
    f"CASE WHEN count(*) FILTER (WHERE rn <= {k}) = 1 THEN 0 ELSE regr_slope({c}, rn - 1) FILTER (WHERE rn <= {k}) END AS pos_cash_{k}_period_trend_{c}"
    for k in (1, 6, 12, 30, 60) for c in ("SK_DPD", "SK_DPD_DEF")
]
_POS_HISTORY_SQL = f"""SELECT h.*, pos_cash_remaining_installments, {', '.join(f'pos_cash_last_loan_{c}_{a}' for c, a in _LAST_SPECS)} FROM
  (SELECT SK_ID_CURR, {', '.join(_HIST_PARTS)}, sum(CASE WHEN NAME_CONTRACT_STATUS = 'Completed' THEN 1 ELSE 0 END) AS pos_cash_completed_contracts FROM {_HROWS} GROUP BY 1) h
  LEFT JOIN (SELECT SK_ID_CURR, CNT_INSTALMENT_FUTURE AS pos_cash_remaining_installments FROM {_HROWS} WHERE CNT_INSTALMENT_FUTURE IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY MONTHS_BALANCE DESC, SK_ID_PREV DESC) = 1) r USING (SK_ID_CURR)
  LEFT JOIN (SELECT SK_ID_CURR, {', '.join(f'{_FN[a]}({c}) AS pos_cash_last_loan_{c}_{a}' for c, a in _LAST_SPECS)} FROM {_HROWS}
    JOIN (SELECT SK_ID_CURR AS k, SK_ID_PREV AS last_loan FROM {loan_sql('pos')} QUALIFY row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY MONTHS_BALANCE DESC, SK_ID_PREV DESC) = 1)
    ON SK_ID_CURR = k AND SK_ID_PREV = last_loan GROUP BY 1) g USING (SK_ID_CURR)"""


@query("block_pos_history", rounded_sql(_POS_HISTORY_SQL))
def block_pos_history(t: Tables):
    return rounded(blocks.pos_history_block(loan_table(t, "pos")))


_CARD_NUM = ["MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF", "CNT_DRAWINGS_CURRENT", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_CURRENT",
             "AMT_DRAWINGS_OTHER_CURRENT", "AMT_DRAWINGS_POS_CURRENT", "CNT_DRAWINGS_ATM_CURRENT", "CNT_DRAWINGS_OTHER_CURRENT", "CNT_DRAWINGS_POS_CURRENT", "AMT_INST_MIN_REGULARITY",
             "AMT_PAYMENT_CURRENT", "AMT_PAYMENT_TOTAL_CURRENT", "AMT_RECEIVABLE_PRINCIPAL", "AMT_RECIVABLE", "AMT_TOTAL_RECEIVABLE", "CNT_INSTALMENT_MATURE_CUM"]
_CARD_WM = ["AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "SK_DPD", "SK_DPD_DEF", "AMT_DRAWINGS_ATM_CURRENT", "AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_OTHER_CURRENT", "AMT_DRAWINGS_POS_CURRENT",
            "AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_CURRENT", "AMT_PAYMENT_TOTAL_CURRENT", "AMT_RECEIVABLE_PRINCIPAL", "AMT_RECIVABLE", "AMT_TOTAL_RECEIVABLE", "CNT_INSTALMENT_MATURE_CUM"]
_CARD_SPREAD = {"BAL": "AMT_BALANCE", "LIM": "AMT_CREDIT_LIMIT_ACTUAL", "DRW": "AMT_DRAWINGS_ATM_CURRENT", "C_DRW": "AMT_DRAWINGS_CURRENT", "O_DRW": "AMT_DRAWINGS_OTHER_CURRENT",
                "P_DRW": "AMT_DRAWINGS_POS_CURRENT", "INST": "AMT_INST_MIN_REGULARITY", "PAYMENT": "AMT_PAYMENT_CURRENT", "PRIN": "AMT_RECEIVABLE_PRINCIPAL", "RECV": "AMT_RECIVABLE", "CNT_INSTL": "CNT_INSTALMENT_MATURE_CUM"}
_SUM = {c: f"coalesce(sum({c}), 0)" for c in _CARD_NUM}
_DRAWN = " + ".join(_SUM[f"AMT_DRAWINGS{p}_CURRENT"] for p in ("_ATM", "", "_OTHER", "_POS"))
_TIMES = " + ".join(_SUM[f"CNT_DRAWINGS{p}_CURRENT"] for p in ("_ATM", "", "_OTHER", "_POS"))
_CARD_SQL = f"""SELECT a.*, l.cc_bal_DPD_COUNT, l.cc_bal_INSTALLMENTS_PER_LOAN FROM (SELECT SK_ID_CURR, count(SK_ID_PREV) AS cc_bal_row_count, {', '.join(f'avg({c}) AS cc_bal_{c}' for c in _CARD_NUM)},
  {_share('NAME_CONTRACT_STATUS', 'Active', 'cc_bal_status_Active')}, {_share('NAME_CONTRACT_STATUS', 'Signed', 'cc_bal_status_Signed')},
  100.0{D} * sum(CASE WHEN AMT_PAYMENT_CURRENT < AMT_INST_MIN_REGULARITY THEN 1 ELSE 0 END) / count(*) AS cc_bal_PERCENTAGE_MISSED_PAYMENTS,
  {_SUM['AMT_DRAWINGS_ATM_CURRENT']} / nullif({_SUM['AMT_DRAWINGS_CURRENT']}, 0) * 100 AS cc_bal_CASH_CARD_RATIO, {_SUM['AMT_DRAWINGS_CURRENT']} / nullif({_SUM['CNT_DRAWINGS_CURRENT']}, 0) * 100 AS cc_bal_DRAWINGS_RATIO,
  {_SUM['AMT_BALANCE']} / nullif({_DRAWN}, 0) AS cc_bal_BALANCE_DRAWINGS_RATIO, CAST(trunc({_SUM['AMT_BALANCE']} - ({_DRAWN})) AS BIGINT) AS cc_bal_BALANCE_DRAWINGS_DIFF,
  CAST({_TIMES} AS DOUBLE) AS cc_bal_sum_drawings_cnt, {_SUM['AMT_TOTAL_RECEIVABLE']} - {_SUM['AMT_RECEIVABLE_PRINCIPAL']} AS cc_bal_R_BAD_DEBTS,
  {', '.join(f'max({c}) AS cc_bal_MAX_{n}, min({c}) AS cc_bal_MIN_{n}' for n, c in _CARD_SPREAD.items())}, {', '.join(_wm(c, 'cc_bal') for c in _CARD_WM)} FROM {loan_sql('card')} GROUP BY 1) a
  JOIN (SELECT SK_ID_CURR, avg(c) AS cc_bal_DPD_COUNT, CAST(trunc(sum(m) / count(*)) AS INTEGER) AS cc_bal_INSTALLMENTS_PER_LOAN FROM
  (SELECT SK_ID_CURR, SK_ID_PREV, sum(CASE WHEN SK_DPD = 0 THEN 0 ELSE 1 END) AS c, max(CNT_INSTALMENT_MATURE_CUM) AS m FROM {loan_sql('card')} GROUP BY 1, 2) GROUP BY 1) l USING (SK_ID_CURR)"""


@query("block_card", rounded_sql(_CARD_SQL, 8))
def block_card(t: Tables):
    return rounded(blocks.card_block(loan_table(t, "card")), 8)


_INST_NUM = ["AMT_INSTALMENT", "AMT_PAYMENT", "DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT", "NUM_INSTALMENT_NUMBER", "NUM_INSTALMENT_VERSION"]
_INST_FN = {"mean": "avg({c})", "min": "min({c})", "max": "max({c})", "sum": "coalesce(sum({c}), 0)", "var": "var_samp({c})"}
_INST_SQL = f"""SELECT SK_ID_CURR, count(SK_ID_PREV) AS inst_row_count, {', '.join(f'{f.format(c=c)} AS inst_{a}_{c}' for c in _INST_NUM for a, f in _INST_FN.items())},
  avg(abs(DAYS_INSTALMENT)) AS inst_mean_abs_DAYS_INSTALMENT, avg(abs(DAYS_ENTRY_PAYMENT)) AS inst_mean_abs_DAYS_ENTRY_PAYMENT,
  coalesce(sum(AMT_INSTALMENT), 0) - coalesce(sum(AMT_PAYMENT), 0) AS inst_DIFF_INSTALMENT_PAYMENT, coalesce(sum(AMT_PAYMENT), 0) / nullif(sum(AMT_INSTALMENT), 0) AS inst_RATIO_INSTALMENT_PAYMENT,
  coalesce(sum(abs(DAYS_ENTRY_PAYMENT)), 0) - coalesce(sum(abs(DAYS_INSTALMENT)), 0) AS inst_DIFF_INSTALMENT_PAYMENT_DATE FROM {loan_sql('instalments')} GROUP BY 1"""


@query("block_instalments", rounded_sql(_INST_SQL))
def block_instalments(t: Tables):
    return rounded(blocks.instalment_block(loan_table(t, "instalments")))


# --- application ---------------------------------------------------------------------------------------------------

_APP_STRINGS = ["CODE_GENDER", "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE", "OCCUPATION_TYPE", "ORGANIZATION_TYPE", "FLAG_OWN_CAR", "FLAG_OWN_REALTY"]
_APP_INTS = ["CNT_CHILDREN", "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_ID_PUBLISH", "REG_CITY_NOT_WORK_CITY", *DOCUMENTS]
_APP_DOUBLES = ["CNT_FAM_MEMBERS", "DAYS_REGISTRATION", "DAYS_LAST_PHONE_CHANGE", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "OWN_CAR_AGE",
                "OBS_30_CNT_SOCIAL_CIRCLE", "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE", *SCORES, *ENQUIRIES, *BUILDING]
_APP_FEATURES = _APP_STRINGS + _APP_INTS + _APP_DOUBLES
_CLEAN = f"""(SELECT * REPLACE (nullif(CODE_GENDER, 'XNA') AS CODE_GENDER, nullif(DAYS_LAST_PHONE_CHANGE, 0) AS DAYS_LAST_PHONE_CHANGE, nullif(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED) FROM {loan_sql('application')})"""


def _recipes_sql(source: str) -> tuple[str, list[str]]:
    """Source rows with every recipe aggregate, fitted within the split; and the aggregate names."""
    sql, names = f"SELECT x.*", []
    joins = ""
    for i, (keys, specs) in enumerate(application.RECIPES):
        cols = []
        for c, a in specs:
            n = f"{'_'.join(keys)}_{a}_{c}"
            call = {"mean": f"avg({c})", "max": f"max({c})", "sum": f"coalesce(sum({c}), 0)"}[a]
            cols.append(f"{call} AS {n}")
            names.append(n)
        sql += "".join(f", r{i}.{'_'.join(keys)}_{a}_{c}" for c, a in specs)
        present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        same = " AND ".join(f"x.{k} = r{i}.{k}" for k in ["split", *keys])
        joins += f" LEFT JOIN (SELECT split, {', '.join(keys)}, {', '.join(cols)} FROM {source} WHERE {present} GROUP BY ALL) r{i} ON {same}"
    return f"(SELECT * FROM ({sql} FROM {source} x{joins}))", names


_RECIPED, _RECIPE_NAMES = _recipes_sql("cleaned")
_DIFFS = [
    part
    for keys, specs in application.RECIPES for c, a in specs if a != "sum"
    for n in [f"{'_'.join(keys)}_{a}_{c}"]
    for part in (f"{c} - {n} AS {n}_diff", f"abs({c} - {n}) AS {n}_abs_diff")
]


@query(
    "application_recipes",
    f"WITH cleaned AS {_CLEAN} " + rounded_sql(f"SELECT SK_ID_CURR, {', '.join(_RECIPE_NAMES)}, {', '.join(_DIFFS)} FROM {_RECIPED}", 8),
)
def application_recipes(t: Tables):
    app = application.clean(loan_table(t, "application"))
    fitted = application.fit_recipes(app, application.RECIPES, ["split"])
    wide = application.group_deviation(application.group_recipe(app, application.RECIPES, fitted), application.RECIPES)
    made = [c for c in wide.columns if c not in app.columns]
    return rounded(wide.select("SK_ID_CURR", *made), 8)


def _median_by(keys: list[str], columns: list[str], alias: str) -> str:
    return f"(SELECT {', '.join(keys)}, {', '.join(f'median({c}) AS m_{c}' for c in columns)} FROM cleaned GROUP BY ALL) {alias}"


_IMPUTED = f"""(SELECT f.* REPLACE (coalesce(f.EXT_SOURCE_3, avg(f.EXT_SOURCE_3) OVER (PARTITION BY f.split)) AS EXT_SOURCE_3) FROM (SELECT x.* REPLACE ({', '.join(f'coalesce(x.{c}, m_{c}) AS {c}' for c in (*SCORES, 'AMT_ANNUITY'))}) FROM cleaned x
  JOIN {_median_by(['split', 'NAME_INCOME_TYPE'], SCORES, 'i')} ON x.split = i.split AND x.NAME_INCOME_TYPE IS NOT DISTINCT FROM i.NAME_INCOME_TYPE
  JOIN {_median_by(['split', 'CODE_GENDER'], ['AMT_ANNUITY'], 'g')} ON x.split = g.split AND x.CODE_GENDER IS NOT DISTINCT FROM g.CODE_GENDER) f)"""
_LEFT = "(AMT_ANNUITY + AMT_INCOME_TOTAL - AMT_GOODS_PRICE)"
_ROW = {
    "EXT_12": "EXT_SOURCE_1 * EXT_SOURCE_2", "EXT_23": "EXT_SOURCE_2 * EXT_SOURCE_3", "EXT_31": "EXT_SOURCE_1 * EXT_SOURCE_3",
    "AVG_EXT": "list_avg([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3])", "NEW_SOURCES_PROD": "EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3",
    "external_sources_weighted": "EXT_SOURCE_1 * 2 + EXT_SOURCE_2 * 3 + EXT_SOURCE_3 * 4",
    "BIRTH_CREDIT": "AMT_CREDIT * DAYS_BIRTH", "BIRTH_ANNUITY": "AMT_ANNUITY * DAYS_BIRTH", "COST_INCOME": "AMT_INCOME_TOTAL - AMT_GOODS_PRICE",
    "Ratio_of_debt_credit": f"{_LEFT} / nullif(AMT_CREDIT, 0)", "Ratio_of_credit_employement": "AMT_CREDIT / nullif(DAYS_EMPLOYED, 0)",
    "income_debt_ratio": f"{_LEFT} / nullif(AMT_ANNUITY + AMT_INCOME_TOTAL, 0)", "CreditEmployPdt": "AMT_CREDIT * DAYS_EMPLOYED",
    "DAYS_EMPLOYED_PERC": "DAYS_EMPLOYED / nullif(DAYS_BIRTH, 0)", "DAYS_UNEMPLOYED": "DAYS_BIRTH - DAYS_EMPLOYED",
    "INCOME_CREDIT_PERC": "AMT_INCOME_TOTAL / nullif(AMT_CREDIT, 0)", "INCOME_PER_PERSON": "AMT_INCOME_TOTAL / nullif(CNT_FAM_MEMBERS, 0)",
    "ANNUITY_INCOME_PERC": "AMT_ANNUITY / nullif(AMT_INCOME_TOTAL, 0)", "ANN_CREDIT_RATIO": "AMT_ANNUITY / nullif(AMT_CREDIT, 0)",
    "CHILD_RATIO": "CNT_CHILDREN / nullif(CNT_FAM_MEMBERS, 0)", "CREDIT_GOODS_RATIO": "AMT_CREDIT / nullif(AMT_GOODS_PRICE, 0)",
    "NEW_INC_PER_CHLD": "AMT_INCOME_TOTAL / (1 + CNT_CHILDREN)", "NEW_CAR_TO_BIRTH_RATIO": "OWN_CAR_AGE / nullif(DAYS_BIRTH, 0)",
    "NEW_CAR_TO_EMPLOY_RATIO": "OWN_CAR_AGE / nullif(DAYS_EMPLOYED, 0)", "NEW_PHONE_TO_BIRTH_RATIO": "DAYS_LAST_PHONE_CHANGE / nullif(DAYS_BIRTH, 0)",
    "NEW_PHONE_TO_EMPLOY_RATIO": "DAYS_LAST_PHONE_CHANGE / nullif(DAYS_EMPLOYED, 0)", "NEW_CREDIT_TO_INCOME_RATIO": "AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0)",
    "long_employment": "CASE WHEN DAYS_EMPLOYED < -2000 THEN 1 ELSE 0 END", "retirement_age": "CASE WHEN DAYS_BIRTH < -14000 THEN 1 ELSE 0 END",
    "cnt_non_child": "CNT_FAM_MEMBERS - CNT_CHILDREN", "credit_per_person": "AMT_CREDIT / nullif(CNT_FAM_MEMBERS, 0)", "credit_per_child": "AMT_CREDIT / (1 + CNT_CHILDREN)",
    "AGE": "CAST(abs(trunc(DAYS_BIRTH / 365)) AS INTEGER)", "TOTAL_NO_ENQUIRY": " + ".join(ENQUIRIES),
    "TOT_SOC_OBS_DPD": "OBS_30_CNT_SOCIAL_CIRCLE + OBS_60_CNT_SOCIAL_CIRCLE", "TOT_SOC_DEF_DPD": "DEF_30_CNT_SOCIAL_CIRCLE + DEF_60_CNT_SOCIAL_CIRCLE",
    "ANNUITY_LENGTH": "AMT_CREDIT / nullif(AMT_ANNUITY, 0)", "TOTAL_DOCS_SUBMITTED": " + ".join(DOCUMENTS),
    "owns_car": "CASE WHEN FLAG_OWN_CAR = 'Y' THEN 1 ELSE 0 END", "owns_realty": "CASE WHEN FLAG_OWN_REALTY = 'Y' THEN 1 ELSE 0 END",
    "RICH": "CASE WHEN FLAG_OWN_CAR = 'Y' AND FLAG_OWN_REALTY = 'Y' THEN 1 ELSE 0 END", "two_or_more_children": "CASE WHEN CNT_CHILDREN >= 2 THEN 1 ELSE 0 END",
    "family_over_4": "CASE WHEN CNT_FAM_MEMBERS > 4 THEN 1 ELSE 0 END",
    "is_civil_marriage_3_children": "CASE WHEN NAME_FAMILY_STATUS = 'Civil marriage' AND CNT_CHILDREN >= 3 THEN 1 ELSE 0 END",
    **{application.interaction_name(a, x, b, y): f"CASE WHEN {a} = '{x}' AND {b} = '{y}' THEN 1 ELSE 0 END" for a, x, b, y in application.INTERACTIONS},
}
_ROW2 = {
    "DAYS_UNEMPLOYED_PERC": "1 - DAYS_EMPLOYED_PERC", "child_to_non_child_ratio": "CNT_CHILDREN / nullif(cnt_non_child, 0)",
    "income_per_non_child": "AMT_INCOME_TOTAL / nullif(cnt_non_child, 0)", "credit_per_non_child": "AMT_CREDIT / nullif(cnt_non_child, 0)",
    "CAR_AGE_RATIO": "OWN_CAR_AGE / nullif(AGE, 0)", "ANNUITY_EMPLOYED_RATIO": "ANNUITY_LENGTH / nullif(DAYS_EMPLOYED, 0)",
    "AGE_0_25": "CASE WHEN AGE <= 25 THEN 1 ELSE 0 END", "AGE_25_35": "CASE WHEN AGE <= 35 AND AGE >= 25 THEN 1 ELSE 0 END",
    "AGE_35_50": "CASE WHEN AGE <= 50 AND AGE >= 35 THEN 1 ELSE 0 END", "AGE_50_70": "CASE WHEN AGE <= 70 AND AGE >= 50 THEN 1 ELSE 0 END",
    "NEW_INC_BY_ORG": "org_income", "NEW_SCORES_STD": "coalesce(scores_std, avg(scores_std) OVER (PARTITION BY split))",
    "car_age_filled": "coalesce(OWN_CAR_AGE, car_mean)", "Age45": "CASE WHEN trunc(coalesce(OWN_CAR_AGE, car_mean) + 23) >= 45 THEN 1 ELSE 0 END",
}
_APP_ROWS = f"""(SELECT *, {', '.join(f'{e} AS {n}' for n, e in _ROW2.items())} FROM (SELECT *, {', '.join(f'{e} AS {n}' for n, e in _ROW.items())}, list_stddev_samp([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]) AS scores_std FROM {_IMPUTED})
  LEFT JOIN (SELECT split AS s3, ORGANIZATION_TYPE AS o3, median(AMT_INCOME_TOTAL) AS org_income FROM cleaned GROUP BY ALL) ON split = s3 AND ORGANIZATION_TYPE = o3
  LEFT JOIN (SELECT split AS s4, CODE_GENDER AS g4, avg(OWN_CAR_AGE) AS car_mean FROM cleaned WHERE CODE_GENDER IS NOT NULL GROUP BY ALL) ON split = s4 AND CODE_GENDER = g4)"""
_APP_SQL = f"WITH cleaned AS {_CLEAN} " + rounded_sql(
    f"SELECT SK_ID_CURR, {', '.join([*SCORES, 'AMT_ANNUITY', *_ROW, *_ROW2])} FROM {_APP_ROWS}", 10
)


@query("block_application", _APP_SQL)
def block_application(t: Tables):
    app = application.clean(loan_table(t, "application"))
    stats = application.fit_statistics(app)
    wide = application.fitted_features(application.row_features(application.impute(app, stats)), stats)
    made = [c for c in wide.columns if c not in app.columns]
    return rounded(wide.select("SK_ID_CURR", *SCORES, "AMT_ANNUITY", *made), 10)


_ENCODED = (
    f"(SELECT SK_ID_CURR, missing / {len(_APP_FEATURES) + 1} AS missing_percent, "
    + ", ".join(
        f"""CASE WHEN {c} IS NULL OR NOT EXISTS (SELECT 1 FROM cleaned t WHERE t.split = 'train' AND t.{c} = x.{c}) THEN -1 ELSE
    CAST((SELECT count(DISTINCT t.{c}) FROM cleaned t WHERE t.split = 'train' AND t.{c} < x.{c}) AS INTEGER) END AS {c}"""
        for c in _APP_STRINGS
    )
    + f" FROM (SELECT *, {' + '.join(f'CASE WHEN {c} IS NULL THEN 1 ELSE 0 END' for c in _APP_FEATURES)} AS missing FROM cleaned) x)"
)
# the whole application frame: row features, codes in place of strings, recipes and deviations
_APP_WIDE = f"""(SELECT a.* EXCLUDE ({', '.join([*_APP_STRINGS, 'scores_std', 's3', 'o3', 'org_income', 's4', 'g4', 'car_mean'])}),
  e.* EXCLUDE (SK_ID_CURR), r.* EXCLUDE (SK_ID_CURR) FROM {_APP_ROWS} a JOIN {_ENCODED} e ON a.SK_ID_CURR = e.SK_ID_CURR
  JOIN (SELECT SK_ID_CURR, {', '.join(_RECIPE_NAMES)}, {', '.join(_DIFFS)} FROM {_RECIPED}) r ON a.SK_ID_CURR = r.SK_ID_CURR)"""


# digits by kind of column, as in the queries of the single blocks: row features are products of small numbers
_DIGITS = {**dict.fromkeys([*_RECIPE_NAMES, *[d.rpartition(" AS ")[2] for d in _DIFFS]], 8), **dict.fromkeys([*SCORES, "AMT_ANNUITY", *_ROW, *_ROW2], 10)}


def _rounded_by_kind(df):
    exprs = [f"round(`{c}`, {_DIGITS.get(c, 6)}) AS `{c}`" if kind == "double" else f"`{c}`" for c, kind in df.dtypes]
    return df.selectExpr(*exprs)


def _rounded_by_kind_sql(body: str) -> str:
    own = ", ".join(f"round({c}, {n}) + 0 AS {c}" for c, n in _DIGITS.items())
    return f"SELECT split, {own}, round(COLUMNS(* EXCLUDE (split, {', '.join(_DIGITS)})), 6) + 0 FROM ({body})"


@query("application_encoded", f"WITH cleaned AS {_CLEAN} " + _rounded_by_kind_sql(f"SELECT * FROM {_APP_WIDE}"))
def application_encoded(t: Tables):
    return _rounded_by_kind(application.application_features(loan_table(t, "application")))


@query(
    "feature_mart",
    f"WITH cleaned AS {_CLEAN} "
    + _rounded_by_kind_sql(
        f"""SELECT *, cc_bal_AMT_BALANCE / nullif(AMT_INCOME_TOTAL, 0) AS cc_bal_INCOME_RATIO, cc_bal_AMT_DRAWINGS_ATM_CURRENT / nullif(AMT_INCOME_TOTAL, 0) AS cc_payment_INCOME_RATIO
    FROM {_APP_WIDE} x LEFT JOIN ({_BUREAU_SQL}) USING (SK_ID_CURR) LEFT JOIN ({_PREV_SQL}) USING (SK_ID_CURR) LEFT JOIN ({_POS_SQL}) USING (SK_ID_CURR)
    LEFT JOIN ({_CARD_SQL}) USING (SK_ID_CURR) LEFT JOIN ({_INST_SQL}) USING (SK_ID_CURR) LEFT JOIN ({_POS_HISTORY_SQL}) USING (SK_ID_CURR)"""
    ),
)
def full_mart(t: Tables):
    """Every column of the mart."""
    return _rounded_by_kind(feature_mart(loan_tables(t)))
