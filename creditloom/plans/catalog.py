"""Every registered query with the SQL that checks it.

A query is a function of (spark, folder). ``sql`` runs on the same tables in the checking engine;
a query without it is checked for running only, and by the unit tests.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.registry import (
    CONTRACT_OUTCOMES,
    ID_COLUMN,
    PRESENCE_FLAGS,
    feature_names,
    feature_rows,
    fill_for_missing_history,
    fill_values,
)
from creditloom.functions.scalars import age_bucket, cache_key, json_text, risk_tier
from creditloom.operators import (
    attribution,
    drift,
    evaluation,
    features,
    governance,
    impute,
    models,
    ordering,
    portfolio,
    quality,
)
from creditloom.plans import lifecycle
from creditloom.plans.roles import TABLES, role, table, with_roles
from creditloom.runtime import materialise, scratch_path, small_table
from creditloom.sources import readers, writers
from creditloom.sources.audit_table import AuditTable
from creditloom.sources.schemas import ATTRIBUTION, REQUEST_LISTS, raw_schema, request_schema
from creditloom.streaming import online
from creditloom.streaming.answer_cache import rows_to_answer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = datetime(2024, 7, 15)
DIGITS = 4


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Real numbers rounded, because two engines add in different orders.

    A mean of few cents can lie exactly between two rounded values; both sides first add a
    thousandth of the last digit, so that such a tie does not hang on the order of addition.
    """
    nudge = 10.0 ** -(digits + 3)
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`") + F.lit(nudge), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# ---------------------------------------------------------------- history features

EPS = "1e-5"

LOAN_MONTHS_SQL = """
loan_months AS (
  SELECT SK_ID_BUREAU, COUNT(*) AS bb_total_months_tracked, MAX(level) AS bb_worst_status,
         COUNT(*) FILTER (WHERE level > 0) AS bb_months_overdue_count,
         MAX(level) FILTER (WHERE MONTHS_BALANCE >= -6) AS bb_worst_status_last_6m
  FROM (SELECT *, COALESCE(TRY_CAST(CASE WHEN STATUS IN ('C', 'X') THEN '0' ELSE STATUS END AS BIGINT), 0) AS level
        FROM bureau_balance) GROUP BY SK_ID_BUREAU)"""

BUREAU_SQL = """
bureau_f AS (
  SELECT SK_ID_CURR, COUNT(*) AS bureau_loan_count,
         COUNT(DISTINCT CREDIT_TYPE) + MAX(CASE WHEN CREDIT_TYPE IS NULL THEN 1 ELSE 0 END) AS bureau_loan_types,
         MAX(DAYS_CREDIT) AS bureau_days_since_last_loan, MIN(DAYS_CREDIT) AS bureau_days_since_first_loan,
         round(AVG(AMT_CREDIT_SUM) + 1e-7, 4) AS bureau_avg_credit,
         round(COALESCE(SUM(AMT_CREDIT_SUM_DEBT), 0) + 1e-7, 4) AS total_debt,
         round(COALESCE(SUM(AMT_CREDIT_SUM), 0) + 1e-7, 4) AS total_credit,
         round(COALESCE(SUM(AMT_CREDIT_SUM_DEBT) FILTER (WHERE CREDIT_ACTIVE = 'Active'), 0) + 1e-7, 4) AS bureau_active_debt,
         round(COALESCE(SUM(AMT_CREDIT_SUM_DEBT), 0) / (COALESCE(SUM(AMT_CREDIT_SUM), 0) + 1e-5) + 1e-7, 4) AS debt_to_credit_ratio,
         MAX(CREDIT_DAY_OVERDUE) AS bureau_max_overdue,
         round(COALESCE(SUM(AMT_CREDIT_SUM_OVERDUE), 0) + 1e-7, 4) AS bureau_total_amt_overdue,
         CAST(COALESCE(SUM(CNT_CREDIT_PROLONG), 0) AS BIGINT) AS bureau_total_prolong_count,
         COALESCE(MAX(bb_worst_status), 0) AS bureau_global_worst_status,
         CAST(COALESCE(SUM(bb_months_overdue_count), 0) AS BIGINT) AS bureau_total_months_overdue_across_loans,
         COALESCE(MAX(bb_worst_status_last_6m), 0) AS bureau_global_worst_status_last_6m,
         1 AS HAS_BUREAU_RECORD
  FROM bureau LEFT JOIN loan_months USING (SK_ID_BUREAU) GROUP BY SK_ID_CURR)"""

INSTALLMENT_SQL = """
ins_f AS (
  SELECT SK_ID_CURR, COUNT(*) AS ins_total_installment_tracked,
         round(MIN(gap) + 1e-7, 4) AS ins_worst_underpay, round(AVG(gap) + 1e-7, 4) AS ins_mean_payment_diff,
         round(AVG(AMT_PAYMENT / (AMT_INSTALMENT + 1e-5)) + 1e-7, 4) AS ins_mean_payratio,
         COUNT(*) FILTER (WHERE gap < 0) AS ins_underpayment_count,
         round(MAX(late) + 1e-7, 4) AS ins_worst_day_late, round(AVG(late) + 1e-7, 4) AS ins_avg_day_late,
         COUNT(*) FILTER (WHERE late > 0) AS ins_late_count, 1 AS HAS_INSTALMENT_HISTORY
  FROM (SELECT *, AMT_PAYMENT - AMT_INSTALMENT AS gap, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS late
        FROM installments) GROUP BY SK_ID_CURR)"""

NEWEST = "MONTHS_BALANCE * CAST(1000000000 AS HUGEINT) + SK_ID_PREV"

CARD_SQL = f"""
cc_f AS (
  SELECT SK_ID_CURR, COUNT(*) AS cc_months_tracked,
         round(COALESCE(SUM(AMT_DRAWINGS_CURRENT), 0) + 1e-7, 4) AS cc_total_drawings_amt,
         round(MAX(AMT_DRAWINGS_CURRENT) + 1e-7, 4) AS cc_max_single_month_drawing,
         round(COALESCE(SUM(CNT_DRAWINGS_CURRENT), 0) + 1e-7, 4) AS cc_total_drawings_count,
         round(COALESCE(SUM(AMT_DRAWINGS_ATM_CURRENT), 0) + 1e-7, 4) AS cc_total_atm_drawings_amt,
         round(COALESCE(SUM(AMT_DRAWINGS_ATM_CURRENT), 0) / (COALESCE(SUM(AMT_DRAWINGS_CURRENT), 0) + 1e-5) + 1e-7, 4)
             AS cc_atm_to_total_drawing_ratio,
         round(COALESCE(SUM(AMT_PAYMENT_CURRENT), 0) + 1e-7, 4) AS cc_total_paymemt,
         round(COALESCE(SUM(AMT_PAYMENT_CURRENT), 0) / (COALESCE(SUM(AMT_INST_MIN_REGULARITY), 0) + 1e-5) + 1e-7, 4)
             AS cc_pay_to_min_inst_ratio,
         round(MAX(AMT_BALANCE) + 1e-7, 4) AS cc_max_balance_ever,
         round(arg_max_null(AMT_BALANCE, {NEWEST}) + 1e-7, 4) AS cc_current_balance,
         round(arg_max_null(AMT_TOTAL_RECEIVABLE, {NEWEST}) + 1e-7, 4) AS cc_current_total_receivable,
         round(arg_max_null(AMT_BALANCE / (AMT_CREDIT_LIMIT_ACTUAL + 1e-5), {NEWEST}) + 1e-7, 4)
             AS cc_current_utilization_ratio,
         MAX(SK_DPD) AS cc_max_days_past_due, MAX(SK_DPD_DEF) AS cc_max_days_past_due_with_tolerance,
         COUNT(*) FILTER (WHERE SK_DPD > 0) AS cc_month_overdue_count, 1 AS HAS_CREDIT_CARD_HISTORY
  FROM credit_card GROUP BY SK_ID_CURR)"""

POS_SQL = f"""
pos_f AS (
  SELECT SK_ID_CURR, COUNT(*) AS pos_month_tracked, MAX(CNT_INSTALMENT) AS pos_max_loan_term,
         arg_max_null(CNT_INSTALMENT_FUTURE, {NEWEST}) AS pos_current_remaining_installments,
         round(arg_max_null(CNT_INSTALMENT_FUTURE / (CNT_INSTALMENT + 1e-5), {NEWEST}) + 1e-7, 4)
             AS pos_remaining_installment_ratio,
         MAX(SK_DPD) AS pos_max_days_past_due, MAX(SK_DPD_DEF) AS pos_max_days_past_due_with_tolerance,
         COUNT(*) FILTER (WHERE SK_DPD > 0) AS pos_month_overdue_count, 1 AS HAS_POS_HISTORY
  FROM pos GROUP BY SK_ID_CURR)"""

PREVIOUS_SQL = """
prev_n AS (
  SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_DECISION DESC, SK_ID_PREV DESC) AS rn
  FROM previous),
prev_f AS (
  SELECT SK_ID_CURR, COUNT(*) AS prev_total_applications,
         MAX(DAYS_DECISION) AS prev_days_since_last_decision, MIN(DAYS_DECISION) AS prev_days_since_first_decision,
         round(SUM(AMT_APPLICATION) + 1e-7, 4) AS prev_total_amt_asked, round(SUM(AMT_CREDIT) + 1e-7, 4) AS prev_total_amt_approved,
         round(SUM(AMT_CREDIT) / (SUM(AMT_APPLICATION) + 1e-5) + 1e-7, 4) AS prev_credit_to_application_ratio,
         round(AVG(AMT_ANNUITY) + 1e-7, 4) AS prev_avg_annuity_amt,
         round(AVG(RATE_DOWN_PAYMENT) + 1e-7, 4) AS prev_avg_down_payment_rate,
         round(AVG(CNT_PAYMENT) + 1e-7, 4) AS prev_avg_loan_term_months,
         COUNT(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Refused') AS prev_count_refused,
         COUNT(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Approved') AS prev_count_approved,
         COUNT(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Canceled') AS prev_count_canceled,
         round(COUNT(*) FILTER (WHERE NAME_CONTRACT_STATUS = 'Refused') / COUNT(*) + 1e-7, 4) AS prev_rejection_rate,
         MAX(CASE WHEN rn = 1 AND NAME_CONTRACT_STATUS = 'Approved' THEN 1 ELSE 0 END) AS prev_most_recent_status_Approved,
         MAX(CASE WHEN rn = 1 AND NAME_CONTRACT_STATUS = 'Refused' THEN 1 ELSE 0 END) AS prev_most_recent_status_Refused,
         MAX(CASE WHEN rn = 1 AND NAME_CONTRACT_STATUS = 'Canceled' THEN 1 ELSE 0 END) AS prev_most_recent_status_Canceled,
         MAX(CASE WHEN rn = 1 AND NAME_CONTRACT_STATUS = 'Unused offer' THEN 1 ELSE 0 END)
             AS "prev_most_recent_status_Unused offer",
         1 AS HAS_PREVIOUS_APPLICATION
  FROM prev_n GROUP BY SK_ID_CURR)"""


@query(
    "bureau_balance_features",
    f"{with_roles('bureau_balance')}, {LOAN_MONTHS_SQL} SELECT * FROM loan_months",
)
def _(spark, folder):
    return features.loan_month_features(role(spark, folder, "bureau_balance"))


def bureau_table(spark, folder):
    months = features.loan_month_features(role(spark, folder, "bureau_balance"))
    return features.bureau_features(role(spark, folder, "bureau"), months)


@query(
    "bureau_features",
    f"{with_roles('bureau', 'bureau_balance')}, {LOAN_MONTHS_SQL}, {BUREAU_SQL} SELECT * FROM bureau_f",
)
def _(spark, folder):
    return rounded(bureau_table(spark, folder))


@query(
    "installment_features",
    f"{with_roles('installments')}, {INSTALLMENT_SQL} SELECT * FROM ins_f",
)
def _(spark, folder):
    return rounded(features.installment_features(role(spark, folder, "installments")))


@query("credit_card_features", f"{with_roles('credit_card')}, {CARD_SQL} SELECT * FROM cc_f")
def _(spark, folder):
    return rounded(features.credit_card_features(role(spark, folder, "credit_card")))


@query("pos_features", f"{with_roles('pos')}, {POS_SQL} SELECT * FROM pos_f")
def _(spark, folder):
    return rounded(features.pos_features(role(spark, folder, "pos")))


@query("previous_application_features", f"{with_roles('previous')}, {PREVIOUS_SQL} SELECT * FROM prev_f")
def _(spark, folder):
    return rounded(features.previous_application_features(role(spark, folder, "previous")))


@query(
    "unknown_outcomes",
    f"""{with_roles('previous')} SELECT COUNT(*) AS n_rows,
        COUNT(*) FILTER (WHERE NAME_CONTRACT_STATUS IS NULL
          OR NAME_CONTRACT_STATUS NOT IN ('Approved', 'Refused', 'Canceled', 'Unused offer')) AS n_unknown
        FROM previous""",
)
def _(spark, folder):
    return features.unknown_outcomes(role(spark, folder, "previous"))


def history_tables(spark, folder):
    return [
        bureau_table(spark, folder),
        features.installment_features(role(spark, folder, "installments")),
        features.credit_card_features(role(spark, folder, "credit_card")),
        features.pos_features(role(spark, folder, "pos")),
        features.previous_application_features(role(spark, folder, "previous")),
    ]


def master_table(spark, folder):
    base = role(spark, folder, "application")
    clean = impute.impute(base)
    return features.fill_joined_nulls(features.star_join(clean, *history_tables(spark, folder)))


IMPUTE_SQL = """
zeroed AS (SELECT * EXCLUDE (OWN_CAR_AGE, COMMONAREA_AVG),
                  CASE WHEN FLAG_OWN_CAR = 'N' THEN 0e0 ELSE OWN_CAR_AGE END AS OWN_CAR_AGE FROM application),
med AS (SELECT median(EXT_SOURCE_1) AS m1, median(EXT_SOURCE_2) AS m2, median(OWN_CAR_AGE) AS mc FROM zeroed),
imputed AS (
  SELECT SK_ID_CURR, TARGET, round(COALESCE(EXT_SOURCE_1, m1) + 1e-7, 4) AS EXT_SOURCE_1,
         round(COALESCE(EXT_SOURCE_2, m2) + 1e-7, 4) AS EXT_SOURCE_2,
         COALESCE(NAME_INCOME_TYPE, 'Missing') AS NAME_INCOME_TYPE,
         CASE FLAG_OWN_CAR WHEN 'Y' THEN 1 ELSE 0 END AS FLAG_OWN_CAR,
         CASE FLAG_OWN_REALTY WHEN 'Y' THEN 1 ELSE 0 END AS FLAG_OWN_REALTY,
         round(COALESCE(OWN_CAR_AGE, mc) + 1e-7, 4) AS OWN_CAR_AGE, DAYS_BIRTH, round(AMT_INCOME_TOTAL + 1e-7, 4) AS AMT_INCOME_TOTAL,
         CASE WHEN EXT_SOURCE_1 IS NULL THEN 1 ELSE 0 END AS MISSING_EXT_SOURCE_1,
         CASE WHEN EXT_SOURCE_2 IS NULL THEN 1 ELSE 0 END AS MISSING_EXT_SOURCE_2
  FROM zeroed, med)"""


@query("impute_application", f"{with_roles('application')}, {IMPUTE_SQL} SELECT * FROM imputed")
def _(spark, folder):
    return rounded(impute.impute(role(spark, folder, "application")))


@query(
    "impute_unseen_nulls",
    f"""{with_roles('application')}, med AS (SELECT median(AMT_INCOME_TOTAL) AS income, CAST(trunc(median(DAYS_BIRTH)) AS INT) AS days FROM application)
        SELECT SK_ID_CURR, round(CASE WHEN SK_ID_CURR % 11 = 0 THEN income ELSE AMT_INCOME_TOTAL END + 1e-7, 4) AS AMT_INCOME_TOTAL,
               CASE WHEN SK_ID_CURR % 13 = 0 THEN days ELSE DAYS_BIRTH END AS DAYS_BIRTH,
               CASE WHEN FLAG_OWN_CAR = 'Y' AND SK_ID_CURR % 3 > 0 THEN 1 ELSE 0 END AS FLAG_OWN_CAR FROM application, med""",
)
def _(spark, folder):
    """Columns that were full in training have nulls later; the stored imputer knows a fill for them too."""
    train = role(spark, folder, "application")
    profile = impute.ImputeProfile.from_json(impute.fit_imputer(train, every_column=True).to_json())
    gaps = {"AMT_INCOME_TOTAL": 11, "DAYS_BIRTH": 13, "FLAG_OWN_CAR": 3}
    later = train.withColumns({c: F.when(F.col(ID_COLUMN) % n != 0, F.col(c)) for c, n in gaps.items()})
    return rounded(impute.apply_imputer(later, profile).select(ID_COLUMN, *gaps))


def _filled_history_sql() -> str:
    names = [n for g in ("bureau", "ins", "cc", "pos", "prev") for n in feature_names(group=g)] + PRESENCE_FLAGS
    return ", ".join(f'COALESCE("{n}", {fill_for_missing_history(n)}) AS "{n}"' for n in names)


MASTER_SQL = (
    with_roles("application", "bureau", "bureau_balance", "installments", "credit_card", "pos", "previous")
    + f", {IMPUTE_SQL}, {LOAN_MONTHS_SQL}, {BUREAU_SQL}, {INSTALLMENT_SQL}, {CARD_SQL}, {POS_SQL}, {PREVIOUS_SQL},"
    + f"""
master AS (SELECT imputed.*, {_filled_history_sql()} FROM imputed
  LEFT JOIN bureau_f USING (SK_ID_CURR) LEFT JOIN ins_f USING (SK_ID_CURR) LEFT JOIN cc_f USING (SK_ID_CURR)
  LEFT JOIN pos_f USING (SK_ID_CURR) LEFT JOIN prev_f USING (SK_ID_CURR))"""
)


@query("master_table", f"{MASTER_SQL} SELECT * FROM master")
def _(spark, folder):
    return rounded(master_table(spark, folder))


# ---------------------------------------------------------------- data quality


def _missing_sql(name: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", '{c}' AS "column", '{t}' AS dtype, COUNT(*) - COUNT({c}) AS null_count,
            CASE WHEN COUNT(*) > 0 THEN (COUNT(*) - COUNT({c})) / COUNT(*) ELSE 0 END AS missing_rate,
            COUNT(*) AS n_rows FROM {name}"""
        for c, t in columns.items()
    )


APPLICATION_TYPES = {
    "SK_ID_CURR": "bigint", "TARGET": "int", "EXT_SOURCE_1": "double", "EXT_SOURCE_2": "double",
    "NAME_INCOME_TYPE": "string", "COMMONAREA_AVG": "double", "FLAG_OWN_CAR": "string",
    "FLAG_OWN_REALTY": "string", "OWN_CAR_AGE": "double", "DAYS_BIRTH": "int", "AMT_INCOME_TOTAL": "double",
}
CARD_TYPES = {
    "SK_ID_CURR": "bigint", "SK_ID_PREV": "bigint", "MONTHS_BALANCE": "int", "AMT_BALANCE": "double",
    "AMT_CREDIT_LIMIT_ACTUAL": "double", "AMT_DRAWINGS_CURRENT": "double", "AMT_DRAWINGS_ATM_CURRENT": "double",
    "CNT_DRAWINGS_CURRENT": "double", "AMT_INST_MIN_REGULARITY": "double", "AMT_PAYMENT_CURRENT": "double",
    "AMT_TOTAL_RECEIVABLE": "double", "SK_DPD": "bigint", "SK_DPD_DEF": "bigint",
}
REPORT_SQL = (
    with_roles("application", "credit_card")
    + ", report AS ("
    + _missing_sql("application", APPLICATION_TYPES)
    + " UNION ALL "
    + _missing_sql("credit_card", CARD_TYPES)
    + ")"
)
ROUNDED_REPORT = 'SELECT "table", "column", dtype, null_count, round(missing_rate + 1e-7, 4) AS missing_rate, n_rows FROM report'


@query("missing_summary", f"{REPORT_SQL} {ROUNDED_REPORT} WHERE \"table\" = 'application'")
def _(spark, folder):
    return rounded(quality.missing_summary(role(spark, folder, "application"), "application"))


def both_reports(spark, folder):
    return quality.missing_report({n: role(spark, folder, n) for n in ("application", "credit_card")})


@query("missing_report", f"{REPORT_SQL} {ROUNDED_REPORT}")
def _(spark, folder):
    return rounded(both_reports(spark, folder))


@query(
    "missing_buckets",
    f"""{REPORT_SQL} SELECT CASE WHEN missing_rate >= 0.7 THEN 'high (>=70%)'
        WHEN missing_rate >= 0.3 THEN 'medium (30-70%)' ELSE 'low (<30%)' END AS missing_bucket, COUNT(*) AS n_columns
        FROM report WHERE missing_rate > 0 GROUP BY 1""",
)
def _(spark, folder):
    return quality.missing_histogram(both_reports(spark, folder))


@query(
    "top_missing",
    f"{REPORT_SQL} {ROUNDED_REPORT} WHERE missing_rate > 0 ORDER BY report.missing_rate DESC, \"column\" LIMIT 5",
)
def _(spark, folder):
    return rounded(quality.top_missing(both_reports(spark, folder), 5))


@query(
    "ext_null_rates",
    f"""{with_roles('application')} SELECT COUNT(*) - COUNT(EXT_SOURCE_1) AS "EXT_SOURCE_1_nulls",
        COUNT(*) - COUNT(EXT_SOURCE_2) AS "EXT_SOURCE_2_nulls",
        round((COUNT(*) - COUNT(EXT_SOURCE_1)) / COUNT(*) + 1e-7, 4) AS "EXT_SOURCE_1_missing_rate",
        round((COUNT(*) - COUNT(EXT_SOURCE_2)) / COUNT(*) + 1e-7, 4) AS "EXT_SOURCE_2_missing_rate" FROM application""",
)
def _(spark, folder):
    return rounded(quality.null_rates(role(spark, folder, "application"), ["EXT_SOURCE_1", "EXT_SOURCE_2"]))


@query(
    "residual_nulls",
    f"""{with_roles('application')}, {IMPUTE_SQL} SELECT CAST((SELECT COUNT(*) FROM imputed WHERE EXT_SOURCE_1 IS NULL
        OR EXT_SOURCE_2 IS NULL OR OWN_CAR_AGE IS NULL OR NAME_INCOME_TYPE IS NULL) AS BIGINT) AS null_cells""",
)
def _(spark, folder):
    return quality.residual_nulls(impute.impute(role(spark, folder, "application")))


GIVEN = [*TABLES, "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@query(
    "table_inventory",
    " UNION ALL ".join(
        f"SELECT '{t}' AS file, COUNT(*) AS \"rows\", (SELECT CAST(COUNT(*) AS INT) FROM (DESCRIBE SELECT * FROM {t})) AS cols FROM {t}" for t in GIVEN
    ),
)
def _(spark, folder):
    found = readers.list_tables(spark, folder)
    return quality.table_inventory({name: spark.read.parquet(f"{folder}/{name}.parquet") for name in found})


@query(
    "key_contracts",
    f"""{with_roles('application', 'bureau')}
        SELECT 'application' AS name, COUNT(*) AS n_rows, COUNT(DISTINCT SK_ID_CURR) AS n_keys,
               CAST(0 AS BIGINT) AS n_repeated_keys, COUNT(*) FILTER (WHERE SK_ID_CURR IS NULL) AS n_null_keys,
               COUNT(*) FILTER (WHERE TARGET IS NULL) AS n_null_labels, COUNT(*) = COUNT(DISTINCT SK_ID_CURR) AS is_unique
        FROM application
        UNION ALL
        SELECT 'bureau', COUNT(*), COUNT(DISTINCT SK_ID_CURR),
               (SELECT COUNT(*) FROM (SELECT SK_ID_CURR FROM bureau GROUP BY 1 HAVING COUNT(*) > 1)),
               COUNT(*) FILTER (WHERE SK_ID_CURR IS NULL), 0, COUNT(*) = COUNT(DISTINCT SK_ID_CURR) FROM bureau""",
)
def _(spark, folder):
    application = quality.key_contract(role(spark, folder, "application"), ID_COLUMN, "TARGET")
    bureau = quality.key_contract(role(spark, folder, "bureau"), ID_COLUMN)
    return application.select(F.lit("application").alias("name"), "*").unionByName(
        bureau.select(F.lit("bureau").alias("name"), "*")
    )


@query(
    "id_overlap",
    f"""{with_roles('application', 'credit_card')} SELECT COUNT(DISTINCT SK_ID_CURR) AS n_shared FROM application
        WHERE SK_ID_CURR IN (SELECT SK_ID_CURR FROM credit_card)""",
)
def _(spark, folder):
    return quality.id_overlap(role(spark, folder, "application"), role(spark, folder, "credit_card"), ID_COLUMN)


def _registry_sql() -> str:
    names = ", ".join(f"('{f.name}')" for f in feature_rows())
    ignored = ", ".join(f"'{c}'" for c in (ID_COLUMN, "TARGET", *PRESENCE_FLAGS))
    return f"""{MASTER_SQL}, registered(feature) AS (VALUES {names}),
        present AS (SELECT column_name AS feature FROM (DESCRIBE SELECT * FROM master) WHERE column_name NOT IN ({ignored}))
        SELECT feature, CASE WHEN feature NOT IN (SELECT feature FROM present) THEN 'missing' ELSE 'ok' END AS state,
               CASE WHEN feature IN (SELECT feature FROM present) THEN CAST(0 AS BIGINT) END AS null_count FROM registered
        UNION ALL
        SELECT feature, 'unregistered', NULL FROM present WHERE feature NOT IN (SELECT feature FROM registered)"""


@query("registry_check", _registry_sql())
def _(spark, folder):
    return quality.registry_check(master_table(spark, folder), ignore=(ID_COLUMN, "TARGET", *PRESENCE_FLAGS))


@query(
    "value_counts",
    'SELECT o_orderpriority, COUNT(*) AS "count" FROM orders GROUP BY 1',
)
def _(spark, folder):
    return quality.value_counts(table(spark, folder, "orders"), "o_orderpriority")


@query(
    "describe_scores",
    f"""{with_roles('scored')} SELECT COUNT(score) AS "count", round(AVG(score) + 1e-7, 4) AS mean, round(stddev_samp(score) + 1e-7, 4) AS std,
        MIN(score) AS "min", round(quantile_cont(score, 0.25) + 1e-7, 4) AS p25, round(quantile_cont(score, 0.5) + 1e-7, 4) AS p50,
        round(quantile_cont(score, 0.75) + 1e-7, 4) AS p75, MAX(score) AS "max" FROM scored""",
)
def _(spark, folder):
    scored = role(spark, folder, "scored")
    quartiles = ordering.exact_quantiles(scored, ["score"], [0.25, 0.5, 0.75])["score"]
    return rounded(quality.describe_numeric(scored, "score", quartiles))


@query(
    "predicted_classes",
    f"{with_roles('scored')} SELECT CAST(score >= 0.5 AS INT) AS predicted_class, COUNT(*) AS \"count\" FROM scored GROUP BY 1",
)
def _(spark, folder):
    scored = role(spark, folder, "scored").withColumn("predicted_class", evaluation.binarise(F.col("score")))
    return quality.value_counts(scored, "predicted_class")


@query("default_rate", f"{with_roles('application')} SELECT round(AVG(TARGET) + 1e-9, 6) AS default_rate FROM application")
def _(spark, folder):
    return role(spark, folder, "application").agg(F.round(F.avg("TARGET") + 1e-9, 6).alias("default_rate"))


# ---------------------------------------------------------------- lookup, union, alignment, JSON

TRAIN_TEST = """
train AS (SELECT * EXCLUDE (OWN_CAR_AGE), CASE WHEN SK_ID_CURR % 17 = 0 THEN NULL ELSE OWN_CAR_AGE END AS OWN_CAR_AGE
          FROM application WHERE SK_ID_CURR % 3 <> 0),
test AS (SELECT * EXCLUDE (TARGET) FROM application WHERE SK_ID_CURR % 3 <> 1)"""


def train_and_test(spark, folder):
    application = role(spark, folder, "application")
    nan = F.when(F.col(ID_COLUMN) % 17 == 0, F.lit(float("nan"))).otherwise(F.col("OWN_CAR_AGE"))
    train = application.where(F.col(ID_COLUMN) % 3 != 0).withColumn("OWN_CAR_AGE", nan)
    return train, application.where(F.col(ID_COLUMN) % 3 != 1).drop("TARGET")


@query(
    "applicant_lookup",
    f"""{with_roles('application')}, {TRAIN_TEST},
        wanted AS (SELECT DISTINCT user_id AS SK_ID_CURR FROM events)
        SELECT SK_ID_CURR, TARGET, OWN_CAR_AGE, round(AMT_INCOME_TOTAL + 1e-7, 4) AS AMT_INCOME_TOTAL, 0 AS found_in FROM train SEMI JOIN wanted USING (SK_ID_CURR)
        UNION ALL
        SELECT SK_ID_CURR, NULL, OWN_CAR_AGE, round(AMT_INCOME_TOTAL + 1e-7, 4), 1 FROM test SEMI JOIN wanted USING (SK_ID_CURR)
        WHERE SK_ID_CURR NOT IN (SELECT SK_ID_CURR FROM train)""",
)
def _(spark, folder):
    wanted = table(spark, folder, "events").select(F.col("user_id").alias(ID_COLUMN))
    found = portfolio.lookup_applicants(wanted, list(train_and_test(spark, folder)))
    return rounded(found.select(ID_COLUMN, "TARGET", "OWN_CAR_AGE", "AMT_INCOME_TOTAL", "found_in"))


@query(
    "diagonal_concat",
    f"""{with_roles('application')}, {TRAIN_TEST}
        SELECT SK_ID_CURR, TARGET, CAST(DAYS_BIRTH AS DOUBLE) AS DAYS_BIRTH, 'Missing' AS NAME_TYPE_SUITE, 0e0 AS CNT_CHILDREN FROM train
        UNION ALL
        SELECT SK_ID_CURR, NULL, CAST(DAYS_BIRTH AS DOUBLE), 'Missing', 0e0 FROM test""",
)
def _(spark, folder):
    train, test = train_and_test(spark, folder)
    both = readers.diagonal_union([train, test.withColumn("DAYS_BIRTH", F.col("DAYS_BIRTH").cast("double"))])
    aligned = impute.align_to(both, ["NAME_TYPE_SUITE", "CNT_CHILDREN"], ["NAME_TYPE_SUITE"])
    return aligned.select(ID_COLUMN, "TARGET", "DAYS_BIRTH", "NAME_TYPE_SUITE", "CNT_CHILDREN")


@query(
    "json_payload_extract",
    f"""{with_roles('predictions')} SELECT id, json_extract_string(request_payload, '$.source') AS source_tag,
        TRY_CAST(json_extract_string(request_payload, '$.application.DAYS_BIRTH') AS DOUBLE) AS DAYS_BIRTH,
        TRY_CAST(json_extract_string(request_payload, '$.application.EXT_SOURCE_1') AS DOUBLE) AS EXT_SOURCE_1,
        TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM predictions""",
)
def _(spark, folder):
    scores = role(spark, folder, "predictions")
    inner = T.StructType([T.StructField(n, T.StringType()) for n in ("DAYS_BIRTH", "EXT_SOURCE_1")])
    parsed = scores.withColumn("p", F.from_json("request_payload", T.StructType([T.StructField("application", inner)])))
    return parsed.select(
        "id",
        F.get_json_object("request_payload", "$.source").alias("source_tag"),
        F.col("p.application.DAYS_BIRTH").try_cast("double").alias("DAYS_BIRTH"),
        F.col("p.application.EXT_SOURCE_1").try_cast("double").alias("EXT_SOURCE_1"),
        F.get_json_object("props", "$.k").try_cast("long").alias("k"),
    )


@query(
    "json_encode",
    f"""{with_roles('application')} SELECT SK_ID_CURR,
        concat('{{"SK_ID_CURR":', SK_ID_CURR, ',"NAME_INCOME_TYPE":', CASE WHEN NAME_INCOME_TYPE IS NULL THEN 'null'
        ELSE concat('"', NAME_INCOME_TYPE, '"') END, ',"DAYS_BIRTH":', DAYS_BIRTH, '}}') AS doc FROM application""",
)
def _(spark, folder):
    doc = json_text(F.col(ID_COLUMN), F.col("NAME_INCOME_TYPE"), F.col("DAYS_BIRTH"))
    return role(spark, folder, "application").select(ID_COLUMN, doc.alias("doc"))


@query(
    "cache_key",
    f"""{with_roles('predictions')} SELECT id, concat('prediction:', application_id, ':', substring(md5(request_payload), 1, 8)) AS cache_key
        FROM predictions""",
)
def _(spark, folder):
    return role(spark, folder, "predictions").select(
        "id", cache_key(F.col("application_id"), F.col("request_payload")).alias("cache_key")
    )


REQUEST_TEXT = """CASE WHEN event_id % 10 = 0 THEN '{broken' WHEN event_id % 10 = 1 THEN '{"application": {"AMT_CREDIT": 1}}'
    ELSE concat('{"application": {"SK_ID_CURR": ', user_id, ', "AMT_CREDIT": ', event_id % 50, ', "OTHER": "x"}, "bureau": [{"SK_ID_BUREAU": ',
                event_id, ', "CREDIT_TYPE": "', event_type, '"}]}') END"""


@query(
    "request_conformance",
    """SELECT event_id, event_id % 10 > 1 AS accepted, CASE WHEN event_id % 10 > 1 THEN user_id END AS "SK_ID_CURR",
       CASE WHEN event_id % 10 > 1 THEN CAST(event_id % 50 AS DOUBLE) END AS "AMT_CREDIT" FROM events""",
)
def _(spark, folder):
    documents = table(spark, folder, "events").select("event_id", F.expr(REQUEST_TEXT).alias("text"))
    good, bad = quality.conforming_requests(documents, "text", request_schema(), "application.SK_ID_CURR")
    accepted = good.select(
        "event_id", F.lit(True).alias("accepted"), "request.application.SK_ID_CURR", "request.application.AMT_CREDIT"
    )
    rejected = bad.select("event_id", F.lit(False).alias("accepted"))
    return accepted.unionByName(rejected, allowMissingColumns=True)


@query(
    "request_children",
    """SELECT user_id AS "SK_ID_CURR", event_id AS "SK_ID_BUREAU", event_type AS "CREDIT_TYPE", CAST(NULL AS DOUBLE) AS "AMT_CREDIT_SUM"
       FROM events WHERE event_id % 10 > 1""",
)
def _(spark, folder):
    documents = table(spark, folder, "events").select(F.expr(REQUEST_TEXT).alias("text"))
    good, _ = quality.conforming_requests(documents, "text", request_schema(), "application.SK_ID_CURR")
    children = readers.records_to_table(good, "bureau", raw_schema("bureau"))
    return children.select("SK_ID_CURR", "SK_ID_BUREAU", "CREDIT_TYPE", "AMT_CREDIT_SUM")


@query(
    "registry_fill",
    f"""{with_roles('application')} SELECT SK_ID_CURR, round(COALESCE(EXT_SOURCE_1, -1) + 1e-7, 4) AS EXT_SOURCE_1,
        COALESCE(NAME_INCOME_TYPE, 'Missing') AS NAME_INCOME_TYPE, COALESCE(OWN_CAR_AGE, 0) AS OWN_CAR_AGE FROM application""",
)
def _(spark, folder):
    rows = role(spark, folder, "application").select(ID_COLUMN, "EXT_SOURCE_1", "NAME_INCOME_TYPE", "OWN_CAR_AGE")
    return rounded(rows.na.fill({c: v for c, v in fill_values().items() if c in rows.columns}))


@query(
    "column_kinds",
    f"""{with_roles('application')}, k AS (SELECT column_name, column_type FROM (DESCRIBE SELECT * FROM application))
        SELECT column_name AS "column", column_type <> 'VARCHAR' AS is_numeric,
               column_type = 'VARCHAR' AS is_category FROM k""",
)
def _(spark, folder):
    rows = role(spark, folder, "application")
    numeric, _ = impute.split_columns(rows)
    kinds = [
        (f.name, f.name in numeric, impute.is_category(f.name, f.dataType)) for f in rows.schema.fields
    ]
    return small_table(spark, kinds, "column string, is_numeric boolean, is_category boolean")


# ---------------------------------------------------------------- portfolio

SPANS = {"all": "", "6m": "WHERE predicted_at >= TIMESTAMP '2024-07-15' - INTERVAL 6 MONTH",
         "1y": "WHERE predicted_at >= TIMESTAMP '2024-07-15' - INTERVAL 1 YEAR"}


def _summary_query(period: str) -> None:
    @query(
        f"portfolio_summary_{period}",
        f"""{with_roles('predictions')}, p AS (SELECT * FROM predictions {SPANS[period]}),
            t AS (SELECT COUNT(*) AS total_predictions, COUNT(*) FILTER (WHERE risk_tier = 'HIGH') AS high_risk_count,
                         round(COALESCE(AVG(default_probability), 0) + 1e-7, 4) AS avg_default_probability FROM p),
            g AS (SELECT risk_tier, COUNT(*) AS "count", round(AVG(default_probability) + 1e-7, 4) AS avg_probability FROM p GROUP BY 1)
            SELECT total_predictions, high_risk_count, avg_default_probability, '{period}' AS period,
                   risk_tier, "count", avg_probability FROM t LEFT JOIN g ON TRUE""",
    )
    def _(spark, folder):
        summary = portfolio.portfolio_summary(role(spark, folder, "predictions"), period, AS_OF)
        return rounded(summary.select(
            "total_predictions", "high_risk_count", "avg_default_probability", "period",
            F.inline_outer("tier_breakdown"),
        ))


for _period in SPANS:
    _summary_query(_period)

PAGE_SQL = "id, application_id, round(default_probability + 1e-7, 4) AS default_probability, risk_tier, model_version, predicted_at, cached"


@query(
    "portfolio_page",
    f"""{with_roles('predictions')} SELECT {PAGE_SQL} FROM predictions {SPANS['6m']}
        ORDER BY predicted_at DESC, id LIMIT 100 OFFSET 50""",
)
def _(spark, folder):
    return rounded(portfolio.score_page(role(spark, folder, "predictions"), "6m", AS_OF, 100, 50))


@query(
    "portfolio_deep_page",
    f"""{with_roles('predictions')} SELECT {PAGE_SQL} FROM predictions
        ORDER BY predicted_at DESC, id LIMIT 100 OFFSET 700""",
)
def _(spark, folder):
    return rounded(portfolio.score_page(role(spark, folder, "predictions"), "all", AS_OF, 100, 700))


@query(
    "flagged_page",
    f"""{with_roles('predictions')} SELECT {PAGE_SQL} FROM predictions {SPANS['6m']} AND risk_tier = 'HIGH'
        ORDER BY predicted_at DESC, id LIMIT 20 OFFSET 5""",
)
def _(spark, folder):
    return rounded(portfolio.score_page(role(spark, folder, "predictions"), "6m", AS_OF, 20, 5, "HIGH"))


@query(
    "page_totals",
    f"""{with_roles('predictions')} SELECT COUNT(*) AS total, '6m' AS period FROM predictions {SPANS['6m']}
        UNION ALL SELECT COUNT(*), 'all' FROM predictions WHERE risk_tier = 'HIGH'""",
)
def _(spark, folder):
    scores = role(spark, folder, "predictions")
    return portfolio.page_total(scores, "6m", AS_OF).unionByName(
        portfolio.page_total(scores, "all", AS_OF, "HIGH")
    )


@query(
    "high_risk_rate",
    f"""{with_roles('predictions')} SELECT 'all' AS period, COUNT(*) AS total_predictions,
        COUNT(*) FILTER (WHERE risk_tier = 'HIGH') AS high_risk_count,
        round(CASE WHEN COUNT(*) > 0 THEN 100e0 * COUNT(*) FILTER (WHERE risk_tier = 'HIGH') / COUNT(*) ELSE 0 END + 1e-7, 4)
            AS high_risk_rate FROM predictions""",
)
def _(spark, folder):
    summary = portfolio.portfolio_summary(role(spark, folder, "predictions"), "all", AS_OF)
    return rounded(portfolio.high_risk_rate(summary))


@query(
    "tier_order",
    f"""{with_roles('predictions')} SELECT risk_tier, COUNT(*) AS "count",
        CASE risk_tier WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END AS tier_rank FROM predictions GROUP BY 1 ORDER BY 3""",
)
def _(spark, folder):
    return portfolio.tiers_in_order(role(spark, folder, "predictions"))


@query(
    "daily_trend",
    f"""{with_roles('predictions')} SELECT CAST(predicted_at AS DATE) AS date,
        round(AVG(default_probability) + 1e-7, 4) AS avg_probability FROM predictions GROUP BY 1""",
)
def _(spark, folder):
    return rounded(portfolio.daily_trend(role(spark, folder, "predictions")))


@query(
    "daily_trend_newest_1000",
    f"""{with_roles('predictions')} SELECT CAST(predicted_at AS DATE) AS date,
        round(AVG(default_probability) + 1e-7, 4) AS avg_probability
        FROM (SELECT * FROM predictions ORDER BY predicted_at DESC, id LIMIT 1000) GROUP BY 1""",
)
def _(spark, folder):
    newest = portfolio.score_page(role(spark, folder, "predictions"), "all", AS_OF, 1000)
    return rounded(portfolio.daily_trend(newest))


@query(
    "flagged_export",
    f"""{with_roles('predictions')} SELECT CAST(application_id AS VARCHAR) AS "Application ID",
        printf('%.2f%%', default_probability * 100) AS "Default Probability", risk_tier AS "Risk Tier",
        model_version AS "Model Version", strftime(predicted_at, '%Y-%m-%d %H:%M UTC') AS "Predicted At"
        FROM predictions WHERE risk_tier = 'HIGH'""",
)
def _(spark, folder):
    path = scratch_path(spark, "flagged")
    writers.export_csv(portfolio.flagged_display(role(spark, folder, "predictions")), path)
    return readers.read_csv(spark, path)


# ---------------------------------------------------------------- order, folds, encoding


@query(
    "row_index",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders",
)
def _(spark, folder):
    return ordering.row_index(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "row_index_levels",
    """SELECT key, row_number() OVER (ORDER BY key) - 1 AS row_index
       FROM (SELECT DISTINCT l_orderkey * 100000 + l_partkey AS key FROM lineitem)""",
)
def _(spark, folder):
    keys = table(spark, folder, "lineitem").select((F.col("l_orderkey") * 100000 + F.col("l_partkey")).alias("key")).distinct()
    return ordering.row_index(keys, "key", rows_per_range=500, fan=64)


@query(
    "temporal_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= CAST(floor(COUNT(*) OVER () * 0.8e0) AS BIGINT)
       THEN 'train' ELSE 'holdout' END AS split FROM orders""",
)
def _(spark, folder):
    return ordering.temporal_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "time_series_folds",
    """SELECT o_orderkey, CAST(greatest(0, 5 - ((n - 1 - i) // (n // 6))) AS INT) AS fold
       FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, COUNT(*) OVER () AS n FROM orders)""",
)
def _(spark, folder):
    return ordering.time_folds(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "exact_medians",
    "SELECT round(median(l_quantity) + 1e-7, 4) AS l_quantity, round(median(l_extendedprice) + 1e-7, 4) AS l_extendedprice FROM lineitem",
)
def _(spark, folder):
    columns = ["l_quantity", "l_extendedprice"]
    found = ordering.exact_medians(table(spark, folder, "lineitem"), columns)
    schema = ", ".join(f"{c} double" for c in columns)
    return rounded(small_table(spark, [tuple(found[c] for c in columns)], schema))


@query(
    "ordinal_encode",
    f"""{with_roles('bureau')}, fitted AS (SELECT CREDIT_TYPE, dense_rank() OVER (ORDER BY CREDIT_TYPE) - 1 AS code
          FROM (SELECT DISTINCT CREDIT_TYPE FROM bureau WHERE CREDIT_TYPE <> '1-URGENT'))
        SELECT SK_ID_BUREAU, CAST(COALESCE(code, -1) AS DOUBLE) AS CREDIT_TYPE_code
        FROM bureau LEFT JOIN fitted USING (CREDIT_TYPE)""",
)
def _(spark, folder):
    bureau = role(spark, folder, "bureau").select("SK_ID_BUREAU", "CREDIT_TYPE")
    coded = models.ordinal_encode(bureau, ["CREDIT_TYPE"], bureau.where("CREDIT_TYPE <> '1-URGENT'"))
    return coded.select("SK_ID_BUREAU", "CREDIT_TYPE_code")


@query(
    "ordinal_encode_wide",
    """SELECT event_id, CAST(COALESCE(p.code, -1) AS DOUBLE) AS props_code, CAST(COALESCE(t.code, -1) AS DOUBLE) AS event_type_code FROM events
       LEFT JOIN (SELECT props, row_number() OVER (ORDER BY props) - 1 AS code FROM events WHERE value > 0 GROUP BY props) p USING (props)
       LEFT JOIN (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code FROM events WHERE value > 0 GROUP BY event_type) t USING (event_type)""",
)
def _(spark, folder):
    events = table(spark, folder, "events").select("event_id", "props", "event_type", "value")
    coded = models.ordinal_encode(events, ["props", "event_type"], events.where("value > 0"), broadcast_bytes=10_000, rows_per_range=500)
    return coded.select("event_id", "props_code", "event_type_code")


@query(
    "one_hot",
    with_roles("previous") + " SELECT SK_ID_PREV, "
    + ", ".join(f"CAST(NAME_CONTRACT_STATUS = '{o}' AS INT) AS \"status_{o}\"" for o in CONTRACT_OUTCOMES)
    + " FROM previous",
)
def _(spark, folder):
    previous = role(spark, folder, "previous").select("SK_ID_PREV", "NAME_CONTRACT_STATUS")
    return features.one_hot(previous, "NAME_CONTRACT_STATUS", {o: o for o in CONTRACT_OUTCOMES}, "status")


@query(
    "risk_tiers",
    f"""{with_roles('predictions')} SELECT id, CASE WHEN default_probability < 0.3e0 THEN 'LOW'
        WHEN default_probability <= 0.6e0 THEN 'MEDIUM' ELSE 'HIGH' END AS tier FROM predictions""",
)
def _(spark, folder):
    return role(spark, folder, "predictions").select("id", risk_tier(F.col("default_probability")).alias("tier"))


# ---------------------------------------------------------------- rank metrics and fairness

CURVE_SQL = """
per_score AS (SELECT {score} AS score, COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y = 0) AS neg
              FROM scored GROUP BY 1),
curve AS (SELECT *, SUM(pos) OVER (ORDER BY score) AS cum_pos, SUM(neg) OVER (ORDER BY score) AS cum_neg,
                 SUM(pos) OVER () AS p, SUM(neg) OVER () AS n FROM per_score)"""


@query(
    "auc_gini_ks",
    f"""{with_roles('scored')}, {CURVE_SQL.format(score='score')}
        SELECT round(SUM(pos * (cum_neg - neg + neg / 2e0)) / (MAX(p)::DOUBLE * MAX(n)) + 1e-9, 6) AS auc_roc,
               round(2 * SUM(pos * (cum_neg - neg + neg / 2e0)) / (MAX(p)::DOUBLE * MAX(n)) - 1 + 1e-9, 6) AS gini,
               round(MAX(abs(cum_pos::DOUBLE / p - cum_neg::DOUBLE / n)) + 1e-9, 6) AS ks_stat FROM curve""",
)
def _(spark, folder):
    return rounded(evaluation.rank_metrics(role(spark, folder, "scored")), 6)


@query(
    "auc_gini_ks_levels",
    f"""{with_roles('scored')}, {CURVE_SQL.format(score='score')}
        SELECT round(SUM(pos * (cum_neg - neg + neg / 2e0)) / (MAX(p)::DOUBLE * MAX(n)) + 1e-9, 6) AS auc_roc,
               round(2 * SUM(pos * (cum_neg - neg + neg / 2e0)) / (MAX(p)::DOUBLE * MAX(n)) - 1 + 1e-9, 6) AS gini,
               round(MAX(abs(cum_pos::DOUBLE / p - cum_neg::DOUBLE / n)) + 1e-9, 6) AS ks_stat FROM curve""",
)
def _(spark, folder):
    return rounded(evaluation.rank_metrics(role(spark, folder, "scored"), rows_per_range=100, fan=64), 6)


@query(
    "roc_curve",
    f"""{with_roles('scored')}, {CURVE_SQL.format(score='score')}
        SELECT score AS threshold, round((p - cum_pos + pos) / p + 1e-9, 6) AS tpr, round((n - cum_neg + neg) / n + 1e-9, 6) AS fpr,
               round((p - cum_pos + pos + n - cum_neg + neg) / (p + n) + 1e-9, 6) AS selection_rate FROM curve""",
)
def _(spark, folder):
    return rounded(evaluation.roc_curve(role(spark, folder, "scored")), 6)


@query(
    "youden",
    f"""{with_roles('scored')}, {CURVE_SQL.format(score='score_b')},
        r AS (SELECT score AS threshold, (p - cum_pos + pos) / p - (n - cum_neg + neg) / n AS j,
                     (p - cum_pos + pos + n - cum_neg + neg) / (p + n) AS selection_rate FROM curve)
        SELECT round(threshold + 1e-9, 6) AS threshold, round(j + 1e-9, 6) AS j, round(selection_rate + 1e-9, 6) AS selection_rate
        FROM r ORDER BY r.j DESC, r.threshold DESC LIMIT 1""",
)
def _(spark, folder):
    return rounded(evaluation.youden(role(spark, folder, "scored"), score="score_b"), 6)


BUCKET_SQL = """CASE WHEN -days_birth / 365.25e0 > 0 AND -days_birth / 365.25e0 <= 35 THEN 'young_lt35'
    WHEN -days_birth / 365.25e0 > 35 AND -days_birth / 365.25e0 <= 55 THEN 'middle_35_55'
    WHEN -days_birth / 365.25e0 > 55 AND -days_birth / 365.25e0 <= 150 THEN 'senior_gt55' END"""
RATES_SQL = f"""
b AS (SELECT *, {BUCKET_SQL} AS bucket FROM scored),
rates AS (SELECT bucket, COUNT(*) AS n,
                 COALESCE(COUNT(*) FILTER (WHERE y = 1 AND score >= 0.5) / nullif(COUNT(*) FILTER (WHERE y = 1), 0), 0) AS tpr,
                 COUNT(*) FILTER (WHERE score >= 0.5) / COUNT(*) AS pos_rate
          FROM b WHERE bucket IS NOT NULL GROUP BY 1)"""


@query(
    "group_rates",
    f"{with_roles('scored')}, {RATES_SQL} SELECT bucket, n, round(tpr + 1e-9, 6) AS tpr, round(pos_rate + 1e-9, 6) AS pos_rate FROM rates",
)
def _(spark, folder):
    scored = role(spark, folder, "scored").withColumn("y_pred", evaluation.binarise(F.col("score")))
    return rounded(evaluation.group_rates(scored, age_bucket(F.col("days_birth"))), 6)


@query(
    "fairness_audit",
    f"""{with_roles('scored')}, {RATES_SQL} SELECT round(MAX(tpr) - MIN(tpr) + 1e-9, 6) AS equal_opportunity_diff,
        round(MIN(pos_rate) / nullif(MAX(pos_rate), 0) + 1e-9, 6) AS disparate_impact_ratio,
        """
    + ", ".join(
        f"round(MAX(tpr) FILTER (WHERE bucket = '{b}') + 1e-9, 6) AS tpr_{b}, "
        f"round(MAX(pos_rate) FILTER (WHERE bucket = '{b}') + 1e-9, 6) AS pos_rate_{b}"
        for b in ("young_lt35", "middle_35_55", "senior_gt55")
    )
    + " FROM rates",
)
def _(spark, folder):
    scored = role(spark, folder, "scored").withColumn("y_pred", evaluation.binarise(F.col("score")))
    return rounded(evaluation.fairness_audit(scored), 6)


THRESHOLD_SQL = f"""
b AS (SELECT *, {BUCKET_SQL} AS bucket FROM scored),
ranked AS (SELECT bucket, score, row_number() OVER (PARTITION BY bucket ORDER BY score DESC) AS rn,
                  COUNT(*) OVER (PARTITION BY bucket) AS n FROM b WHERE bucket IS NOT NULL),
thresholds AS (SELECT bucket, n, CAST(least(greatest(1, round_even(0.13e0 * n, 0)), n) AS BIGINT) AS k, score AS threshold
               FROM ranked WHERE rn = CAST(least(greatest(1, round_even(0.13e0 * n, 0)), n) AS BIGINT))"""


@query("group_thresholds", f"{with_roles('scored')}, {THRESHOLD_SQL} SELECT * FROM thresholds")
def _(spark, folder):
    return evaluation.group_thresholds(role(spark, folder, "scored"), 0.13)


@query(
    "apply_thresholds",
    f"""{with_roles('scored')}, {THRESHOLD_SQL} SELECT bucket, COUNT(*) AS n, CAST(SUM(CAST(score >= threshold AS INT)) AS BIGINT) AS n_flagged
        FROM b JOIN thresholds USING (bucket) GROUP BY bucket""",
)
def _(spark, folder):
    scored = role(spark, folder, "scored")
    bucket = age_bucket(F.col("days_birth"))
    flagged = evaluation.apply_group_thresholds(scored, evaluation.group_thresholds(scored, 0.13), bucket)
    return flagged.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("y_pred").cast("long")).alias("n_flagged")
    )


@query(
    "reweigh",
    f"""{with_roles('scored')}, g AS (SELECT CAST(-days_birth / 365.25e0 >= 45 AS INT) AS a, y FROM scored),
        c AS (SELECT a, y, COUNT(*) AS n_ay FROM g GROUP BY 1, 2)
        SELECT a, y, n_ay, round(SUM(n_ay) OVER (PARTITION BY a)::DOUBLE * SUM(n_ay) OVER (PARTITION BY y)
               / (SUM(n_ay) OVER ()::DOUBLE * n_ay) + 1e-9, 6) AS weight FROM c""",
)
def _(spark, folder):
    group = evaluation.mature_group(F.col("days_birth"))
    return rounded(evaluation.reweigh_table(role(spark, folder, "scored"), group), 6)


def _model_metrics_sql(score: str, name: str) -> str:
    return f"""
        {name}_s AS (SELECT {score} AS score, COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y = 0) AS neg FROM scored GROUP BY 1),
        {name}_c AS (SELECT *, SUM(pos) OVER (ORDER BY score) AS cp, SUM(neg) OVER (ORDER BY score) AS cn,
                     SUM(pos) OVER () AS p, SUM(neg) OVER () AS n FROM {name}_s),
        {name}_r AS (SELECT SUM(pos * (cn - neg + neg / 2e0)) / (MAX(p)::DOUBLE * MAX(n)) AS auc,
                     MAX(abs(cp::DOUBLE / p - cn::DOUBLE / n)) AS ks FROM {name}_c),
        {name}_g AS (SELECT bucket, COUNT(*) FILTER (WHERE y = 1 AND {score} >= 0.5) / nullif(COUNT(*) FILTER (WHERE y = 1), 0) AS tpr,
                     COUNT(*) FILTER (WHERE {score} >= 0.5) / COUNT(*) AS rate FROM b WHERE bucket IS NOT NULL GROUP BY 1),
        {name}_f AS (SELECT MAX(tpr) - MIN(tpr) AS eod, MIN(rate) / nullif(MAX(rate), 0) AS di FROM {name}_g),
        {name} AS (SELECT 'auc_roc' AS metric, auc AS v FROM {name}_r UNION ALL SELECT 'gini', 2 * auc - 1 FROM {name}_r
                   UNION ALL SELECT 'ks_stat', ks FROM {name}_r UNION ALL SELECT 'equal_opportunity_diff', eod FROM {name}_f
                   UNION ALL SELECT 'disparate_impact_ratio', di FROM {name}_f)"""


@query(
    "model_comparison",
    f"""{with_roles('scored')}, b AS (SELECT *, {BUCKET_SQL} AS bucket FROM scored),
        {_model_metrics_sql('score', 'base')}, {_model_metrics_sql('score_b', 'cand')}
        SELECT metric, round(base.v + 1e-9, 6) AS baseline, round(cand.v + 1e-9, 6) AS candidate, round(cand.v - base.v + 1e-9, 6) AS delta,
               CASE WHEN metric <> 'disparate_impact_ratio' THEN NULL WHEN cand.v >= 0.8 THEN 'PROMOTABLE'
                    ELSE 'NOT PROMOTABLE' END AS verdict FROM base JOIN cand USING (metric)""",
)
def _(spark, folder):
    scored = role(spark, folder, "scored")
    return rounded(
        evaluation.compare_models(
            evaluation.evaluate(scored, score="score"), evaluation.evaluate(scored, score="score_b")
        ),
        6,
    )


# ---------------------------------------------------------------- attribution and models

LINEAR = {"AMT_INCOME_TOTAL": -0.0002, "DAYS_BIRTH": 0.00005, "OWN_CAR_AGE": 0.03, "EXT_SOURCE_1": -0.0001,
          "EXT_SOURCE_2": -1.5, "FLAG_OWN_CAR": -0.4}


def _linear_sql() -> str:
    cells = " UNION ALL ".join(
        f"SELECT SK_ID_CURR, {i} AS position, '{n}' AS feature_name, "
        f"CAST({w!r} AS DOUBLE) * ({n} - AVG({n}) OVER ()) AS v, CAST({n} AS DOUBLE) AS fv FROM raw"
        for i, (n, w) in enumerate(LINEAR.items())
    )
    words = {f.name: f.description for f in feature_rows()}
    names = " ".join("WHEN '{}' THEN '{}'".format(n, words[n].replace("'", "''")) for n in LINEAR)
    return f"""{with_roles('application')}, zeroed AS (SELECT *  EXCLUDE (OWN_CAR_AGE, COMMONAREA_AVG),
          CASE WHEN FLAG_OWN_CAR = 'N' THEN 0e0 ELSE OWN_CAR_AGE END AS OWN_CAR_AGE FROM application),
        med AS (SELECT median(EXT_SOURCE_1) AS m1, median(EXT_SOURCE_2) AS m2, median(OWN_CAR_AGE) AS mc FROM zeroed),
        raw AS (SELECT SK_ID_CURR, AMT_INCOME_TOTAL, DAYS_BIRTH, COALESCE(OWN_CAR_AGE, mc) AS OWN_CAR_AGE,
                COALESCE(EXT_SOURCE_1, m1) AS EXT_SOURCE_1, COALESCE(EXT_SOURCE_2, m2) AS EXT_SOURCE_2,
                CASE FLAG_OWN_CAR WHEN 'Y' THEN 1 ELSE 0 END AS FLAG_OWN_CAR FROM zeroed, med),
        cells AS ({cells})
        SELECT SK_ID_CURR, CAST(rank AS INT) AS "rank", feature_name, round(v + 1e-7, 4) AS shap_value, round(fv + 1e-7, 4) AS feature_value,
               CASE feature_name {names} END AS description
        FROM (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY abs(v) DESC, position) AS rank FROM cells) WHERE rank <= 3"""


@query("linear_attribution_topk", _linear_sql())
def _(spark, folder):
    rows = impute.impute(role(spark, folder, "application"))
    means = rows.agg(*[F.avg(c).alias(c) for c in LINEAR]).first().asDict()
    top = attribution.linear_attribution(rows, LINEAR, means, [ID_COLUMN], 3)
    return rounded(attribution.describe_top(top, [ID_COLUMN]))


NUMERIC = ["AMT_INCOME_TOTAL", "DAYS_BIRTH", "OWN_CAR_AGE", "EXT_SOURCE_1", "EXT_SOURCE_2", "bureau_loan_count",
           "debt_to_credit_ratio", "ins_mean_payratio", "cc_current_utilization_ratio", "prev_rejection_rate"]
CATEGORIES = ["NAME_INCOME_TYPE"]


def stored_master(spark, folder):
    """The feature table written once, as training reads it."""
    return materialise(
        master_table(spark, folder).select(ID_COLUMN, "TARGET", *NUMERIC, *CATEGORIES), "master"
    )


@query("gbt_train_score")
def _(spark, folder):
    master = ordering.temporal_split(stored_master(spark, folder), ID_COLUMN)
    model = models.train_boosted(
        master.where("split = 'train'"), NUMERIC, CATEGORIES, "TARGET", {"maxIter": 5, "minInstancesPerNode": 5}
    )
    return models.score_table(master.where("split = 'holdout'"), model, [ID_COLUMN, "TARGET"])


@query("gbt_early_stopping")
def _(spark, folder):
    master = ordering.temporal_split(stored_master(spark, folder), ID_COLUMN)
    model = models.train_boosted(
        master, NUMERIC, CATEGORIES, "TARGET", {"maxIter": 8, "minInstancesPerNode": 5},
        validation=F.col("split") == "holdout",
    )
    return models.score_table(master.where("split = 'holdout'"), model, [ID_COLUMN, "TARGET"])


@query("tree_attribution_topk")
def _(spark, folder):
    master = stored_master(spark, folder)
    model = models.train_boosted(master, NUMERIC, CATEGORIES, "TARGET", {"maxIter": 5, "minInstancesPerNode": 5})
    prepared = models.run_stages(master, model.stages[:-1])
    top = attribution.tree_attribution(
        prepared, model.stages[-1], models.feature_order(NUMERIC, CATEGORIES), [ID_COLUMN], 3
    )
    return attribution.describe_top(top, [ID_COLUMN])


#: Ten features, so that the ten reported reasons are all of them.
TEN = (NUMERIC[:9], CATEGORIES)


def registered_model(spark, folder):
    """A registry whose production model was trained on the feature table, and the imputer that the table was built with."""
    registry = scratch_path(spark, "registry")
    profile = impute.fit_imputer(role(spark, folder, "application"), every_column=True)
    settings = {"maxIter": 5, "minInstancesPerNode": 5}
    run_id = lifecycle.train(stored_master(spark, folder), registry, *TEN, settings, imputer=profile, now=AS_OF)
    lifecycle.promote(spark, registry, run_id, force=True, now=AS_OF)
    return registry


def reasons(audit, base):
    """Audit rows with what their stored reasons say: how many there are, and whether they add up to the score."""
    cells = F.from_json("top_shap_features", ATTRIBUTION)
    margin = F.log(F.col("default_probability") / (1 - F.col("default_probability"))) / 2
    total = F.aggregate(cells, F.lit(base), lambda s, c: s + c["shap_value"])
    described = F.forall(cells, lambda c: F.length(c["description"]) > 0)
    return audit.select("*", F.size(cells).alias("n_reasons"), (F.abs(margin - total) < 1e-6).alias("add_up"), described.alias("described"))


@query(
    "batch_reasons",
    """SELECT c_custkey AS application_id, 10 AS n_reasons, TRUE AS add_up, TRUE AS described, 'batch_ingest' AS source FROM customer""",
)
def _(spark, folder):
    """Everyone scored by the production model; the reasons read back from the audit table explain each stored score in full."""
    registry, audit, table_path = registered_model(spark, folder), scratch_path(spark, "audit"), scratch_path(spark, "features")
    writers.write_parquet(stored_master(spark, folder), table_path)
    lifecycle.score_everyone(spark, [table_path], registry, audit, AS_OF)
    base = attribution.base_margin(lifecycle.Explainer(*lifecycle.load_run(spark, registry)).leaves)
    return reasons(readers.read_audit(spark, audit), base).select("application_id", "n_reasons", "add_up", "described", "source")


@query("logreg_cv")
def _(spark, folder):
    master = stored_master(spark, folder)
    scores = models.cross_validate(
        master, ID_COLUMN, "TARGET",
        lambda train: models.train_logistic(train, NUMERIC, CATEGORIES, "TARGET", {"maxIter": 20}),
    )
    return models.fold_table(master, scores, "logistic")


@query(
    "search_folds",
    """SELECT fold, part, CASE part WHEN 'train' THEN old WHEN 'late' THEN before - old ELSE size END AS n
       FROM (SELECT fold, part, n // 6 AS size, n - (6 - fold) * (n // 6) AS before,
                    CAST(floor((n - (6 - fold) * (n // 6)) * (1 - 0.1e0)) AS BIGINT) AS old
             FROM (SELECT COUNT(*) AS n FROM customer), (SELECT CAST(unnest(range(1, 6)) AS INT) AS fold), (SELECT unnest(['train', 'late', 'test']) AS part))""",
)
def _(spark, folder):
    """What every trial of the search is fitted and tested on: rows by fold and part, as stored."""
    stored = models.fold_vectors(stored_master(spark, folder), NUMERIC, CATEGORIES, ID_COLUMN, "TARGET")
    counts = [rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("fold", F.lit(i)) for i, rows in enumerate(stored, 1)]
    return reduce(DataFrame.unionByName, counts).select("fold", "part", "n")


@query("random_search")
def _(spark, folder):
    master = stored_master(spark, folder)
    return models.random_search(
        master, NUMERIC, CATEGORIES, ID_COLUMN, "TARGET", trials=2, folds=2,
        ranges={k: v for k, v in models.SEARCH_RANGES.items() if k != "maxDepth"},
        fixed={"maxDepth": 3, "maxIter": 3, "minInfoGain": 0.0},
    )


# ---------------------------------------------------------------- drift

DRIFT_FEATURES = drift.WATCHED
CUT = date(2000, 1, 1)


def _drift_sql() -> str:
    qs = ", ".join(f"quantile_cont(v, 0.{i})" for i in range(1, 10))
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS v, seen < DATE '2000-01-01' AS r, seen FROM drift_rows WHERE {f} IS NOT NULL"
        for f in DRIFT_FEATURES
    )
    return f"""{with_roles('drift_rows')}, long AS ({long}),
        edges AS (SELECT feature, list_value({qs}) AS e FROM long WHERE r GROUP BY 1),
        binned AS (SELECT feature, len(list_filter(e, lambda x: v > x)) AS bin, r, v, seen FROM long JOIN edges USING (feature)),
        totals AS (SELECT feature, COUNT(*) FILTER (WHERE r) AS nr, COUNT(*) FILTER (WHERE NOT r) AS nc FROM binned GROUP BY 1),
        shares AS (SELECT feature, bin, greatest(COUNT(*) FILTER (WHERE r) / MAX(nr), 1e-4) AS pr,
                          greatest(COUNT(*) FILTER (WHERE NOT r) / nullif(MAX(nc), 0), 1e-4) AS pc
                   FROM binned JOIN totals USING (feature) GROUP BY 1, 2),
        psi AS (SELECT feature, CASE WHEN MAX(nc) > 0 THEN SUM((pc - pr) * ln(pc / pr)) ELSE 0 END AS psi FROM shares JOIN totals USING (feature) GROUP BY 1),
        per_value AS (SELECT feature, v, COUNT(*) FILTER (WHERE r) AS cr, COUNT(*) FILTER (WHERE NOT r) AS cc FROM long GROUP BY 1, 2),
        run AS (SELECT feature, SUM(cr) OVER w AS sr, SUM(cc) OVER w AS sc FROM per_value
                WINDOW w AS (PARTITION BY feature ORDER BY v)),
        ks AS (SELECT feature, MAX(abs(sr::DOUBLE / nr - sc::DOUBLE / nullif(nc, 0))) AS ks FROM run JOIN totals USING (feature) GROUP BY 1),
        report AS (SELECT feature, psi, ks, psi >= 0.1 AS drifted,
               CASE WHEN psi < 0.1 THEN 'Stable' WHEN psi <= 0.2 THEN 'Warning' ELSE 'Alert' END AS status,
               nr AS n_reference, nc AS n_current FROM psi JOIN ks USING (feature) JOIN totals USING (feature))"""


def drift_sides(spark, folder):
    rows = role(spark, folder, "drift_rows")
    return rows.where(F.col("seen") < F.lit(CUT)), rows.where(F.col("seen") >= F.lit(CUT))


def drift_rows_report(spark, folder):
    reference, current = drift_sides(spark, folder)
    return drift.drift_report(reference, current, DRIFT_FEATURES, date(2001, 8, 1))


@query(
    "psi_report",
    f"""{_drift_sql()} SELECT feature, round(psi + 1e-9, 6) AS psi, round(ks + 1e-9, 6) AS ks, drifted, status, n_reference, n_current,
        7 AS lookback_days, DATE '2001-08-01' AS report_date FROM report""",
)
def _(spark, folder):
    return rounded(drift_rows_report(spark, folder), 6)


@query(
    "drift_status",
    f"""{_drift_sql()} SELECT feature AS "Feature Group", round(psi + 1e-9, 6) AS "Psi Score", drifted AS "Drifted", status AS "Status" FROM report""",
)
def _(spark, folder):
    return rounded(drift.status_table(drift_rows_report(spark, folder)), 6)


@query(
    "drift_rollup",
    f"""{_drift_sql()} SELECT DATE '2001-08-01' AS report_date, bool_or(drifted) AS any_drift_detected, round(MAX(psi) + 1e-9, 6) AS max_psi,
        MAX(n_reference) AS n_reference, MAX(n_current) AS n_current FROM report""",
)
def _(spark, folder):
    return rounded(drift.report_rollup(drift_rows_report(spark, folder)), 6)


@query(
    "drift_alerts",
    f"""{_drift_sql()} SELECT feature, round(psi + 1e-9, 6) AS psi, CASE WHEN psi > 0.2 THEN 'alert' ELSE 'warning' END AS level
        FROM report WHERE psi >= 0.1""",
)
def _(spark, folder):
    return rounded(drift.alerts(drift_rows_report(spark, folder)).select("feature", "psi", "level"), 6)


def _trend_sql() -> str:
    qs = ", ".join(f"quantile_cont(v, 0.{i})" for i in range(1, 10))
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS v, seen FROM drift_rows WHERE {f} IS NOT NULL" for f in DRIFT_FEATURES
    )
    return f"""{with_roles('drift_rows')}, long AS ({long}),
        edges AS (SELECT feature, list_value({qs}) AS e FROM long WHERE seen < DATE '2000-01-01' GROUP BY 1),
        binned AS (SELECT feature, len(list_filter(e, lambda x: v > x)) AS bin, seen, date_trunc('month', seen) AS m FROM long JOIN edges USING (feature)),
        ref AS (SELECT feature, bin, COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY feature) AS p FROM binned
                WHERE seen < DATE '2000-01-01' GROUP BY 1, 2),
        cur AS (SELECT m, feature, bin, COUNT(*) AS n, SUM(COUNT(*)) OVER (PARTITION BY m, feature) AS t FROM binned
                WHERE seen >= DATE '2000-01-01' GROUP BY 1, 2, 3),
        months AS (SELECT DISTINCT m, feature FROM cur),
        bins AS (SELECT DISTINCT feature, bin FROM (SELECT feature, bin FROM ref UNION ALL SELECT feature, bin FROM cur)),
        s AS (SELECT m, feature, greatest(COALESCE(ref.p, 0), 1e-4) AS pr, greatest(COALESCE(cur.n / cur.t, 0), 1e-4) AS pc
              FROM months JOIN bins USING (feature) LEFT JOIN ref USING (feature, bin) LEFT JOIN cur USING (m, feature, bin)),
        psi AS (SELECT m, feature, SUM((pc - pr) * ln(pc / pr)) AS psi FROM s GROUP BY 1, 2)"""


@query(
    "drift_trend",
    f"""{_trend_sql()} SELECT feature, CAST(m AS DATE) AS report_date, round(psi + 1e-9, 6) AS psi,
        CASE WHEN psi < 0.1 THEN 'Stable' WHEN psi <= 0.2 THEN 'Warning' ELSE 'Alert' END AS status,
        round(psi - lag(psi) OVER (PARTITION BY feature ORDER BY m) + 1e-9, 6) AS change FROM psi""",
)
def _(spark, folder):
    reference, current = drift_sides(spark, folder)
    edges = drift.reference_edges(reference, DRIFT_FEATURES)
    month = F.date_trunc("month", "seen").cast("date").alias("report_date")
    monthly = drift.psi_from_counts(
        drift.bin_counts(reference, edges), drift.bin_counts(current, edges, month), "report_date"
    )
    # stored and read back as the dated JSON reports a dashboard would read
    path = scratch_path(spark, "drift")
    writers.write_drift_report(
        monthly.withColumns({"drifted": F.col("psi") >= 0.1, "ks": F.lit(None).cast("double")}), path
    )
    return rounded(drift.trend(readers.read_drift_reports(spark, path)), 6)


@query(
    "latest_drift_report",
    f"""{_trend_sql()} SELECT feature, round(psi + 1e-9, 6) AS psi, CAST(m AS DATE) AS report_date FROM psi
        WHERE m = (SELECT MAX(m) FROM psi)""",
)
def _(spark, folder):
    reference, current = drift_sides(spark, folder)
    edges = drift.reference_edges(reference, DRIFT_FEATURES)
    month = F.date_trunc("month", "seen").cast("date").alias("report_date")
    path = scratch_path(spark, "drift")
    writers.write_drift_report(
        drift.psi_from_counts(
            drift.bin_counts(reference, edges), drift.bin_counts(current, edges, month), "report_date"
        ),
        path,
    )
    newest = readers.latest_report(readers.read_drift_reports(spark, path))
    return rounded(newest.select("feature", "psi", "report_date"), 6)


@query(
    "drift_current",
    f"""{with_roles('predictions')} SELECT COUNT(*) AS n,
        COUNT(TRY_CAST(json_extract_string(request_payload, '$.application.DAYS_BIRTH') AS DOUBLE)) AS n_days,
        COUNT(TRY_CAST(json_extract_string(request_payload, '$.application.EXT_SOURCE_1') AS DOUBLE)) AS n_ext,
        CAST(SUM(TRY_CAST(json_extract_string(request_payload, '$.application.EXT_SOURCE_1') AS DOUBLE)) AS DOUBLE) AS sum_ext
        FROM predictions WHERE predicted_at >= TIMESTAMP '2024-01-30' - INTERVAL 7 DAYS""",
)
def _(spark, folder):
    recent = drift.recent_scores(role(spark, folder, "predictions"), datetime(2024, 1, 30))
    current = drift.payload_features(recent, ["DAYS_BIRTH", "EXT_SOURCE_1"])
    return current.agg(
        F.count(F.lit(1)).alias("n"), F.count("DAYS_BIRTH").alias("n_days"),
        F.count("EXT_SOURCE_1").alias("n_ext"), F.sum("EXT_SOURCE_1").alias("sum_ext"),
    )


@query(
    "drift_current_joined",
    f"""{with_roles('predictions', 'application')} SELECT COUNT(*) AS n, round(AVG(AMT_INCOME_TOTAL) + 1e-7, 4) AS mean_income
        FROM predictions p JOIN application a ON p.application_id = a.SK_ID_CURR
        WHERE predicted_at >= TIMESTAMP '2024-01-30' - INTERVAL 7 DAYS""",
)
def _(spark, folder):
    recent = drift.recent_scores(role(spark, folder, "predictions"), datetime(2024, 1, 30))
    rows = drift.current_features(recent, role(spark, folder, "application"), ID_COLUMN, ["AMT_INCOME_TOTAL"])
    income, n = F.col("AMT_INCOME_TOTAL"), F.col(drift.WEIGHT)
    return rounded(rows.agg(F.sum(n).alias("n"), (F.sum(income * n) / F.sum(F.when(income.isNotNull(), n))).alias("mean_income")))


@query(
    "drift_reference",
    f"""{with_roles('drift_rows')}, r AS (SELECT *, row_number() OVER (ORDER BY SK_ID_CURR) AS i, COUNT(*) OVER () AS n FROM drift_rows)
        SELECT round(AMT_INCOME_TOTAL + 1e-7, 4) AS AMT_INCOME_TOTAL, DAYS_BIRTH, round(EXT_SOURCE_1 + 1e-7, 4) AS EXT_SOURCE_1,
            round(EXT_SOURCE_2 + 1e-7, 4) AS EXT_SOURCE_2, round(EXT_SOURCE_3 + 1e-7, 4) AS EXT_SOURCE_3, bureau_loan_count, debt_to_credit_ratio
        FROM r WHERE i <= CAST(floor(n * 0.8e0) AS BIGINT)""",
)
def _(spark, folder):
    return rounded(drift.reference_rows(role(spark, folder, "drift_rows"), ID_COLUMN))


@query(
    "drift_metrics",
    f"""{_drift_sql()} SELECT 'run' AS run_id, 'drift_psi_' || feature AS metric, round(psi + 1e-9, 6) AS value FROM report
        UNION ALL SELECT 'run', 'drift_max_psi', round(MAX(psi) + 1e-9, 6) FROM report
        UNION ALL SELECT 'run', 'drift_any_detected', CAST(bool_or(drifted) AS DOUBLE) FROM report""",
)
def _(spark, folder):
    return rounded(drift.drift_metrics(drift_rows_report(spark, folder), "run"), 6)


# ---------------------------------------------------------------- governance

GATE_SQL = with_roles("runs", "run_metrics") + """,
wide AS (SELECT run_id, stage, MAX(value) FILTER (WHERE metric = 'auc_roc') AS auc_roc,
                MAX(value) FILTER (WHERE metric = 'disparate_impact_ratio') AS di
         FROM runs LEFT JOIN run_metrics USING (run_id) GROUP BY 1, 2),
gated AS (SELECT *, CASE WHEN auc_roc IS NULL THEN 'no evaluation metrics' WHEN auc_roc < 0.74e0 THEN 'AUC below floor'
                         WHEN di IS NULL OR isnan(di) OR di < 0.8e0 THEN 'disparate impact below 0.80' END AS problem FROM wide)
SELECT run_id, stage, CASE WHEN stage = 'production' THEN 'none' WHEN problem IS NOT NULL THEN '{blocked}' ELSE 'promote' END AS decision,
       CASE WHEN stage = 'production' THEN 'already production' WHEN problem IS NOT NULL THEN concat('{prefix}', problem)
            WHEN stage <> 'staging' THEN 'stage was not staging' ELSE 'all gates passed' END AS reason FROM gated"""


@query("promotion_gate", GATE_SQL.replace("{blocked}", "block").replace("{prefix}", ""))
def _(spark, folder):
    gate = governance.promotion_gate(
        role(spark, folder, "runs"), role(spark, folder, "run_metrics"), auc_floor=governance.AUC_FLOOR
    )
    return gate.select("run_id", "stage", "decision", "reason")


@query("promotion_gate_forced", GATE_SQL.replace("{blocked}", "promote").replace("{prefix}", "forced: "))
def _(spark, folder):
    gate = governance.promotion_gate(
        role(spark, folder, "runs"), role(spark, folder, "run_metrics"), True, governance.AUC_FLOOR
    )
    return gate.select("run_id", "stage", "decision", "reason")


@query(
    "stage_change",
    f"""{with_roles('runs')}, chosen AS (SELECT MIN(run_id) AS run_id FROM runs WHERE stage = 'staging')
        SELECT run_id, CASE WHEN run_id = (SELECT run_id FROM chosen) THEN 'production' WHEN stage = 'production' THEN 'archived'
               ELSE stage END AS stage, model_type,
               CASE WHEN run_id = (SELECT run_id FROM chosen) THEN TIMESTAMP '2024-07-15' END AS promoted_at FROM runs""",
)
def _(spark, folder):
    runs = role(spark, folder, "runs")
    chosen = runs.where("stage = 'staging'").agg(F.min("run_id")).first()[0]
    path = scratch_path(spark, "runs")
    governance.write_runs(runs, path)
    governance.write_runs(governance.change_stage(governance.read_runs(spark, path), chosen, F.lit(AS_OF)), path)
    return governance.read_runs(spark, path).select(
        "run_id", "stage", "model_type", F.col("promoted_at").cast("timestamp_ntz").alias("promoted_at")
    )


@query(
    "production_model",
    f"""{with_roles('runs')} SELECT run_id, model_type FROM runs WHERE stage = 'production' ORDER BY run_id DESC LIMIT 1""",
)
def _(spark, folder):
    return governance.production_run(role(spark, folder, "runs")).select("run_id", "model_type")


@query(
    "model_info",
    f"""{with_roles('runs', 'run_metrics')} SELECT substring(run_id, 1, 8) AS model_version, run_id, model_type,
        FALSE AS fair, feature_count, CAST(NULL AS TIMESTAMP) AS promoted_at,
        round((SELECT MAX(value) FROM run_metrics m WHERE m.run_id = runs.run_id AND metric = 'auc_roc') + 1e-7, 4) AS training_auc FROM runs""",
)
def _(spark, folder):
    runs = role(spark, folder, "runs").withColumn("group_thresholds", F.lit(None).cast("map<string,double>"))
    return rounded(governance.model_info(runs, role(spark, folder, "run_metrics")))


# ---------------------------------------------------------------- batch scoring and audit

PROBABILITY = "1e0 / (1e0 + exp(-(c_acctbal / 5000e0 - 1e0)))"


def score_customers(spark, folder, shift=0.0):
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("c_acctbal") / 5000.0 - 1.0 + shift)))
    return table(spark, folder, "customer").select("c_custkey", p.alias("p"))


@query(
    "batch_ingest",
    f"""SELECT c_custkey AS application_id, round({PROBABILITY} + 1e-9, 6) AS default_probability,
        CASE WHEN {PROBABILITY} < 0.3e0 THEN 'LOW' WHEN {PROBABILITY} <= 0.6e0 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_tier,
        '[]' AS top_shap_features, 'abcdef01' AS model_version, FALSE AS cached,
        '{{"source":"batch_ingest"}}' AS request_payload, 'batch_ingest' AS source FROM customer
        UNION ALL
        SELECT c_custkey, round(0.5e0 + c_acctbal / 1e6 + 1e-9, 6), 'MEDIUM', '[]', 'abcdef01', FALSE, '{{"source":"api"}}', 'api' FROM customer""",
)
def _(spark, folder):
    path = scratch_path(spark, "audit")
    run_id = F.lit("abcdef0123456789")
    at = F.lit(datetime(2024, 1, 30))
    api = table(spark, folder, "customer").select("c_custkey", (F.lit(0.5) + F.col("c_acctbal") / 1e6).alias("p"))
    writers.append_audit(writers.audit_rows(api, "c_custkey", F.col("p"), run_id, at, "api"), path, "api", "first")
    # an older run of table-wide scoring, then the one that must replace it and nothing else
    stale = writers.audit_rows(score_customers(spark, folder, 0.7), "c_custkey", F.col("p"), run_id, F.lit(datetime(2024, 1, 1)))
    writers.replace_source(stale, path)
    fresh = writers.audit_rows(score_customers(spark, folder), "c_custkey", F.col("p"), run_id, at)
    writers.replace_source(fresh, path)
    kept = readers.read_audit(spark, path).drop("id", "load", "predicted_at", "predicted_date")
    return rounded(kept, 6)


BULK = datetime(2024, 1, 15)
BULK_SQL = f"""audit AS (
    SELECT user_id AS application_id, value / 500e0 AS default_probability, ts AS predicted_at, 'api' AS source, '' AS id FROM events
    UNION ALL SELECT c_custkey, {PROBABILITY}, TIMESTAMP '2024-01-15', 'batch_ingest', concat('batch_ingest:', c_custkey, ':2024-01-15 00:00:00') FROM customer),
  tiered AS (SELECT *, CASE WHEN default_probability < 0.3e0 THEN 'LOW' WHEN default_probability <= 0.6e0 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_tier FROM audit)"""
AUDIT_PAGE_SQL = "application_id, round(default_probability + 1e-9, 6) AS default_probability, risk_tier, predicted_at, source"


def written_audit(spark, folder):
    """An audit table as the jobs leave it: three loads of single scores, and everyone scored at one moment, twice."""
    audit = AuditTable(spark, scratch_path(spark, "audit"))
    run_id = F.lit("abcdef0123456789")
    events = table(spark, folder, "events")
    for i in range(BATCHES):
        part = events.where(F.col("event_id") % BATCHES == i)
        rows = writers.audit_rows(part, "user_id", F.col("value") / 500.0, run_id, F.col("ts"), online.API_SOURCE, payload=F.concat_ws(":", "event_id", "props"))
        audit.append(rows, online.API_SOURCE, f"stream-{i}")
    for shift in (0.7, 0.0):
        audit.replace(writers.audit_rows(score_customers(spark, folder, shift), "c_custkey", F.col("p"), run_id, F.lit(BULK)), writers.BATCH_SOURCE)
    return audit


def audit_columns(page):
    return rounded(page.withColumn("predicted_at", F.col("predicted_at").cast("timestamp_ntz")), 6)


PAGE_OF_AUDIT = ["application_id", "default_probability", "risk_tier", "predicted_at", "source"]


@query(
    "audit_deep_page",
    f"""WITH {BULK_SQL}, ranked AS (SELECT *, row_number() OVER (ORDER BY predicted_at DESC, id) AS place FROM tiered),
        start AS (SELECT COUNT(*) + 40 AS skipped FROM events WHERE ts > TIMESTAMP '2024-01-15')
        SELECT {AUDIT_PAGE_SQL} FROM ranked, start WHERE place > skipped AND place <= skipped + 100""",
)
def _(spark, folder):
    """A page deep in a bulk load, whose rows share one time and differ in their text ids only."""
    audit = written_audit(spark, folder)
    newer = table(spark, folder, "events").where(F.col("ts") > F.lit(BULK)).count()
    return audit_columns(portfolio.audit_page(audit, "all", AS_OF, 100, newer + 40, columns=PAGE_OF_AUDIT))


@query(
    "audit_flagged_page",
    f"""WITH {BULK_SQL} SELECT {AUDIT_PAGE_SQL} FROM tiered WHERE risk_tier = 'HIGH' AND predicted_at >= TIMESTAMP '2024-07-15' - INTERVAL 6 MONTH
        ORDER BY predicted_at DESC, id LIMIT 50 OFFSET 25""",
)
def _(spark, folder):
    return audit_columns(portfolio.audit_page(written_audit(spark, folder), "6m", AS_OF, 50, 25, "HIGH", PAGE_OF_AUDIT))


@query(
    "audit_totals",
    f"""WITH {BULK_SQL} SELECT '6m' AS period, COUNT(*) AS total FROM tiered WHERE predicted_at >= TIMESTAMP '2024-07-15' - INTERVAL 6 MONTH
        UNION ALL SELECT 'all', COUNT(*) FROM tiered WHERE risk_tier = 'HIGH'""",
)
def _(spark, folder):
    audit = written_audit(spark, folder)
    return portfolio.audit_total(audit, "6m", AS_OF).unionByName(portfolio.audit_total(audit, "all", AS_OF, "HIGH"))


@query(
    "audit_compaction",
    f"""WITH {BULK_SQL} SELECT source, risk_tier, COUNT(*) AS n, round(SUM(default_probability) + 1e-7, 4) AS total, MIN(predicted_at) AS oldest,
        MAX(predicted_at) AS newest FROM tiered GROUP BY ALL""",
)
def _(spark, folder):
    """Small files of earlier loads merged; every row is still there, once."""
    audit = written_audit(spark, folder)
    audit.compact()
    found = audit.read().groupBy("source", "risk_tier").agg(
        F.count(F.lit(1)).alias("n"), F.sum("default_probability").alias("total"),
        F.min("predicted_at").cast("timestamp_ntz").alias("oldest"), F.max("predicted_at").cast("timestamp_ntz").alias("newest"),
    )
    return rounded(found)


# ---------------------------------------------------------------- streams


BATCHES = 3
#: Events in a file of an arriving batch, about.
EVENTS_PER_FILE = 100_000


def arriving_events(spark, folder, late=False):
    """The events as a folder of files in the order of their time, and the stream that reads a third of them per batch.

    With ``late`` some early events of the first batch come in the last one only. All batches have the same number of files, so that a count of
    files is a batch: events dealt round by round leave none of them empty when there are so many for each.
    """
    events = table(spark, folder, "events")
    path = scratch_path(spark, "arriving")
    span = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    cuts = [span["a"] + (span["b"] - span["a"]) * i / BATCHES for i in range(1, BATCHES)]
    number = sum((F.when(F.col("ts") >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    if late:
        early = F.col("ts") < F.lit(span["a"] + (span["b"] - span["a"]) / 6)
        number = F.when(early & (F.col("event_id") % 97 == 0), BATCHES - 1).otherwise(number)
    batches = [events.where(number == i) for i in range(BATCHES)]
    sizes = {r["i"]: r["count"] for r in events.groupBy(number.alias("i")).count().collect()}
    files = max(1, min(sizes.get(i, 0) for i in range(BATCHES)) // EVENTS_PER_FILE)
    for batch in batches:
        (batch.repartition(files) if files > 1 else batch.coalesce(1)).write.mode("append").parquet(path)
    return online.read_table_stream(spark, path, events.schema, files_per_batch=files)


def score_stream(spark, folder):
    return arriving_events(spark, folder).select(
        F.col("event_id").alias("id"), F.col("user_id").alias("application_id"),
        (F.col("value") / 500.0).alias("default_probability"), F.col("ts").cast("timestamp").alias("predicted_at"),
        F.concat_ws(":", F.lit("prediction"), "user_id", "event_type").alias("key"),
    )


@query(
    "stream_score_dedup",
    """WITH RECURSIVE e AS (SELECT event_id, ts, concat('prediction:', user_id, ':', event_type) AS key,
           CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events),
       d AS (SELECT key, s FROM e GROUP BY 1, 2),
       nxt AS (SELECT key, s, MIN(s) OVER (PARTITION BY key ORDER BY s
                 RANGE BETWEEN 3600 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM d),
       kept AS (SELECT key, MIN(s) AS s FROM d GROUP BY 1
                UNION ALL SELECT nxt.key, nxt.nxt FROM kept JOIN nxt USING (key, s) WHERE nxt.nxt IS NOT NULL),
       first AS (SELECT key, s, MIN((ts, event_id)) AS f FROM e GROUP BY 1, 2)
       SELECT f[2] AS id, key, f[1] AS predicted_at FROM first JOIN kept USING (key, s)""",
)
def _(spark, folder):
    scores = score_stream(spark, folder).select("id", "key", "predicted_at")
    answered = online.drain(rows_to_answer(scores, "key", "predicted_at", "id", online.CACHE_SECONDS))
    return answered.withColumn("predicted_at", F.col("predicted_at").cast("timestamp_ntz"))


#: A request per event. It depends on the user, the event's type and a number below 7 only, so requests repeat.
REQUEST = """to_json(named_struct(
    'application', named_struct('SK_ID_CURR', user_id, 'NAME_INCOME_TYPE', event_type, 'DAYS_BIRTH', -9000 - 500 * (event_id % 7),
        'AMT_INCOME_TOTAL', CASE WHEN user_id % 4 > 0 THEN 1000D * (event_id % 7) END, 'FLAG_OWN_CAR', CASE WHEN user_id % 2 = 0 THEN 'Y' END),
    'bureau', transform(sequence(1, 1 + CAST(event_id % 3 AS INT)), i -> named_struct('SK_ID_BUREAU', i, 'CREDIT_TYPE', CASE WHEN i > 1 THEN event_type END,
        'CREDIT_ACTIVE', CASE WHEN i = 1 THEN 'Active' ELSE 'Closed' END, 'AMT_CREDIT_SUM', 100D * (event_id % 7 + i),
        'AMT_CREDIT_SUM_DEBT', CASE WHEN i < 3 THEN 50D * (event_id % 7) END, 'DAYS_CREDIT', -30 * i)),
    'bureau_balance', transform(sequence(0, CAST(event_id % 7 AS INT)), i -> named_struct('SK_ID_BUREAU', 1 + i % 2, 'MONTHS_BALANCE', -i, 'STATUS', substring('CX0123', 1 + i % 6, 1))),
    'previous_applications', CASE WHEN event_id % 7 > 1 THEN transform(sequence(1, CAST(event_id % 7 AS INT)), i -> named_struct('SK_ID_PREV', i,
        'NAME_CONTRACT_STATUS', CASE WHEN i % 2 = 0 THEN 'Refused' ELSE 'Approved' END, 'DAYS_DECISION', -10 * (i % 3), 'AMT_CREDIT', 10D * i)) END,
    'installments', CASE WHEN event_id % 7 < 6 THEN transform(sequence(1, 3), i -> named_struct('AMT_INSTALMENT', 10D * i, 'AMT_PAYMENT', CASE WHEN i < 3 THEN 9D * i + event_id % 7 END,
        'DAYS_INSTALMENT', -30D, 'DAYS_ENTRY_PAYMENT', -35D + i)) END,
    'credit_card', CASE WHEN event_id % 7 < 4 THEN transform(sequence(1, 4), i -> named_struct('SK_ID_PREV', i, 'MONTHS_BALANCE', -(i % 2), 'AMT_BALANCE', CASE WHEN i < 4 THEN 5D * i END,
        'AMT_CREDIT_LIMIT_ACTUAL', 100D)) END))"""


def scores_by_tables(spark, documents, explainer):
    """Scores of request documents (key, text) by the operators of the table build, over one table per child list."""
    parsed = documents.withColumn("request", F.from_json("text", request_schema()))
    lists = {
        name: parsed.select("key", F.explode(f"request.{name}").alias("c")).select("key", *[f"c.{n}" for n in raw_schema(t).names if n != ID_COLUMN])
        for name, t in REQUEST_LISTS.items()
    }
    loan = F.concat_ws(":", "key", "SK_ID_BUREAU")
    months = features.loan_month_features(lists["bureau_balance"].withColumn("loan", loan), "loan")
    histories = [
        features.bureau_features(lists["bureau"].withColumn("loan", loan), months, "key", "loan"),
        features.installment_features(lists["installments"], "key"),
        features.credit_card_features(lists["credit_card"], "key"),
        features.pos_features(lists["pos_cash"], "key"),
        features.previous_application_features(lists["previous_applications"], "key"),
    ]
    base = impute.apply_imputer(parsed.select("key", "request.application.*"), explainer.imputer)
    wide = features.fill_joined_nulls(features.star_join(base, *histories, key="key"), skip=("key", ID_COLUMN))
    return explainer.score(wide, ["key"]).select("key", F.col("score").alias("table_score"))


@query(
    "stream_requests",
    """WITH RECURSIVE e AS (SELECT user_id, event_type, event_id % 7 AS v, event_id % 3 AS u, CAST(floor(epoch(ts)) AS BIGINT) AS s, ts,
           concat(user_id, ':', event_type, ':', event_id % 7, ':', event_id % 3) AS key FROM events),
       d AS (SELECT key, s FROM e GROUP BY 1, 2),
       nxt AS (SELECT key, s, MIN(s) OVER (PARTITION BY key ORDER BY s
                 RANGE BETWEEN 3600 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM d),
       kept AS (SELECT key, MIN(s) AS s FROM d GROUP BY 1
                UNION ALL SELECT nxt.key, nxt.nxt FROM kept JOIN nxt USING (key, s) WHERE nxt.nxt IS NOT NULL),
       first AS (SELECT key, s, MIN(ts) AS ts, ANY_VALUE(user_id) AS user_id FROM e GROUP BY 1, 2)
       SELECT user_id AS application_id, ts AS predicted_at, 'api' AS source, 10 AS n_reasons, TRUE AS add_up, TRUE AS described, TRUE AS as_by_tables,
              TRUE AS tier_fits FROM first JOIN kept USING (key, s)""",
)
def _(spark, folder):
    """Every event as a scoring request, answered by the serving job with the production model.

    Each stored score must be the one that the same documents get from the table operators and a scored table.
    """
    registry, audit = registered_model(spark, folder), scratch_path(spark, "audit")
    requests = arriving_events(spark, folder).select(F.expr(REQUEST).alias("text"), F.col("ts").cast("timestamp").alias("received_at"))
    lifecycle.serve(spark, registry, requests, audit, scratch_path(spark, "offsets"))
    explainer = lifecycle.Explainer(*lifecycle.load_run(spark, registry))
    text = F.get_json_object("request_payload", "$.text")
    rows = readers.read_audit(spark, audit).withColumns({"text": text, "key": F.sha2(text, 256)})
    documents = rows.groupBy("key").agg(F.first("text").alias("text"))
    joined = reasons(rows, attribution.base_margin(explainer.leaves)).join(scores_by_tables(spark, documents, explainer), "key")
    return joined.select(
        "application_id", F.col("predicted_at").cast("timestamp_ntz").alias("predicted_at"), "source", "n_reasons", "add_up", "described",
        (F.abs(F.col("default_probability") - F.col("table_score")) < 1e-9).alias("as_by_tables"),
        (F.col("risk_tier") == risk_tier(F.col("table_score"))).alias("tier_fits"),
    )


@query(
    "stream_replay",
    """WITH RECURSIVE e AS (SELECT user_id, event_type, event_id % 7 AS v, CAST(floor(epoch(ts)) AS BIGINT) AS s, ts,
           concat(user_id, ':', event_type, ':', event_id % 7) AS key FROM events),
       d AS (SELECT key, s FROM e GROUP BY 1, 2),
       nxt AS (SELECT key, s, MIN(s) OVER (PARTITION BY key ORDER BY s
                 RANGE BETWEEN 3600 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM d),
       kept AS (SELECT key, MIN(s) AS s FROM d GROUP BY 1
                UNION ALL SELECT nxt.key, nxt.nxt FROM kept JOIN nxt USING (key, s) WHERE nxt.nxt IS NOT NULL),
       first AS (SELECT key, s, MIN(ts) AS ts, ANY_VALUE(user_id) AS user_id, ANY_VALUE(v) AS v FROM e GROUP BY 1, 2),
       scored AS (SELECT user_id, ts, 0.4e0 + (50e0 * v) / (100e0 * (v + 1) + 1e-5) - 0.1e0 AS p FROM first JOIN kept USING (key, s))
       SELECT user_id AS application_id, round(p + 1e-9, 6) AS default_probability,
              CASE WHEN p < 0.3e0 THEN 'LOW' WHEN p <= 0.6e0 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_tier,
              'stream01' AS model_version, ts AS predicted_at, 'api' AS source FROM scored""",
)
def _(spark, folder):
    """Every batch of requests is answered twice, as after a failure between the write and the commit; its rows are there once."""
    text = F.expr(
        """to_json(named_struct('application', named_struct('SK_ID_CURR', user_id, 'NAME_TYPE_SUITE', event_type),
           'bureau', array(named_struct('SK_ID_BUREAU', event_id % 7, 'AMT_CREDIT_SUM', 100D * (event_id % 7 + 1),
           'AMT_CREDIT_SUM_DEBT', 50D * (event_id % 7)))))"""
    )
    requests = arriving_events(spark, folder).select(text.alias("text"), F.col("ts").cast("timestamp").alias("received_at"))
    audit = scratch_path(spark, "audit")
    parsed = online.RequestFeatures(impute.ImputeProfile(scores={"EXT_SOURCE_1": 0.4}))

    def score(df):
        return df.withColumn("score", F.col("EXT_SOURCE_1") + F.col("debt_to_credit_ratio") - F.lit(0.1))

    def twice(batch, number):
        for _ in range(2):
            online.answer_batch(batch, number, audit, parsed, score, "stream0123456789")

    online.run_to_end(online.fresh_requests(requests), twice)
    rows = readers.read_audit(spark, audit).withColumn("predicted_at", F.col("predicted_at").cast("timestamp_ntz"))
    return rounded(
        rows.select("application_id", "default_probability", "risk_tier", "model_version", "predicted_at", "source"), 6
    )


@query(
    "stream_daily",
    """SELECT date, n, round(avg_probability + 1e-7, 4) AS avg_probability FROM (
         SELECT CAST(ts AS DATE) AS date, COUNT(*) AS n, AVG(value / 500e0) AS avg_probability FROM events GROUP BY 1)
       WHERE date + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR""",
)
def _(spark, folder):
    return rounded(online.drain(online.daily_means(score_stream(spark, folder))))


@query(
    "stream_drift",
    """WITH e AS (SELECT ts, value AS v, event_id % 97 = 0 AND epoch_us(ts) < (SELECT MIN(epoch_us(ts)) + (MAX(epoch_us(ts)) - MIN(epoch_us(ts))) / 6 FROM events) AS late FROM events),
       q AS (SELECT list_value("""
    + ", ".join(f"quantile_cont(v, 0.{i})" for i in range(1, 10))
    + """) AS cuts FROM e),
       binned AS (SELECT ts, late, len(list_filter(cuts, lambda x: v > x)) AS bin FROM e, q),
       days AS (SELECT CAST(unnest(generate_series(MIN(CAST(ts AS DATE)) + INTERVAL 1 DAY, MAX(CAST(ts AS DATE)) + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS TIMESTAMP) AS w FROM e),
       h AS (SELECT w AS window_end, bin, COUNT(*) AS n FROM days JOIN binned ON NOT late AND ts < w AND ts >= w - INTERVAL 7 DAY
             WHERE w <= (SELECT MAX(ts) FROM e) - INTERVAL 1 HOUR GROUP BY 1, 2),
       ref AS (SELECT bin, COUNT(*) / (SELECT COUNT(*) FROM binned) AS p FROM binned GROUP BY 1),
       t AS (SELECT window_end, SUM(n) AS t FROM h GROUP BY 1),
       s AS (SELECT t.window_end, greatest(ref.p, 1e-4) AS pr, greatest(COALESCE(h.n / t.t, 0), 1e-4) AS pc
             FROM t JOIN ref ON TRUE LEFT JOIN h ON h.window_end = t.window_end AND h.bin = ref.bin)
       SELECT window_end, round(SUM((pc - pr) * ln(pc / pr)) + 1e-9, 6) AS psi FROM s GROUP BY 1""",
)
def _(spark, folder):
    events = table(spark, folder, "events").select("value")
    edges = drift.reference_edges(events, ["value"])
    stream = arriving_events(spark, folder, late=True)
    timed = stream.select("value", F.col("ts").cast("timestamp").alias("ts"))
    counts = online.drain(online.lookback_histograms(timed, edges, "ts"))
    psi = drift.psi_from_counts(drift.bin_counts(events, edges), counts, "window_end")
    return rounded(psi.select(F.col("window_end").cast("timestamp_ntz").alias("window_end"), "psi"), 6)
