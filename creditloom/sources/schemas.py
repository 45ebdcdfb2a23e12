"""Schemas of the raw tables, request documents and stored outputs."""

from __future__ import annotations

from pyspark.sql import types as T

from creditloom.functions.registry import ID_COLUMN, LABEL_COLUMN, feature_rows

# fixed values: raw tables and the types of their columns, as Spark DDL
RAW_TABLES = {
    "bureau": """
        SK_ID_CURR BIGINT,
        SK_ID_BUREAU BIGINT,
        CREDIT_ACTIVE STRING,
        CREDIT_CURRENCY STRING,
        DAYS_CREDIT BIGINT,
        CREDIT_DAY_OVERDUE BIGINT,
        DAYS_CREDIT_ENDDATE DOUBLE,
        DAYS_ENDDATE_FACT DOUBLE,
        AMT_CREDIT_MAX_OVERDUE DOUBLE,
        AMT_CREDIT_SUM DOUBLE,
        AMT_CREDIT_SUM_DEBT DOUBLE,
        AMT_CREDIT_SUM_LIMIT DOUBLE,
        AMT_CREDIT_SUM_OVERDUE DOUBLE,
        CREDIT_TYPE STRING,
        DAYS_CREDIT_UPDATE BIGINT,
        AMT_ANNUITY DOUBLE,
        CNT_CREDIT_PROLONG BIGINT
    """,
    "bureau_balance": """
        SK_ID_BUREAU BIGINT,
        MONTHS_BALANCE BIGINT,
        STATUS STRING
    """,
    "previous_application": """
        SK_ID_CURR BIGINT,
        SK_ID_PREV BIGINT,
        NAME_CONTRACT_STATUS STRING,
        DAYS_DECISION BIGINT,
        AMT_APPLICATION DOUBLE,
        AMT_CREDIT DOUBLE,
        AMT_ANNUITY DOUBLE,
        RATE_DOWN_PAYMENT DOUBLE,
        CNT_PAYMENT DOUBLE
    """,
    "POS_CASH_balance": """
        SK_ID_CURR BIGINT,
        SK_ID_PREV BIGINT,
        MONTHS_BALANCE BIGINT,
        CNT_INSTALMENT DOUBLE,
        CNT_INSTALMENT_FUTURE DOUBLE,
        NAME_CONTRACT_STATUS STRING,
        SK_DPD BIGINT,
        SK_DPD_DEF BIGINT
    """,
    "installments_payments": """
        SK_ID_CURR BIGINT,
        SK_ID_PREV BIGINT,
        NUM_INSTALMENT_VERSION DOUBLE,
        NUM_INSTALMENT_NUMBER DOUBLE,
        DAYS_INSTALMENT DOUBLE,
        DAYS_ENTRY_PAYMENT DOUBLE,
        AMT_INSTALMENT DOUBLE,
        AMT_PAYMENT DOUBLE
    """,
    "credit_card_balance": """
        SK_ID_CURR BIGINT,
        SK_ID_PREV BIGINT,
        MONTHS_BALANCE BIGINT,
        AMT_BALANCE DOUBLE,
        AMT_CREDIT_LIMIT_ACTUAL DOUBLE,
        AMT_DRAWINGS_ATM_CURRENT DOUBLE,
        AMT_DRAWINGS_CURRENT DOUBLE,
        CNT_DRAWINGS_CURRENT DOUBLE,
        AMT_INST_MIN_REGULARITY DOUBLE,
        AMT_PAYMENT_CURRENT DOUBLE,
        AMT_TOTAL_RECEIVABLE DOUBLE,
        SK_DPD BIGINT,
        SK_DPD_DEF BIGINT
    """,
}


def application_schema(with_label: bool = True) -> T.StructType:
    """Application columns from the registry: text for categories and yes/no flags, numbers else."""
    fields = [T.StructField(ID_COLUMN, T.LongType())]
    if with_label:
        fields.append(T.StructField(LABEL_COLUMN, T.IntegerType()))
    for f in feature_rows():
        if f.group != "application" or f.name.startswith("MISSING_"):
            continue
        text = f.kind == "categorical" or f.name in ("FLAG_OWN_CAR", "FLAG_OWN_REALTY")
        fields.append(T.StructField(f.name, T.StringType() if text else T.DoubleType()))
    return T.StructType(fields)


def raw_schema(table: str) -> T.StructType:
    if table.startswith("application"):
        return application_schema(with_label=not table.endswith("test"))
    return T.StructType.fromDDL(RAW_TABLES[table])


# fixed values: child lists of a scoring request and the raw table each one follows
REQUEST_LISTS = {
    "bureau": "bureau",
    "bureau_balance": "bureau_balance",
    "previous_applications": "previous_application",
    "pos_cash": "POS_CASH_balance",
    "installments": "installments_payments",
    "credit_card": "credit_card_balance",
}


def request_schema() -> T.StructType:
    """One application with its child lists; only the applicant id is required."""
    fields = [T.StructField("application", application_schema(with_label=False))]
    for name, table in REQUEST_LISTS.items():
        fields.append(T.StructField(name, T.ArrayType(raw_schema(table))))
    return T.StructType(fields)


ATTRIBUTION = T.ArrayType(
    T.StructType(
        [
            T.StructField("feature_name", T.StringType()),
            T.StructField("shap_value", T.DoubleType()),
            T.StructField("feature_value", T.DoubleType()),
            T.StructField("description", T.StringType()),
        ]
    )
)

# the audit table; ``source``, ``load`` and ``predicted_date`` are its partition columns
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("application_id", T.LongType(), False),
        T.StructField("default_probability", T.DoubleType(), False),
        T.StructField("risk_tier", T.StringType(), False),
        T.StructField("top_shap_features", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("predicted_at", T.TimestampType()),
        T.StructField("cached", T.BooleanType()),
        T.StructField("request_payload", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("load", T.StringType()),
        T.StructField("predicted_date", T.DateType()),
    ]
)

MODEL_RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("stage", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("feature_count", T.IntegerType()),
        T.StructField("params", T.StringType()),
        T.StructField("group_thresholds", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("promoted_at", T.TimestampType()),
    ]
)

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("metric", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
    ]
)

DRIFT_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("psi", T.DoubleType()),
        T.StructField("ks", T.DoubleType()),
        T.StructField("drifted", T.BooleanType()),
        T.StructField("status", T.StringType()),
        T.StructField("n_reference", T.LongType()),
        T.StructField("n_current", T.LongType()),
        T.StructField("lookback_days", T.IntegerType()),
        T.StructField("report_date", T.DateType()),
    ]
)
