"""The given tables in the parts the lending data plays: applications, loans, scores, runs.

Each part is one SELECT that Spark and the checking engine both understand; only the day
difference, the text type and the quoting of an infinity differ and are filled in per dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# columns of the given tables, so that no job has to look into the files for them
TABLE_COLUMNS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}
TABLES = tuple(TABLE_COLUMNS)

DIALECTS = {
    "spark": {"days": "datediff({b}, {a})", "text": "STRING", "nan": "double('NaN')"},
    "duckdb": {
        "days": "CAST(date_diff('day', {a}, {b}) AS INT)",
        "text": "VARCHAR",
        "nan": "CAST('NaN' AS DOUBLE)",
    },
}

ROLE_SQL = {
    "application": """
        SELECT c_custkey AS SK_ID_CURR,
               CASE WHEN (c_custkey * 7919) % 100 < 8 THEN 1 ELSE 0 END AS TARGET,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS EXT_SOURCE_1,
               CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal / 10000e0 END AS EXT_SOURCE_2,
               CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS NAME_INCOME_TYPE,
               CASE WHEN c_custkey % 4 <> 0 THEN NULL ELSE c_acctbal END AS COMMONAREA_AVG,
               CASE WHEN c_nationkey % 2 = 0 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
               CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_nationkey % 3 = 0 THEN 'Y' ELSE 'N' END
                   AS FLAG_OWN_REALTY,
               CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 20 AS DOUBLE) END AS OWN_CAR_AGE,
               CAST(-(7000 + (c_custkey * 37) % 18000) AS INT) AS DAYS_BIRTH,
               c_acctbal AS AMT_INCOME_TOTAL
        FROM {customer}""",
    "bureau": """
        SELECT o_orderkey AS SK_ID_BUREAU, o_custkey AS SK_ID_CURR,
               CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Closed' END AS CREDIT_ACTIVE,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS CREDIT_TYPE,
               {days:DATE '2002-01-01'|CAST(o_orderdate AS DATE)} AS DAYS_CREDIT,
               o_totalprice AS AMT_CREDIT_SUM,
               CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice * 0.25e0 END AS AMT_CREDIT_SUM_DEBT,
               CASE WHEN o_orderkey % 17 = 0 THEN o_totalprice * 0.01e0 ELSE 0e0 END AS AMT_CREDIT_SUM_OVERDUE,
               CAST(o_orderkey % 30 AS BIGINT) AS CREDIT_DAY_OVERDUE,
               CAST(o_orderkey % 3 AS BIGINT) AS CNT_CREDIT_PROLONG
        FROM {orders}""",
    "bureau_balance": """
        SELECT l_orderkey AS SK_ID_BUREAU, CAST(-(l_partkey % 24) AS INT) AS MONTHS_BALANCE,
               CASE WHEN l_partkey % 8 = 0 THEN 'C' WHEN l_partkey % 8 = 1 THEN 'X'
                    WHEN l_partkey % 97 = 2 THEN NULL ELSE CAST(l_partkey % 8 - 2 AS {text}) END AS STATUS
        FROM {lineitem}""",
    "installments": """
        SELECT o.o_custkey AS SK_ID_CURR, l.l_extendedprice AS AMT_INSTALMENT,
               CASE WHEN l.l_partkey % 50 = 0 THEN NULL
                    ELSE l.l_extendedprice * (1 + l.l_tax - l.l_discount) END AS AMT_PAYMENT,
               CAST(60 AS DOUBLE) AS DAYS_INSTALMENT,
               CAST({days:CAST(o.o_orderdate AS DATE)|CAST(l.l_shipdate AS DATE)} AS DOUBLE) AS DAYS_ENTRY_PAYMENT
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "credit_card": """
        SELECT user_id AS SK_ID_CURR, event_id AS SK_ID_PREV, CAST(-(event_id % 40) AS INT) AS MONTHS_BALANCE,
               CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS AMT_BALANCE,
               value * 2e0 AS AMT_CREDIT_LIMIT_ACTUAL,
               CASE WHEN event_id % 4 = 0 THEN NULL ELSE value * 0.5e0 END AS AMT_DRAWINGS_CURRENT,
               value * 0.2e0 AS AMT_DRAWINGS_ATM_CURRENT,
               CAST(event_id % 5 AS DOUBLE) AS CNT_DRAWINGS_CURRENT,
               value * 0.05e0 AS AMT_INST_MIN_REGULARITY,
               CASE WHEN event_id % 7 = 0 THEN NULL ELSE value * 0.1e0 END AS AMT_PAYMENT_CURRENT,
               value * 1.1e0 AS AMT_TOTAL_RECEIVABLE,
               CAST(event_id % 6 - 3 AS BIGINT) AS SK_DPD,
               CAST(event_id % 6 - 4 AS BIGINT) AS SK_DPD_DEF
        FROM {events}""",
    "pos": """
        SELECT user_id AS SK_ID_CURR, event_id AS SK_ID_PREV, CAST(-(event_id % 40) AS INT) AS MONTHS_BALANCE,
               CAST(6 + event_id % 30 AS DOUBLE) AS CNT_INSTALMENT,
               CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(event_id % 25 AS DOUBLE) END AS CNT_INSTALMENT_FUTURE,
               CAST(event_id % 6 - 3 AS BIGINT) AS SK_DPD,
               CAST(event_id % 6 - 4 AS BIGINT) AS SK_DPD_DEF
        FROM {events}""",
    "previous": """
        SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
               CASE WHEN o_orderkey % 11 = 0 THEN 'Unused offer' WHEN o_orderstatus = 'F' THEN 'Approved'
                    WHEN o_orderstatus = 'O' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
               {days:DATE '2002-01-01'|CAST(o_orderdate AS DATE)} AS DAYS_DECISION,
               o_totalprice AS AMT_APPLICATION, o_totalprice * 0.9e0 AS AMT_CREDIT,
               CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice / 12e0 END AS AMT_ANNUITY,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_orderkey % 40) / 100e0 END AS RATE_DOWN_PAYMENT,
               CAST(6 + o_orderkey % 48 AS DOUBLE) AS CNT_PAYMENT
        FROM {orders}""",
    "predictions": """
        SELECT event_id AS id, user_id AS application_id, value / 500e0 AS default_probability,
               CASE WHEN value / 500e0 < 0.3e0 THEN 'LOW' WHEN value / 500e0 <= 0.6e0 THEN 'MEDIUM'
                    ELSE 'HIGH' END AS risk_tier,
               substring(md5(event_type), 1, 8) AS model_version, ts AS predicted_at,
               event_id % 10 = 0 AS cached,
               CASE WHEN event_id % 4 = 0 THEN 'batch_ingest' ELSE 'api' END AS source,
               CASE WHEN event_id % 4 = 0 THEN '{{"source": "batch_ingest"}}'
                    WHEN event_id % 5 = 0 THEN concat('{{"source": "api", "application": {{"DAYS_BIRTH": "unknown", "EXT_SOURCE_1": ', CAST(event_id % 90 AS {text}), '}}}}')
                    ELSE concat('{{"source": "api", "application": {{"DAYS_BIRTH": ', CAST(-(7000 + event_id % 18000) AS {text}),
                                ', "EXT_SOURCE_1": ', CAST(event_id % 97 AS {text}), ', "EXTRA": "x"}}}}') END AS request_payload,
               props
        FROM {events}""",
    "scored": """
        SELECT o_orderkey AS id, CASE WHEN (o_orderkey * 7919) % 100 < 8 THEN 1 ELSE 0 END AS y,
               CAST((o_orderkey * 104729) % 1000 AS DOUBLE) / 1000e0 AS score,
               (CAST((o_orderkey * 104729) % 1000 AS DOUBLE) / 1000e0
                + CASE WHEN (o_orderkey * 7919) % 100 < 8 THEN 0.25e0 ELSE 0e0 END) / 1.25e0 AS score_b,
               -(7000 + (o_orderkey * 37) % 18000) AS days_birth
        FROM {orders}""",
    "drift_rows": """
        SELECT o_orderkey AS SK_ID_CURR, o_totalprice AS AMT_INCOME_TOTAL,
               CAST(-(7000 + (o_orderkey * 37) % 18000) AS DOUBLE) AS DAYS_BIRTH,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE (o_totalprice / 1000e0) END AS EXT_SOURCE_1,
               (o_orderkey * 7919 % 1000) / 1000e0 * CASE WHEN o_orderdate < DATE '2000-01-01' THEN 1e0 ELSE 0.7e0 END AS EXT_SOURCE_2,
               (o_orderkey * 104729 % 1000) / 1000e0 + CASE WHEN o_orderdate < DATE '2000-01-01' THEN 0e0 ELSE 0.12e0 END AS EXT_SOURCE_3,
               CAST(o_orderkey % 12 AS DOUBLE) AS bureau_loan_count,
               CASE WHEN o_orderdate < DATE '2000-01-01' THEN (o_orderkey % 90) / 100e0 END AS debt_to_credit_ratio,
               CAST(o_orderdate AS DATE) AS seen
        FROM {orders}""",
    "runs": """
        SELECT md5(s_name) AS run_id,
               CASE WHEN s_suppkey % 5 = 0 THEN 'production' WHEN s_suppkey % 5 = 2 THEN 'archived'
                    ELSE 'staging' END AS stage,
               CASE WHEN s_suppkey % 2 = 0 THEN 'gbt' ELSE 'logistic' END AS model_type,
               CAST(185 AS INT) AS feature_count,
               CAST(NULL AS TIMESTAMP) AS promoted_at
        FROM {supplier}""",
    "run_metrics": """
        SELECT md5(s_name) AS run_id, 'auc_roc' AS metric, 0.6e0 + ((s_suppkey * 37) % 30) / 100e0 AS value
        FROM {supplier} WHERE s_suppkey % 13 <> 0
        UNION ALL
        SELECT md5(s_name), 'disparate_impact_ratio',
               CASE WHEN s_suppkey % 11 = 0 THEN {nan} ELSE 0.5e0 + ((s_suppkey * 13) % 50) / 100e0 END
        FROM {supplier} WHERE s_suppkey % 7 <> 0""",
}


def role_sql(name: str, dialect: str) -> str:
    """The SELECT of a part; table names stay in braces for Spark and are plain elsewhere."""
    words = DIALECTS[dialect]
    text = ROLE_SQL[name]
    while "{days:" in text:
        start = text.index("{days:")
        end = text.index("}", start)
        a, b = text[start + 6 : end].split("|")
        text = text[:start] + words["days"].format(a=a, b=b) + text[end + 1 :]
    names = {t: f"{{{t}}}" if dialect == "spark" else t for t in TABLES}
    filled = text.format(**names, text=words["text"], nan=words["nan"])
    # Spark fills table names in with a second pass, which halves doubled braces once more
    return filled if dialect != "spark" else _escaped(filled)


def _escaped(sql: str) -> str:
    kept = {f"{{{t}}}": f"\0{t}\0" for t in TABLES}
    for name, mark in kept.items():
        sql = sql.replace(name, mark)
    sql = sql.replace("{", "{{").replace("}", "}}")
    for name, mark in kept.items():
        sql = sql.replace(mark, name)
    return sql


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(T.StructType.fromDDL(TABLE_COLUMNS[name])).parquet(f"{folder}/{name}.parquet")


def role(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A part as a DataFrame over the Parquet files of ``folder``."""
    sql = role_sql(name, "spark")
    used = {t: table(spark, folder, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def with_roles(*names: str) -> str:
    """A WITH clause that defines the parts for the checking engine."""
    return "WITH " + ",\n".join(f"{n} AS ({role_sql(n, 'duckdb')})" for n in names)
