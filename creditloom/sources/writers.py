"""Writers: Parquet, the audit table, drift reports and CSV exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.scalars import json_text, risk_tier, version_of
from creditloom.sources.audit_table import AuditTable
from creditloom.sources.schemas import AUDIT_SCHEMA

# fixed values: tag of table-wide scoring
BATCH_SOURCE = "batch_ingest"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def audit_rows(
    scored: DataFrame, applicant: str, probability: Column, run_id: Column, predicted_at: Column,
    source: str = BATCH_SOURCE, attribution: Column | None = None, payload: Column | None = None,
) -> DataFrame:
    """Scored rows in the shape of the audit table. A NaN score is refused, not given a tier."""
    p = F.when(F.isnan(probability), F.raise_error(F.lit("score is NaN"))).otherwise(probability)
    at = predicted_at.cast("timestamp")
    columns = {
        # requests of one applicant in one micro-batch share their time, so the payload tells them apart
        "id": F.concat_ws(":", F.lit(source), F.col(applicant).cast("string"), at.cast("string"), *([] if payload is None else [F.md5(payload)])),
        "application_id": F.col(applicant).cast("long"),
        "default_probability": p.cast("double"),
        "risk_tier": risk_tier(p.cast("double")),
        "top_shap_features": attribution if attribution is not None else F.lit("[]"),
        "model_version": version_of(run_id),
        "predicted_at": at,
        "cached": F.lit(False),
        "request_payload": payload if payload is not None else json_text(F.lit(source).alias("source")),
        "source": F.lit(source),
        "load": F.lit(""),
        "predicted_date": at.cast("date"),
    }
    return scored.select(*[columns[f.name].alias(f.name) for f in AUDIT_SCHEMA.fields])


def replace_source(rows: DataFrame, path: str, source: str = BATCH_SOURCE) -> None:
    """Write rows so that they replace all earlier rows of their source, and no others, in one step for every reader."""
    AuditTable(rows.sparkSession, path).replace(rows, source)


def append_audit(rows: DataFrame, path: str, source: str, load: str) -> None:
    """Add one load of audit rows; a failed write fails the job, because the trail is mandatory.

    The load is named by the caller (a stream names its batch), so a retry replaces it instead of adding a second copy.
    """
    AuditTable(rows.sparkSession, path).append(rows, source, load)


def write_drift_report(report: DataFrame, path: str) -> None:
    """One folder of JSON lines per report date; a repeated date replaces its report."""
    (
        report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false").partitionBy("report_date").json(path)
    )


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
