"""Queries over the audit table of scores."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.scalars import (
    TIERS,
    minute_text,
    nan_to_null,
    percent,
    percent_text,
    period_start,
    tier_rank,
    within_period,
)
from creditloom.operators.ordering import seek_page
from creditloom.sources.audit_table import AuditTable

# fixed values: columns of a page of scores
PAGE_COLUMNS = [
    "id", "application_id", "default_probability", "risk_tier", "model_version", "predicted_at", "cached",
]


def in_period(scores: DataFrame, period: str, as_of: Column | datetime, ts: str = "predicted_at") -> DataFrame:
    return scores.where(within_period(F.col(ts), period, as_of))


def tier_totals(scores: DataFrame) -> DataFrame:
    """Count and probability sum per tier: the one aggregation all summaries roll up from."""
    return scores.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("count"),
        F.count("default_probability").alias("n_scored"),
        F.sum("default_probability").alias("probability_sum"),
    )


def portfolio_summary(scores: DataFrame, period: str, as_of: Column | datetime) -> DataFrame:
    """One row: totals, the tier breakdown as an array, and the period asked for."""
    tiers = tier_totals(in_period(scores, period, as_of))
    breakdown = F.struct(
        "risk_tier", "count", F.try_divide("probability_sum", "n_scored").alias("avg_probability")
    )
    return tiers.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_predictions"),
        F.sort_array(F.collect_list(breakdown)).alias("tier_breakdown"),
        F.coalesce(F.sum(F.when(F.col("risk_tier") == "HIGH", F.col("count"))), F.lit(0)).alias(
            "high_risk_count"
        ),
        F.coalesce(
            F.try_divide(F.sum("probability_sum"), F.sum("n_scored")), F.lit(0.0)
        ).alias("avg_default_probability"),
    ).withColumn("period", F.lit(period))


def high_risk_rate(summary: DataFrame) -> DataFrame:
    return summary.select(
        "period", "total_predictions", "high_risk_count",
        percent(F.col("high_risk_count"), F.col("total_predictions")).alias("high_risk_rate"),
    )


def tiers_in_order(scores: DataFrame) -> DataFrame:
    """Tier counts from LOW to HIGH."""
    return (
        scores.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("count"))
        .withColumn("tier_rank", tier_rank(F.col("risk_tier")))
        .orderBy("tier_rank")
    )


def score_page(
    scores: DataFrame, period: str, as_of: Column | datetime, limit: int = 100, offset: int = 0,
    tier: str | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """A page of scores, newest first; equal times come in id order."""
    rows = in_period(scores, period, as_of)
    if tier is not None:
        if tier not in TIERS:
            raise ValueError(f"tier must be one of {TIERS}")
        rows = rows.where(F.col("risk_tier") == tier)
    return seek_page(rows.select(*(columns or PAGE_COLUMNS)), "predicted_at", "id", limit, offset)


def audit_page(
    audit: AuditTable, period: str, as_of: Column | datetime, limit: int = 100, offset: int = 0,
    tier: str | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """The same page out of a written audit table, of which only the files that can hold it are opened."""
    return audit.page(limit, offset, period_start(period, as_of), tier).select(*(columns or PAGE_COLUMNS))


def audit_total(audit: AuditTable, period: str, as_of: Column | datetime, tier: str | None = None) -> DataFrame:
    return audit.total(period_start(period, as_of), tier).withColumn("period", F.lit(period))


def page_total(scores: DataFrame, period: str, as_of: Column | datetime, tier: str | None = None) -> DataFrame:
    rows = in_period(scores, period, as_of)
    if tier is not None:
        rows = rows.where(F.col("risk_tier") == tier)
    return rows.agg(F.count(F.lit(1)).alias("total")).withColumn("period", F.lit(period))


def daily_trend(scores: DataFrame) -> DataFrame:
    """Mean probability per day over all rows."""
    return scores.groupBy(F.to_date("predicted_at").alias("date")).agg(
        F.avg("default_probability").alias("avg_probability")
    )


def flagged_display(scores: DataFrame) -> DataFrame:
    """High-risk rows with the headings and text formats of the export."""
    return scores.where(F.col("risk_tier") == "HIGH").select(
        F.col("application_id").alias("Application ID"),
        percent_text(F.col("default_probability")).alias("Default Probability"),
        F.col("risk_tier").alias("Risk Tier"),
        F.col("model_version").alias("Model Version"),
        minute_text(F.col("predicted_at")).alias("Predicted At"),
    )


def lookup_applicants(ids: DataFrame, sources: list[DataFrame], key: str = "SK_ID_CURR") -> DataFrame:
    """The row of each wanted id from the first source that has it, NaN shown as null.

    An id found in one source leaves the search before the next; of the earlier sources only the
    key column is read again for that. Ids found nowhere give no row.
    """
    wanted = ids.select(key).distinct()
    found = []
    for position, source in enumerate(sources):
        found.append(source.join(wanted, key, "left_semi").withColumn("found_in", F.lit(position)))
        wanted = wanted.join(source.select(key), key, "left_anti")
    return _without_nan(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found))


def _without_nan(df: DataFrame) -> DataFrame:
    real = ("double", "float")
    return df.select(
        *[
            nan_to_null(F.col(f.name)).alias(f.name) if f.dataType.typeName() in real else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def lookup_applicant(applicant: int, sources: list[DataFrame], key: str = "SK_ID_CURR") -> DataFrame:
    """One applicant from the first source that has it; unknown ids are an error."""
    for source in sources:
        hit = source.where(F.col(key) == applicant).limit(1)
        if hit.take(1):
            return _without_nan(hit)
    raise KeyError(f"{key} {applicant} not found")
