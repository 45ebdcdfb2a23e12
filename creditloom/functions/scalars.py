"""Row-level expressions: tiers, bins, codes, keys and formatting."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: tier cut-offs, age bins, drift levels, missing-rate levels
LOW_BELOW = 0.30
HIGH_ABOVE = 0.60
TIERS = ["LOW", "MEDIUM", "HIGH"]
AGE_BINS = [("young_lt35", 0.0, 35.0), ("middle_35_55", 35.0, 55.0), ("senior_gt55", 55.0, 150.0)]
DAYS_PER_YEAR = 365.25
PSI_WARNING = 0.10
PSI_ALERT = 0.20
MISSING_HIGH = 0.70
MISSING_MEDIUM = 0.30
PERIODS = {"all": None, "6m": "INTERVAL 6 MONTHS", "1y": "INTERVAL 1 YEAR"}


def risk_tier(probability: Column) -> Column:
    """LOW below 0.30, HIGH above 0.60, MEDIUM between; a NaN score has no tier."""
    return (
        F.when(F.isnan(probability) | probability.isNull(), F.lit(None).cast("string"))
        .when(probability < LOW_BELOW, F.lit("LOW"))
        .when(probability <= HIGH_ABOVE, F.lit("MEDIUM"))
        .otherwise(F.lit("HIGH"))
    )


def tier_rank(tier: Column) -> Column:
    """1 for LOW, 2 for MEDIUM, 3 for HIGH, 0 for anything else."""
    return F.array_position(F.array(*[F.lit(t) for t in TIERS]), tier).cast("int")


def age_years(days_birth: Column) -> Column:
    return -days_birth / F.lit(DAYS_PER_YEAR)


def age_bucket(days_birth: Column) -> Column:
    """Right-closed age bins; ages outside all of them give null."""
    age = age_years(days_birth)
    out = None
    for label, low, high in AGE_BINS:
        hit = (age > low) & (age <= high)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out


def psi_status(psi: Column) -> Column:
    return (
        F.when(psi < PSI_WARNING, F.lit("Stable"))
        .when(psi <= PSI_ALERT, F.lit("Warning"))
        .otherwise(F.lit("Alert"))
    )


def missing_bucket(rate: Column) -> Column:
    return (
        F.when(rate >= MISSING_HIGH, F.lit("high (>=70%)"))
        .when(rate >= MISSING_MEDIUM, F.lit("medium (30-70%)"))
        .when(rate > 0, F.lit("low (<30%)"))
    )


def status_number(status: Column) -> Column:
    """Monthly status as a number: C, X, unknown text and null are 0."""
    text = F.when(status.isin("C", "X"), F.lit("0")).otherwise(status)
    return F.coalesce(text.try_cast("long"), F.lit(0).cast("long"))


def yes_no_flag(c: Column) -> Column:
    """Y to 1, N to 0; an unknown or missing answer counts as 0 instead of failing the job."""
    return (
        F.when(c == "Y", F.lit(1))
        .when(c == "N", F.lit(0))
        .otherwise(F.coalesce(c.cast("string").try_cast("int"), F.lit(0)))
        .cast("tinyint")
    )


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * F.lit(100.0)).otherwise(F.lit(0.0))


def percent_text(probability: Column) -> Column:
    return F.format_string("%.2f%%", probability * 100)


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm 'UTC'")


def json_text(*cols: Column) -> Column:
    """JSON object that keeps null members."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def cache_key(applicant: Column, payload: Column) -> Column:
    return F.concat_ws(
        ":", F.lit("prediction"), applicant.cast("string"), F.substring(F.md5(payload), 1, 8)
    )


def version_of(run_id: Column) -> Column:
    return F.substring(run_id, 1, 8)


def period_start(period: str, as_of: Column | datetime) -> Column | None:
    """First moment of the last 6 months or the last year, None for all; another period is an error."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {', '.join(PERIODS)}, not {period!r}")
    span = PERIODS[period]
    if span is None:
        return None
    until = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return until - F.expr(span)


def within_period(ts: Column, period: str, as_of: Column | datetime) -> Column:
    """Whether a time lies in a period."""
    start = period_start(period, as_of)
    return F.lit(True) if start is None else ts >= start


def heading(name: str) -> str:
    """Column name as a display heading."""
    return " ".join(part.capitalize() for part in name.split("_"))
