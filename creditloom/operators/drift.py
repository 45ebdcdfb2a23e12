"""Population drift: reference against recent scores, report rows, levels and trends."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.scalars import PSI_ALERT, PSI_WARNING, heading, psi_status
from creditloom.operators.ordering import (
    ROWS_PER_RANGE,
    exact_quantiles,
    long_form,
    running_totals,
    temporal_split,
)
from creditloom.runtime import materialise, small_table

# fixed values: watched features, lookback, smallest current sample
WATCHED = [
    "AMT_INCOME_TOTAL",
    "DAYS_BIRTH",
    "EXT_SOURCE_1",
    "EXT_SOURCE_2",
    "EXT_SOURCE_3",
    "bureau_loan_count",
    "debt_to_credit_ratio",
]
LOOKBACK_DAYS = 7
MINIMUM_ROWS = 10
DECILES = [i / 10 for i in range(1, 10)]
SHARE_FLOOR = 1e-4


def reference_rows(master: DataFrame, key: str, features: list[str] | None = None) -> DataFrame:
    """Watched features of the training share; absent ones are left out."""
    wanted = [c for c in (features or WATCHED) if c in master.columns]
    return temporal_split(master.select(key, *wanted), key).where("split = 'train'").select(*wanted)


def recent_scores(
    audit: DataFrame, as_of: Column | datetime, days: int = LOOKBACK_DAYS, ts: str = "predicted_at"
) -> DataFrame:
    until = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return audit.where(F.col(ts) >= until - F.expr(f"INTERVAL {int(days)} DAYS"))


def payload_features(audit: DataFrame, features: list[str] | None = None, payload: str = "request_payload") -> DataFrame:
    """Watched features from the stored request text; absent or non-numeric values become null."""
    names = features or WATCHED
    inner = T.StructType([T.StructField(n, T.StringType()) for n in names])
    schema = T.StructType([T.StructField("application", inner)])
    parsed = audit.select(F.from_json(payload, schema).alias("p"))
    return parsed.select(*[F.col(f"p.application.{n}").try_cast("double").alias(n) for n in names])


#: Column of how many scores a row of current features stands for.
WEIGHT = "n_scores"


def current_features(recent: DataFrame, master: DataFrame, key: str, features: list[str], score_key: str = "application_id") -> DataFrame:
    """Watched features of recently scored applicants, read from the feature table, one row per applicant with the number of its scores.

    Table-wide scoring stores no request text, so the payload alone would miss those rows. Scores are counted before the join, so
    an applicant that is scored again and again is one row in it.
    """
    scored = recent.groupBy(F.col(score_key).alias(key)).agg(F.count(F.lit(1)).alias(WEIGHT))
    return scored.join(master.select(key, *features), key).select(*features, WEIGHT)


def _weight(df: DataFrame) -> Column:
    return F.col(WEIGHT) if WEIGHT in df.columns else F.lit(1)


def enough_rows(current: DataFrame, minimum: int = MINIMUM_ROWS) -> bool:
    """Whether there are ``minimum`` scores; every row stands for one at least."""
    few = current.select(_weight(current).alias("n")).limit(minimum)
    return (few.agg(F.sum("n")).first()[0] or 0) >= minimum


def bin_cells(edges: dict[str, list[float]]) -> Column:
    """Feature name and right-closed bin number of every watched column, as an array of structs.

    A bin is the number of sorted edges below the value; null and NaN have none.
    """
    cells = []
    for name, cuts in edges.items():
        c = f"CAST(`{name}` AS DOUBLE)"
        number = " + ".join(f"CAST({c} > {float(e)!r}D AS INT)" for e in cuts) or "0"
        label = name.replace("'", "\\'")
        cells.append(
            f"named_struct('feature', '{label}', 'bin', CASE WHEN {c} IS NOT NULL AND NOT isnan({c}) THEN {number} END)"
        )
    return F.expr(f"array({', '.join(cells)})")


def bin_counts(df: DataFrame, edges: dict[str, list[float]], *keys: str | Column) -> DataFrame:
    """Rows, or the scores they stand for, per (keys, feature, bin); nulls and NaN are not counted."""
    long = df.select(*keys, _weight(df).alias("_n"), F.inline(bin_cells(edges))).where("bin IS NOT NULL")
    return long.groupBy(*[c for c in long.columns if c != "_n"]).agg(F.sum("_n").alias("n"))


def reference_edges(reference: DataFrame, features: list[str], rows_per_range: int = ROWS_PER_RANGE) -> dict[str, list[float]]:
    """Exact inner deciles per feature; features without any value are left out."""
    found = exact_quantiles(reference, features, DECILES, rows_per_range)
    return {f: cuts for f, cuts in found.items() if cuts[0] is not None}


BINS = range(len(DECILES) + 1)


def _bin_columns(counts: DataFrame, side: str, *by: str) -> DataFrame:
    """Bin counts as one column per bin and their total."""
    per_bin = [F.expr(f"coalesce(sum(CASE WHEN bin = {i} THEN n END), 0) AS {side}_{i}") for i in BINS]
    return counts.groupBy(*by).agg(F.sum("n").alias(f"n_{side}"), *per_bin)


def psi_from_counts(reference: DataFrame, current: DataFrame, *keys: str) -> DataFrame:
    """Population stability index per feature (and key) from two tables of bin counts.

    The reference side has one row per feature, a number fixed by the caller's feature list, so it
    is broadcast. Empty bins count as a share of 1e-4. Without keys every feature of the reference has its row, with a score
    of 0 if there are no current values.
    """
    ref = _bin_columns(reference, "reference", "feature")
    cur = _bin_columns(current, "current", *keys, "feature")
    shares = [
        F.expr(f"greatest(try_divide({side}_{i}, n_{side}), {SHARE_FLOOR}D) AS {side}_share_{i}")
        for side in ("reference", "current") for i in BINS
    ]
    psi = " + ".join(
        f"(current_share_{i} - reference_share_{i}) * ln(current_share_{i} / reference_share_{i})" for i in BINS
    )
    kept = [*keys, "feature", "n_reference", "n_current"]
    both = cur.join(F.broadcast(ref), "feature") if keys else ref.join(cur, "feature", "left")
    found = both.withColumn("n_current", F.coalesce("n_current", F.lit(0))).select(*kept, *shares)
    scored = F.when(F.col("n_current") > 0, F.expr(psi)).otherwise(0.0)
    return found.select(*keys, "feature", scored.alias("psi"), "n_reference", "n_current")


def psi_scores(
    reference: DataFrame, current: DataFrame, features: list[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    edges = reference_edges(reference, features, rows_per_range)
    return psi_from_counts(bin_counts(reference, edges), bin_counts(current, edges))


def ks_scores(
    reference: DataFrame, current: DataFrame, features: list[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Largest gap between the two cumulative distributions, per feature, exact."""
    zero = F.lit(0).cast("long")
    tagged = (
        long_form(reference, features).select("*", F.lit(1).cast("long").alias("ref"), zero.alias("cur"))
        .unionByName(long_form(current, features, _weight(current).cast("long").alias("cur")).withColumn("ref", zero))
    )
    per_value = tagged.groupBy("name", "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    curve = running_totals(per_value, "value", ["ref", "cur"], "name", rows_per_range)
    sizes = [(g, t["ref"], t["cur"]) for g, t in curve.totals.items()]
    table = F.broadcast(
        small_table(reference.sparkSession, sizes, "name string, n_ref long, n_cur long")
    )
    gap = F.abs(F.try_divide("cum_ref", "n_ref") - F.try_divide("cum_cur", "n_cur"))
    return curve.rows.join(table, "name").groupBy(F.col("name").alias("feature")).agg(F.max(gap).alias("ks"))


def drift_report(
    reference: DataFrame, current: DataFrame, features: list[str], report_date: date,
    lookback_days: int = LOOKBACK_DAYS, rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame | None:
    """One row per watched feature, or nothing when there are too few current rows.

    A feature that one of the two sides lacks, as a column or in all its rows, counts as not drifted, with a score of 0 and no KS.
    """
    if not enough_rows(current):
        return None
    shared = [f for f in features if f in reference.columns and f in current.columns]
    watched = small_table(reference.sparkSession, [(f,) for f in features], "feature string")
    # a row per feature; as a stored table it keeps the long bin expressions out of the filters that readers put on the report
    psi = materialise(psi_scores(reference, current, shared, rows_per_range), "psi")
    ks = ks_scores(reference, current, shared, rows_per_range)
    found = watched.join(psi, "feature", "left").withColumns(
        {"psi": F.coalesce("psi", F.lit(0.0)), "n_reference": F.coalesce("n_reference", F.lit(0)), "n_current": F.coalesce("n_current", F.lit(0))}
    )
    return found.join(ks, "feature", "left").select(
        "feature", "psi", "ks",
        (F.col("psi") >= PSI_WARNING).alias("drifted"),
        psi_status(F.col("psi")).alias("status"),
        "n_reference", "n_current",
        F.lit(lookback_days).alias("lookback_days"),
        F.lit(report_date).alias("report_date"),
    )


def report_rollup(report: DataFrame) -> DataFrame:
    """Whether anything drifted and the largest score, per report date."""
    return report.groupBy("report_date").agg(
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("any_drift_detected"),
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
        F.max("n_reference").alias("n_reference"),
        F.max("n_current").alias("n_current"),
    )


def alerts(report: DataFrame) -> DataFrame:
    """Features above the warning level, with the level they reached."""
    level = F.when(F.col("psi") > PSI_ALERT, "alert").otherwise("warning")
    return report.where(F.col("psi") >= PSI_WARNING).withColumn("level", level)


def status_table(report: DataFrame) -> DataFrame:
    """Scores under display headings, with their status in words."""
    shown = report.select(F.col("feature").alias("feature_group"), F.col("psi").alias("psi_score"), "drifted")
    named = shown.select(*[F.col(c).alias(heading(c)) for c in shown.columns])
    return named.withColumn("Status", psi_status(F.col(heading("psi_score"))))


def trend(reports: DataFrame) -> DataFrame:
    """Score per feature over time with the change since the report before."""
    order = Window.partitionBy("feature").orderBy("report_date")
    return reports.select(
        "feature", "report_date", "psi", psi_status(F.col("psi")).alias("status"),
        (F.col("psi") - F.lag("psi").over(order)).alias("change"),
    )


def drift_metrics(report: DataFrame, run_id: str) -> DataFrame:
    """Report rows as metrics of a model run."""
    each = report.select(
        F.lit(run_id).alias("run_id"),
        F.concat(F.lit("drift_psi_"), "feature").alias("metric"),
        F.col("psi").alias("value"),
    )
    whole = report_rollup(report).select(
        F.lit(run_id).alias("run_id"),
        F.inline(
            F.array(
                F.struct(F.lit("drift_max_psi").alias("metric"), F.col("max_psi").alias("value")),
                F.struct(
                    F.lit("drift_any_detected").alias("metric"),
                    F.col("any_drift_detected").cast("double").alias("value"),
                ),
            )
        ),
    )
    return each.unionByName(whole)
