"""Exact rank metrics, fairness audit, reweighing and thresholds on scored labels."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.scalars import AGE_BINS, age_bucket, age_years
from creditloom.operators.ordering import FAN, ROWS_PER_RANGE, order_statistics, running_totals
from creditloom.runtime import small_table

# fixed values: four-fifths rule, default cut-off, age that splits the reweighing groups
FAIR_RATIO = 0.80
DEFAULT_CUTOFF = 0.5
REWEIGH_AGE = 45


def score_curve(
    df: DataFrame, label: str = "y", score: str = "score", rows_per_range: int = ROWS_PER_RANGE, fan: int = FAN
) -> tuple[DataFrame, int, int]:
    """One row per distinct score with class counts and running class counts, plus the totals.

    Rows collapse to distinct scores before anything is ordered, so a score shared by a third of
    the table is a single row here.
    """
    y = F.col(label)
    per_score = (
        df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score)))
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )
    curve = running_totals(per_score, "score", ["pos", "neg"], rows_per_range=rows_per_range, fan=fan)
    totals = curve.totals.get(0, {"pos": 0, "neg": 0})
    return curve.rows, totals["pos"], totals["neg"]


def rank_metrics(
    df: DataFrame, label: str = "y", score: str = "score", rows_per_range: int = ROWS_PER_RANGE, fan: int = FAN
) -> DataFrame:
    """AUC (ties count half), Gini and KS as one row; null where a class is empty."""
    curve, n_pos, n_neg = score_curve(df, label, score, rows_per_range, fan)
    p, n = F.lit(float(n_pos)), F.lit(float(n_neg))
    below = F.col("cum_neg") - F.col("neg")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / F.lit(2.0)))
    gap = F.abs(F.try_divide(F.col("cum_pos"), p) - F.try_divide(F.col("cum_neg"), n))
    out = curve.agg(F.try_divide(wins, p * n).alias("auc_roc"), F.max(gap).alias("ks_stat"))
    return out.select("auc_roc", (F.col("auc_roc") * 2 - 1).alias("gini"), "ks_stat")


def roc_curve(df: DataFrame, label: str = "y", score: str = "score", **kwargs) -> DataFrame:
    """True and false positive rate when everything at or above a score is flagged."""
    curve, n_pos, n_neg = score_curve(df, label, score, **kwargs)
    flagged_pos = F.lit(n_pos) - F.col("cum_pos") + F.col("pos")
    flagged_neg = F.lit(n_neg) - F.col("cum_neg") + F.col("neg")
    return curve.select(
        F.col("score").alias("threshold"),
        F.try_divide(flagged_pos.cast("double"), F.lit(float(n_pos))).alias("tpr"),
        F.try_divide(flagged_neg.cast("double"), F.lit(float(n_neg))).alias("fpr"),
        F.try_divide((flagged_pos + flagged_neg).cast("double"), F.lit(float(n_pos + n_neg))).alias(
            "selection_rate"
        ),
    )


def youden(df: DataFrame, label: str = "y", score: str = "score", **kwargs) -> DataFrame:
    """Threshold with the widest gap between the rates, the highest one on ties.

    Flagging nobody is a candidate too (gap 0, threshold infinity).
    """
    curve = roc_curve(df, label, score, **kwargs).withColumn("j", F.col("tpr") - F.col("fpr"))
    best = curve.agg(
        F.max_by(F.struct("threshold", "j", "selection_rate"), F.struct("j", "threshold")).alias("b")
    )
    gains = F.coalesce(F.col("b.j") > 0, F.lit(False))
    return best.select(
        F.when(gains, F.col("b.threshold")).otherwise(F.lit(float("inf"))).alias("threshold"),
        F.when(gains, F.col("b.j")).otherwise(F.lit(0.0)).alias("j"),
        F.when(gains, F.col("b.selection_rate")).otherwise(F.lit(0.0)).alias("selection_rate"),
    )


def binarise(score: Column, cutoff: Column | float = DEFAULT_CUTOFF) -> Column:
    return (score >= cutoff).cast("int")


def group_rates(
    df: DataFrame, bucket: Column, label: str = "y", prediction: str = "y_pred"
) -> DataFrame:
    """True positive rate and selection rate per group; rows outside all groups are left out."""
    hit = F.col(prediction) == 1
    actual = F.col(label) == 1
    return (
        df.withColumn("bucket", bucket)
        .where(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(
                F.try_divide(F.count_if(actual & hit), F.count_if(actual)), F.lit(0.0)
            ).alias("tpr"),
            (F.count_if(hit) / F.count(F.lit(1))).alias("pos_rate"),
        )
    )


def fairness_metrics(rates: DataFrame) -> DataFrame:
    """Spread over groups as one row, with each age group's own rates beside it."""
    per_group = []
    for name, _, _ in AGE_BINS:
        here = F.col("bucket") == name
        per_group += [
            F.max(F.when(here, F.col("tpr"))).alias(f"tpr_{name}"),
            F.max(F.when(here, F.col("pos_rate"))).alias(f"pos_rate_{name}"),
        ]
    return rates.agg(
        (F.max("tpr") - F.min("tpr")).alias("equal_opportunity_diff"),
        F.try_divide(F.min("pos_rate"), F.max("pos_rate")).alias("disparate_impact_ratio"),
        *per_group,
    )


def fairness_audit(
    df: DataFrame, label: str = "y", prediction: str = "y_pred", days_birth: str = "days_birth"
) -> DataFrame:
    return fairness_metrics(group_rates(df, age_bucket(F.col(days_birth)), label, prediction))


def apply_group_thresholds(
    df: DataFrame, thresholds: DataFrame, bucket: Column, score: str = "score", out: str = "y_pred"
) -> DataFrame:
    """Flag scores at their group's threshold; 0.5 where a group has none, 0 outside all groups.

    ``thresholds`` has one row per group, so it is small enough to broadcast.
    """
    table = F.broadcast(thresholds.select(F.col("bucket").alias("_bucket"), "threshold"))
    joined = df.withColumn("_b", bucket).join(table, F.col("_b") == F.col("_bucket"), "left")
    cut = F.coalesce(F.col("threshold"), F.lit(DEFAULT_CUTOFF))
    flag = F.when(F.col("_b").isNull(), 0).otherwise(binarise(F.col(score), cut))
    return joined.withColumn(out, flag).drop("_b", "_bucket", "threshold")


def group_thresholds(
    df: DataFrame, target_rate: float, score: str = "score", days_birth: str = "days_birth",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Per age group, the score that flags ``target_rate`` of the group.

    The k-th largest score, k = max(1, round(rate * n)) rounded half to even and at most n, is an
    exact order statistic, so a group of any size is never sorted as a whole.
    """
    sizes: dict[str, tuple[int, int]] = {}

    def kth_largest(group, n):
        k = min(max(1, round(target_rate * n)), n)
        sizes[group] = (n, k)
        return [n - k]

    scored = df.select(age_bucket(F.col(days_birth)).alias("bucket"), F.col(score).alias("_score"))
    found = order_statistics(scored, "_score", kth_largest, "bucket", rows_per_range)
    rows = [(g, *sizes[g], float(next(iter(v.values())))) for g, v in sorted(found.items())]
    return small_table(df.sparkSession, rows, "bucket string, n long, k long, threshold double")


def reweigh_table(df: DataFrame, group: Column, label: str = "y") -> DataFrame:
    """Weight per (group, label) that makes the label independent of the group.

    One scan counts the cells; their margins are sums over a handful of numbers.
    """
    cells = df.groupBy(group.alias("a"), F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n_ay"))
    counts = {(r["a"], r["y"]): r["n_ay"] for r in cells.collect()}
    by_a, by_y = Counter(), Counter()
    for (a, y), n in counts.items():
        by_a[a] += n
        by_y[y] += n
    total = sum(counts.values())
    rows = [(a, y, n, by_a[a] * by_y[y] / (total * n)) for (a, y), n in counts.items()]
    schema = T.StructType(
        [cells.schema["a"], cells.schema["y"], cells.schema["n_ay"], T.StructField("weight", T.DoubleType())]
    )
    return small_table(df.sparkSession, rows, schema)


def mature_group(days_birth: Column) -> Column:
    """1 for applicants of at least 45 years, else 0."""
    return (age_years(days_birth) >= REWEIGH_AGE).cast("int")


def reweigh(df: DataFrame, label: str = "y", days_birth: str = "days_birth", out: str = "weight") -> DataFrame:
    """Attach the reweighing weight of each row; the weights add up to the row count."""
    group = mature_group(F.col(days_birth))
    table = reweigh_table(df, group, label).select(
        F.col("a").alias("_a"), F.col("y").alias("_y"), F.col("weight").alias(out)
    )
    same = group.eqNullSafe(F.col("_a")) & F.col(label).eqNullSafe(F.col("_y"))
    return df.join(F.broadcast(table), same).drop("_a", "_y")


COMPARED = ["auc_roc", "gini", "ks_stat", "equal_opportunity_diff", "disparate_impact_ratio"]


def compare_models(baseline: DataFrame, candidate: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Two one-row metric tables side by side, with the change and the fairness verdict."""
    names = names or COMPARED

    def tall(df: DataFrame, value: str) -> DataFrame:
        cells = F.array(
            *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(value)) for m in names if m in df.columns]
        )
        return df.select(F.inline(cells))

    both = tall(baseline, "baseline").join(tall(candidate, "candidate"), "metric", "full")
    ratio = F.when(F.col("metric") == "disparate_impact_ratio", F.col("candidate"))
    verdict = (
        F.when(F.col("metric") != "disparate_impact_ratio", F.lit(None).cast("string"))
        .when(F.coalesce(ratio, F.lit(0.0)) >= FAIR_RATIO, F.lit("PROMOTABLE"))
        .otherwise(F.lit("NOT PROMOTABLE"))
    )
    return both.withColumn("delta", F.col("candidate") - F.col("baseline")).withColumn("verdict", verdict)


def evaluate(
    scored: DataFrame, label: str = "y", score: str = "score", days_birth: str = "days_birth",
    cutoff: float = DEFAULT_CUTOFF, thresholds: DataFrame | None = None,
) -> DataFrame:
    """All metrics of a scored holdout as one row."""
    if thresholds is None:
        flagged = scored.withColumn("y_pred", binarise(F.col(score), cutoff))
    else:
        flagged = apply_group_thresholds(scored, thresholds, age_bucket(F.col(days_birth)), score)
    parts = [rank_metrics(scored, label, score), fairness_audit(flagged, label, "y_pred", days_birth)]
    return reduce(lambda a, b: a.join(b, "one"), [p.withColumn("one", F.lit(1)) for p in parts]).drop("one")


def tall_metrics(metrics: DataFrame, run_id: str) -> DataFrame:
    """A one-row metric table as (run_id, metric, value) rows for the metrics table."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in metrics.columns]
    )
    return metrics.select(F.lit(run_id).alias("run_id"), F.inline(cells))
