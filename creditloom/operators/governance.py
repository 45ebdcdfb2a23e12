"""Model runs as tables: promotion gate, stage changes, registry versions and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.scalars import version_of
from creditloom.operators.evaluation import FAIR_RATIO
from creditloom.sources.readers import path_exists

# fixed value: lowest AUC a production model may have
AUC_FLOOR = 0.74


def wide_metrics(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Metric rows as one row per run."""
    return metrics.groupBy("run_id").agg(
        *[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names]
    )


def promotion_gate(
    runs: DataFrame, metrics: DataFrame, force: bool = False, auc_floor: float | None = None
) -> DataFrame:
    """Decision and reason for every run.

    A run needs an AUC and a disparate impact ratio of at least 0.80; a ratio that is missing or
    not a number fails. ``force`` passes runs that would be blocked and says so.
    """
    joined = runs.select("run_id", "stage").join(
        wide_metrics(metrics, ["auc_roc", "disparate_impact_ratio"]), "run_id", "left"
    )
    ratio = F.col("disparate_impact_ratio")
    fair = ratio.isNotNull() & ~F.isnan(ratio) & (ratio >= FAIR_RATIO)
    problem = F.when(F.col("auc_roc").isNull(), F.lit("no evaluation metrics"))
    if auc_floor is not None:
        problem = problem.when(F.col("auc_roc") < auc_floor, F.lit("AUC below floor"))
    problem = problem.when(~F.coalesce(fair, F.lit(False)), F.lit("disparate impact below 0.80"))
    passed = F.when(F.col("stage") != "staging", F.lit("stage was not staging")).otherwise(F.lit("all gates passed"))
    blocked = F.lit("promote" if force else "block")
    decision = (
        F.when(F.col("stage") == "production", F.lit("none"))
        .when(problem.isNotNull(), blocked)
        .otherwise(F.lit("promote"))
    )
    reason = F.when(F.col("stage") == "production", F.lit("already production")).when(
        problem.isNotNull(), F.concat(F.lit("forced: " if force else ""), problem)
    ).otherwise(passed)
    return joined.select("run_id", "stage", "auc_roc", "disparate_impact_ratio",
                         decision.alias("decision"), reason.alias("reason"))


def change_stage(runs: DataFrame, run_id: str, promoted_at: Column) -> DataFrame:
    """Promote one run and archive whatever was in production."""
    chosen = F.col("run_id") == run_id
    was = F.col("stage") == "production"
    return runs.withColumns(
        {
            "promoted_at": F.when(chosen & ~F.coalesce(was, F.lit(False)), promoted_at).otherwise(F.col("promoted_at")),
            "stage": F.when(chosen, "production").when(was, "archived").otherwise(F.col("stage")),
        }
    )


def read_runs(spark: SparkSession, path: str) -> DataFrame | None:
    """Newest complete version of the registry table."""
    if not path_exists(spark, path):
        return None
    table = spark.read.parquet(path)
    newest = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == newest).drop("version")


def write_runs(runs: DataFrame, path: str) -> None:
    """Write the registry as its next version; readers keep the old one until this commits."""
    spark = runs.sparkSession
    version = 0
    if path_exists(spark, path):
        version = spark.read.parquet(path).agg(F.max("version")).first()[0] + 1
    runs.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/version={version}")


def production_run(runs: DataFrame) -> DataFrame:
    """The production run; the newest promotion wins should there be several."""
    live = runs.where(F.col("stage") == "production")
    newest = live.agg(F.max_by("run_id", F.struct("promoted_at", "run_id")).alias("run_id"))
    return live.join(F.broadcast(newest), "run_id", "left_semi")


def find_run(runs: DataFrame, run_id: str) -> DataFrame:
    """The run of that very id, else the newest run whose id starts with ``run_id``; none is an error."""
    hits = runs.where(F.col("run_id").startswith(run_id))
    newest = hits.orderBy(F.desc(F.col("run_id") == run_id), F.desc_nulls_last("created_at"), "run_id").limit(1)
    if not newest.take(1):
        raise FileNotFoundError(f"no model run starts with {run_id}")
    return newest


def model_info(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """What callers see of each run."""
    auc = wide_metrics(metrics, ["auc_roc"]).withColumnRenamed("auc_roc", "training_auc")
    return runs.join(auc, "run_id", "left").select(
        version_of(F.col("run_id")).alias("model_version"),
        F.col("run_id"), "model_type",
        F.col("group_thresholds").isNotNull().alias("fair"),
        "feature_count", "promoted_at", "training_auc",
    )
