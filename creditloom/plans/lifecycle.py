"""Train, evaluate, promote, score, serve and watch: the model's life as jobs over tables.

The registry folder holds ``runs`` (versions of the run table), ``metrics`` (appended rows) and one
folder per fitted model.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from creditloom.functions.registry import ID_COLUMN, LABEL_COLUMN
from creditloom.operators import attribution, drift, evaluation, governance, models, ordering
from creditloom.operators.impute import ImputeProfile, align_to
from creditloom.runtime import materialise, scratch_scope, small_table
from creditloom.sources.readers import path_exists, read_all_present, read_audit
from creditloom.sources.schemas import METRIC_SCHEMA, MODEL_RUN_SCHEMA
from creditloom.sources.writers import audit_rows, replace_source, write_drift_report
from creditloom.streaming import online


def _runs_path(registry: str) -> str:
    return f"{registry.rstrip('/')}/runs"


def _metrics_path(registry: str) -> str:
    return f"{registry.rstrip('/')}/metrics"


def read_metrics(spark: SparkSession, registry: str) -> DataFrame:
    path = _metrics_path(registry)
    if not path_exists(spark, path):
        return spark.createDataFrame([], METRIC_SCHEMA)
    return spark.read.schema(METRIC_SCHEMA).parquet(path)


def log_metrics(metrics: DataFrame, registry: str) -> None:
    metrics.write.mode("append").parquet(_metrics_path(registry))


def _register(spark: SparkSession, registry: str, row: tuple) -> None:
    new = small_table(spark, [row], MODEL_RUN_SCHEMA)
    known = governance.read_runs(spark, _runs_path(registry))
    governance.write_runs(new if known is None else known.unionByName(new), _runs_path(registry))


def train(
    table: DataFrame, registry: str, numeric: list[str], categories: list[str], settings: dict | None = None,
    fair: bool = False, fit_on: str = "train", now: datetime | None = None, imputer: ImputeProfile | None = None,
) -> str:
    """Fit boosted trees, save the model and register it as staging; returns the run id.

    ``imputer`` is the profile the table was built with. It is stored with the run, and ``serve`` needs it.

    The first 80% of the applications by id train the model. ``fit_on="all"`` uses every row, which
    makes a later evaluation on the last 20% an in-sample one. ``fair`` reweighs the rows by age
    group and adds per-age thresholds found on the newest quarter of the training rows, which the
    model then has not seen.
    """
    spark = table.sparkSession
    run_id = uuid.uuid4().hex
    path = f"{registry.rstrip('/')}/models/{run_id}"
    needed = list(dict.fromkeys([ID_COLUMN, LABEL_COLUMN, "DAYS_BIRTH", *numeric, *categories]))
    with scratch_scope(spark):
        rows = table.select(*needed)
        if fit_on == "train":
            rows = ordering.temporal_split(rows, ID_COLUMN).where("split = 'train'").drop("split")
        elif fit_on != "all":
            raise ValueError("fit_on must be 'train' or 'all'")
        rows = materialise(rows, "train-rows")
        thresholds = None
        if fair:
            marked = ordering.temporal_split(rows, ID_COLUMN, 0.25)
            fitting = marked.where("split = 'train'").drop("split")
            weighted = evaluation.reweigh(fitting, LABEL_COLUMN, "DAYS_BIRTH", "fair_weight")
            model = models.train_boosted(weighted, numeric, categories, LABEL_COLUMN, settings, "fair_weight")
            held = materialise(
                models.score_table(marked.where("split = 'holdout'"), model, [LABEL_COLUMN, "DAYS_BIRTH"]), "calibration"
            )
            rate = evaluation.youden(held, LABEL_COLUMN).first()["selection_rate"]
            found = evaluation.group_thresholds(held, rate, "score", "DAYS_BIRTH")
            thresholds = {r["bucket"]: r["threshold"] for r in found.collect()}
        else:
            model = models.train_boosted(rows, numeric, categories, LABEL_COLUMN, settings)
        model.write().overwrite().save(path)
    info = {"numeric": numeric, "categories": categories, "settings": {**models.BEST_SETTINGS, **(settings or {})}}
    if imputer is not None:
        info["imputer"] = imputer.to_json()
    when = now or datetime.now(timezone.utc)
    _register(
        spark, registry,
        (run_id, "staging", "gbt", path, len(numeric) + len(categories), json.dumps(info), thresholds, when, None),
    )
    return run_id


def load_run(spark: SparkSession, registry: str, run_id: str | None = None) -> tuple[dict, PipelineModel]:
    """Registry row and fitted model of a run (by prefix), or of the production run."""
    runs = governance.read_runs(spark, _runs_path(registry))
    if runs is None:
        raise FileNotFoundError(f"no model registry in {registry}")
    chosen = governance.production_run(runs) if run_id is None else governance.find_run(runs, run_id)
    row = chosen.first()
    if row is None:
        raise FileNotFoundError("no production model")
    return row.asDict(), PipelineModel.load(row["path"])


def _aligned(table: DataFrame, info: dict) -> DataFrame:
    return align_to(table, info["numeric"] + info["categories"], info["categories"])


def _scored(table: DataFrame, run: dict, model: PipelineModel, keep: list[str]) -> DataFrame:
    return models.score_table(_aligned(table, json.loads(run["params"])), model, keep)


class Explainer:
    """A run that scores tables and says why: ``score`` and, as JSON text, the ten largest ``attribution`` cells.

    The trees are read once, however many tables or batches are scored.
    """

    def __init__(self, run: dict, model: PipelineModel) -> None:
        self.run_id, self.info = run["run_id"], json.loads(run["params"])
        self.stages, self.leaves = model.stages, attribution.tree_leaves(model.stages[-1])
        self.names = models.feature_order(self.info["numeric"], self.info["categories"])

    @property
    def imputer(self) -> ImputeProfile:
        if "imputer" not in self.info:
            raise ValueError(f"run {self.run_id} was registered without its imputer")
        return ImputeProfile.from_json(self.info["imputer"])

    def score(self, table: DataFrame, keep: list[str]) -> DataFrame:
        prepared = models.run_stages(_aligned(table, self.info), self.stages[:-1])
        scored = models.probability_of_default(self.stages[-1].transform(prepared.select(*keep, "features")))
        found = attribution.tree_attribution(scored, self.leaves, self.names, [*keep, "score"])
        return found.select(*keep, "score", attribution.attribution_text(F.col("top"), self.names).alias("attribution"))


def evaluate(table: DataFrame, registry: str, run_id: str, cutoff: float = evaluation.DEFAULT_CUTOFF) -> DataFrame:
    """Metrics of a run on the newest 20% of the applications, logged and returned as one row."""
    spark = table.sparkSession
    run, model = load_run(spark, registry, run_id)
    with scratch_scope(spark):
        holdout = ordering.temporal_split(table, ID_COLUMN).where("split = 'holdout'")
        scored = materialise(
            _scored(holdout, run, model, [LABEL_COLUMN, "DAYS_BIRTH"]).withColumnsRenamed(
                {LABEL_COLUMN: "y", "DAYS_BIRTH": "days_birth"}
            ),
            "scored",
        )
        thresholds = None
        if run["group_thresholds"]:
            thresholds = small_table(spark, list(run["group_thresholds"].items()), "bucket string, threshold double")
        metrics = materialise(evaluation.evaluate(scored, cutoff=cutoff, thresholds=thresholds), "metrics", keep=True)
        log_metrics(evaluation.tall_metrics(metrics, run["run_id"]).where("value IS NOT NULL"), registry)
    return metrics


def promote(
    spark: SparkSession, registry: str, run_id: str, force: bool = False, auc_floor: float | None = None,
    now: datetime | None = None,
) -> dict:
    """Apply the gate to a run and, if it passes, put it into production. Returns the decision."""
    runs = governance.read_runs(spark, _runs_path(registry))
    full_id = governance.find_run(runs, run_id).first()["run_id"]
    gate = governance.promotion_gate(runs, read_metrics(spark, registry), force, auc_floor)
    decision = gate.where(F.col("run_id") == full_id).first().asDict()
    if decision["decision"] == "promote":
        when = F.lit(now or datetime.now(timezone.utc))
        governance.write_runs(governance.change_stage(runs, full_id, when), _runs_path(registry))
    return decision


def score_everyone(spark: SparkSession, tables: list[str], registry: str, audit: str, now: datetime | None = None) -> None:
    """Score all stored feature tables with the production model, replacing the last such scores."""
    run, model = load_run(spark, registry)
    combined = read_all_present(spark, tables)
    if ID_COLUMN not in combined.columns:
        raise ValueError(f"{ID_COLUMN} is missing from {tables}")
    scored = Explainer(run, model).score(combined, [ID_COLUMN])
    when = F.lit(now or datetime.now(timezone.utc))
    rows = audit_rows(scored, ID_COLUMN, F.col("score"), F.lit(run["run_id"]), when, attribution=F.col("attribution"))
    replace_source(rows, audit)


def serve(
    spark: SparkSession, registry: str, requests: DataFrame, audit: str, checkpoint: str, run_id: str | None = None,
    late: str = "1 hour", once: bool = True,
) -> StreamingQuery:
    """Answer a stream of request documents (text, received_at) with the production model, or the named run.

    Every request that conforms and was not answered within the last hour becomes one audit row: its features folded from its own child
    lists, missing values filled by the imputer the model was trained with, its score and its reasons. With ``once`` the
    job handles what is there and ends; else it runs until it is stopped. A restart goes on from ``checkpoint``.
    """
    explainer = Explainer(*load_run(spark, registry, run_id))
    features, keep = online.RequestFeatures(explainer.imputer), [ID_COLUMN, "text", "received_at"]

    def handle(batch: DataFrame, number: int) -> None:
        online.answer_batch(batch, number, audit, features, lambda rows: explainer.score(rows, keep), explainer.run_id)

    fresh = online.fresh_requests(requests, late=late)
    return online.run_to_end(fresh, handle, checkpoint) if once else online.run_on(fresh, handle, checkpoint)


def watch_drift(
    spark: SparkSession, table: str, audit: str, registry: str, reports: str, as_of: datetime,
    features: list[str] | None = None,
) -> DataFrame | None:
    """Compare recent scores with the training share, store the report, and log it to the run.

    Nothing is written, and nothing returned, when there are too few recent scores.
    """
    master = spark.read.parquet(table)
    names = [f for f in (features or drift.WATCHED) if f in master.columns]
    with scratch_scope(spark):
        since = F.lit(as_of) - F.expr(f"INTERVAL {drift.LOOKBACK_DAYS} DAYS")
        current = drift.current_features(read_audit(spark, audit, since), master, ID_COLUMN, names)
        reference = drift.reference_rows(master, ID_COLUMN, names)
        day: date = as_of.date()
        report = drift.drift_report(reference, current, names, day)
        if report is None:
            return None
        stored = materialise(report, "drift", keep=True)
        write_drift_report(stored, reports)
        runs = governance.read_runs(spark, _runs_path(registry))
        live = governance.production_run(runs).first() if runs is not None else None
        if live is not None:
            log_metrics(drift.drift_metrics(stored, live["run_id"]), registry)
    return stored

