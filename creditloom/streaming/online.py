"""Scoring requests as they arrive, with the answer cache and the audit trail.

What was answered before is keyed state of the stream, kept with its checkpoint, so a restart or a lost executor loses
nothing, and a replayed batch finds the same state and writes the same folder again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from creditloom.functions.registry import ID_COLUMN
from creditloom.functions.scalars import cache_key, json_text
from creditloom.operators.drift import bin_cells
from creditloom.operators.features import filled_columns, loans_with_months, request_history_columns
from creditloom.operators.impute import ImputeProfile, imputed_columns
from creditloom.operators.quality import conforming_requests
from creditloom.runtime import scratch_path
from creditloom.sources.schemas import REQUEST_LISTS, request_schema
from creditloom.sources.writers import append_audit, audit_rows
from creditloom.streaming.answer_cache import rows_to_answer

# fixed value: seconds an answer stays valid
CACHE_SECONDS = 3600
API_SOURCE = "api"


def read_request_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None, pattern: str = "*.json"
) -> DataFrame:
    """Request documents, one per line, as ``text`` with their arrival time."""
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select(
        F.col("value").alias("text"), F.current_timestamp().alias("received_at")
    )


def request_key(requests: DataFrame) -> Column:
    return cache_key(F.col(f"request.application.{ID_COLUMN}"), F.col("text"))


class RequestFeatures:
    """Model features of parsed requests, each folded inside its own row; no shuffle.

    The definitions are those of the table build, and the imputer is the stored one from training. The many expressions are made for the
    first batch and used again for the others.
    """

    def __init__(self, profile: ImputeProfile, keep: tuple[str, ...] = ("text", "received_at")) -> None:
        self.profile, self.keep = profile, keep
        lists = [F.coalesce(F.col(f"request.{name}"), F.array()).alias(f"_{name}") for name in REQUEST_LISTS]
        self.parts = [*keep, "request.application.*", *lists]
        self.loans = loans_with_months(F.col("_bureau"), F.col("_bureau_balance"))
        self.histories = request_history_columns(lambda name: F.col(f"_{name}"))
        self.imputed: list[Column] = []
        self.filled: list[Column] = []

    def __call__(self, requests: DataFrame) -> DataFrame:
        base = requests.select(*self.parts)
        self.imputed = self.imputed or imputed_columns(base.schema, self.profile)
        wide = base.select(*self.imputed).withColumn("_bureau", self.loans).withColumns(self.histories)
        wide = wide.drop(*[f"_{name}" for name in REQUEST_LISTS])
        self.filled = self.filled or filled_columns(wide.schema, (*self.keep, ID_COLUMN))
        return wide.select(*self.filled)


def fresh_requests(stream: DataFrame, seconds: int = CACHE_SECONDS, late: str = "1 hour") -> DataFrame:
    """Request documents (text, received_at) that conform and were not answered within the last ``seconds``.

    Documents that do not conform are left to ``conforming_requests`` callers; they are never scored.
    """
    accepted, _ = conforming_requests(stream, "text", request_schema(), f"application.{ID_COLUMN}")
    keyed = accepted.select(request_key(accepted).alias("key"), "text", "received_at")
    return rows_to_answer(keyed, "key", "received_at", "text", seconds, late)


def answer_rows(batch: DataFrame, features: RequestFeatures, score: Callable[[DataFrame], DataFrame], run_id: str) -> DataFrame:
    """Audit rows of a batch of fresh requests: parsed, features built, scored.

    ``score`` adds a ``score`` column (and may add ``attribution`` text).
    """
    accepted, _ = conforming_requests(batch, "text", request_schema(), f"application.{ID_COLUMN}")
    scored = score(features(accepted))
    attribution = F.col("attribution") if "attribution" in scored.columns else None
    return audit_rows(
        scored, ID_COLUMN, F.col("score"), F.lit(run_id), F.col("received_at"), API_SOURCE,
        attribution, json_text(F.lit(API_SOURCE).alias("source"), F.col("text")),
    )


def answer_batch(
    batch: DataFrame, batch_id: int, audit_path: str, features: RequestFeatures,
    score: Callable[[DataFrame], DataFrame], run_id: str,
) -> None:
    """Append the answers of one batch to the audit table, under a load named by the batch, so that a replay replaces them."""
    append_audit(answer_rows(batch, features, score, run_id), audit_path, API_SOURCE, f"stream-{batch_id}")


def run_to_end(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str | None = None) -> StreamingQuery:
    """Process everything available, batch by batch, then stop."""
    where = checkpoint or scratch_path(stream.sparkSession, "offsets")
    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", where)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def run_on(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Start a stream that goes on until it is stopped."""
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).start()


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over everything available into a Parquet sink and read the sink."""
    spark: SparkSession = stream.sparkSession
    out = scratch_path(spark, "sink")
    query = (
        stream.writeStream.outputMode(mode).format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "offsets"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def read_table_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A folder of Parquet files as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def daily_means(scores: DataFrame, ts: str = "predicted_at", late: str = "1 hour") -> DataFrame:
    """Mean probability per day, given out once the day is closed by the watermark."""
    return (
        scores.withWatermark(ts, late)
        .groupBy(F.window(ts, "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg("default_probability").alias("avg_probability"))
        .select(F.col("w.start").cast("date").alias("date"), "n", "avg_probability")
    )


def lookback_histograms(
    scores: DataFrame, edges: dict[str, list[float]], ts: str = "predicted_at", days: int = 7, late: str = "1 hour"
) -> DataFrame:
    """Bin counts per feature over sliding windows of the last days, one window per day.

    Two windows in a chain: rows are counted once, by day; closed days, a row per feature and bin each, are then added up over
    the windows that hold them. Rows that come behind the watermark are dropped.
    """
    daily = (
        scores.withWatermark(ts, late)
        .select(ts, F.inline(bin_cells(edges)))
        .where("bin IS NOT NULL")
        .groupBy(F.window(ts, "1 day").alias("day"), "feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        daily.groupBy(F.window(F.window_time("day"), f"{days} days", "1 day").alias("w"), "feature", "bin")
        .agg(F.sum("n").alias("n"))
        .select(F.col("w.end").alias("window_end"), "feature", "bin", "n")
    )
