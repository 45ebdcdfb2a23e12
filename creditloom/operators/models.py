"""Encoding, training, time-ordered validation, search and scoring with Spark ML."""

from __future__ import annotations

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from statistics import fmean, pstdev

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.operators.evaluation import rank_metrics
from creditloom.operators.ordering import ROWS_PER_RANGE, TIME_FOLDS, first_holdout_key, text_index, time_folds
from creditloom.runtime import materialise, small_table

# fixed values: tuned settings of the boosted trees that Spark's learner also has
POSITIVE_WEIGHT = 11.0
BEST_SETTINGS = {
    "maxDepth": 3,
    "minInstancesPerNode": 83,
    "subsamplingRate": 0.6750591731140013,
    "featureSubsetStrategy": "0.6014708421568282",
    "stepSize": 0.05523743599687083,
    "maxIter": 1532,
    "seed": 42,
}
# fixed values: search ranges (low, high, kind) and the number of trials
SEARCH_RANGES = {
    "maxDepth": (3, 7, "int"),
    "minInstancesPerNode": (20, 100, "int"),
    "minInfoGain": (0.0, 1.0, "float"),
    "subsamplingRate": (0.6, 1.0, "float"),
    "featureSubsetStrategy": (0.6, 1.0, "share"),
    "stepSize": (0.01, 0.1, "float"),
}
TRIALS = 30
# fixed values: ranges of the second search, which also draws the weight of positives, and what it holds still
SECOND_RANGES = {
    "maxDepth": (3, 7, "int"),
    "minInstancesPerNode": (1, 50, "int"),
    "minInfoGain": (0.0, 1.0, "float"),
    "positiveWeight": (1.0, 10.0, "float"),
    "stepSize": (0.01, 0.1, "float"),
}
SECOND_FIXED = {"subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "maxIter": 500, "seed": 42}
# fixed values: the settings that the second search led to
SECOND_SETTINGS = {
    "maxDepth": 5,
    "minInstancesPerNode": 38,
    "minInfoGain": 0.16691306730017352,
    "positiveWeight": 5.586941175444759,
    "stepSize": 0.06296893710250466,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "maxIter": 2000,
    "seed": 42,
}
# share of the newest training rows that early stopping watches
LATE_SHARE = 0.1

# a dictionary of categories up to this size is broadcast whole
DICTIONARY_BYTES = 32 << 20
# of a larger one, values with at least one row in so many, each up to so many bytes; rows without a value to look up get one of so many salts
HOT_PARTS, HOT_BYTES, SALTS = 1_000, 10_000, 1_024


def fit_ordinal(df: DataFrame, columns: list[str]) -> list[Transformer]:
    """Sorted categories to 0..k-1; unseen and null become -1. Output columns end in ``_code``.

    For a model, which carries its categories with it; a column with more of them than a model should carry goes through ``ordinal_encode``.
    """
    if not columns:
        return []
    indexer = StringIndexer(
        inputCols=columns, outputCols=[f"_{c}_index" for c in columns],
        stringOrderType="alphabetAsc", handleInvalid="keep",
    )
    model: StringIndexerModel = indexer.fit(df)
    codes = ", ".join(
        f"CASE WHEN `_{c}_index` >= {len(labels)} THEN -1D ELSE `_{c}_index` END AS `{c}_code`"
        for c, labels in zip(columns, model.labelsArray)
    )
    return [model, SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__")]


def ordinal_encode(
    df: DataFrame, columns: list[str], fitted_on: DataFrame | None = None, broadcast_bytes: int = DICTIONARY_BYTES,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Sorted categories to 0..k-1 in ``<column>_code``, for any number of categories; unseen and null become -1.

    The categories of each column become a stored table with their positions, which is joined back; none of them comes to the driver.
    """
    source = df if fitted_on is None else fitted_on
    for c in columns:
        codes = text_index(source.select(F.col(c).cast("string").alias("_category")), "_category", "_position", rows_per_range)
        df = _with_code(df, F.col(c).cast("string"), codes, f"{c}_code", broadcast_bytes)
    return df


def _with_code(df: DataFrame, text: Column, codes: DataFrame, out: str, broadcast_bytes: int) -> DataFrame:
    """Join positions to the rows: a dictionary of few bytes is broadcast; of a larger one the frequent values are, and the others are shuffled.

    A row whose value is frequent or null has no key left for the second join; a salt spreads such rows, so they do not meet in one task.
    """
    size = codes.agg(F.coalesce(F.sum(F.octet_length("_category") + 16), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        found = df.join(F.broadcast(codes), text == F.col("_category"), "left")
        return found.withColumn(out, F.coalesce("_position", F.lit(-1)).cast("double")).drop("_category", "_position")
    counts = materialise(df.groupBy(text.alias("_value")).agg(F.count(F.lit(1)).alias("_n")), "category-counts")
    n_rows = counts.agg(F.sum("_n")).first()[0] or 0
    # at most HOT_PARTS rows, each of at most HOT_BYTES
    frequent = counts.where((F.col("_n") * HOT_PARTS >= n_rows) & (F.octet_length("_value") <= HOT_BYTES))
    hot = frequent.join(codes, F.col("_value") == F.col("_category"), "left").select(
        F.col("_value").alias("_hot"), F.coalesce("_position", F.lit(-1)).alias("_hot_position")
    )
    rows = df.join(F.broadcast(materialise(hot, "frequent-categories")), text == F.col("_hot"), "left")
    rows = rows.withColumn("_rest", F.when(F.col("_hot").isNull(), text))
    salt = F.when(F.col("_rest").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)) + 1).otherwise(0)
    rare = codes.withColumn("_rare", F.lit(0).cast("long"))
    joined = rows.withColumn("_salt", salt.cast("long")).join(rare, (F.col("_rest") == F.col("_category")) & (F.col("_salt") == F.col("_rare")), "left")
    code = F.coalesce("_hot_position", "_position", F.lit(-1)).cast("double")
    return joined.withColumn(out, code).drop("_hot", "_hot_position", "_rest", "_salt", "_rare", "_category", "_position")


def feature_stages(df: DataFrame, numeric: list[str], categories: list[str], scale: bool = False) -> list[Transformer]:
    """Fitted stages that build the ``features`` vector: numbers first, then category codes."""
    stages = fit_ordinal(df, categories)
    codes = [f"{c}_code" for c in categories]
    if not scale:
        stages.append(VectorAssembler(inputCols=numeric + codes, outputCol="features", handleInvalid="error"))
        return stages
    raw = VectorAssembler(inputCols=numeric, outputCol="_numbers", handleInvalid="error")
    scaler = StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True)
    stages += [raw, scaler.fit(raw.transform(df))]
    stages.append(VectorAssembler(inputCols=["_scaled", *codes], outputCol="features", handleInvalid="error"))
    return stages


def feature_order(numeric: list[str], categories: list[str]) -> list[str]:
    return [*numeric, *categories]


def run_stages(df: DataFrame, stages: list[Transformer]) -> DataFrame:
    for stage in stages:
        df = stage.transform(df)
    return df


def positive_weight(label: Column, weight: Column | None = None, factor: float = POSITIVE_WEIGHT) -> Column:
    """Row weight with positives counted ``factor`` times."""
    base = F.lit(1.0) if weight is None else weight
    return F.when(label == 1, base * factor).otherwise(base)


def balanced_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Row weight n / (2 * n_class), so both classes weigh the same in total."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos")).first()
    n, pos = row["n"], row["pos"]
    if not 0 < pos < n:
        raise ValueError("both classes are needed to balance weights")
    return df.withColumn(out, F.when(F.col(label) == 1, n / (2 * pos)).otherwise(n / (2 * (n - pos))))


def gbt(settings: dict | None = None, **columns: str) -> GBTClassifier:
    """Boosted trees with the tuned settings, some of them overridden."""
    return GBTClassifier(featuresCol="features", **{**BEST_SETTINGS, **(settings or {})}, **columns)


def logistic(settings: dict | None = None, **columns: str) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", **{"maxIter": 100, **(settings or {})}, **columns)


def probability_of_default(model_output: DataFrame, out: str = "score") -> DataFrame:
    return model_output.withColumn(out, vector_to_array("probability")[1])


def _parted(settings: dict | None) -> tuple[dict, float]:
    """Settings of the learner, and the weight of positives, which goes into the rows."""
    rest = dict(settings or {})
    return rest, rest.pop("positiveWeight", POSITIVE_WEIGHT)


def train_boosted(
    df: DataFrame, numeric: list[str], categories: list[str], label: str, settings: dict | None = None,
    weight: str | None = None, validation: Column | None = None,
) -> PipelineModel:
    """Encode and fit boosted trees; ``validation`` marks rows kept for early stopping.

    ``settings`` are those of the learner; ``positiveWeight`` among them says how often a positive counts.
    """
    rest, factor = _parted(settings)
    stages = feature_stages(df, numeric, categories)
    w = positive_weight(F.col(label), F.col(weight) if weight else None, factor)
    prepared = run_stages(df.withColumn("_weight", w), stages)
    columns = {"labelCol": label, "weightCol": "_weight"}
    if validation is not None:
        prepared = prepared.withColumn("_validation", validation)
        columns["validationIndicatorCol"] = "_validation"
    kept = ["features", label, "_weight"] + (["_validation"] if validation is not None else [])
    fitted = gbt(rest, **columns).fit(materialise(prepared.select(*kept), "train"))
    return PipelineModel(stages=[*stages, fitted])


def train_logistic(
    df: DataFrame, numeric: list[str], categories: list[str], label: str, settings: dict | None = None
) -> PipelineModel:
    stages = feature_stages(df, numeric, categories, scale=True)
    prepared = run_stages(balanced_weight(df, label), stages).select("features", label, "weight")
    fitted = logistic(settings, labelCol=label, weightCol="weight").fit(materialise(prepared, "train"))
    return PipelineModel(stages=[*stages, fitted])


def score_table(df: DataFrame, model: PipelineModel, keep: list[str], out: str = "score") -> DataFrame:
    """Probability of default of every row, without the intermediate columns."""
    return probability_of_default(model.transform(df), out).select(*keep, out)


def cross_validate(df: DataFrame, key: str, label: str, fit, folds: int = TIME_FOLDS) -> list[float]:
    """AUC per time fold; each model sees only rows older than its test slice.

    ``fit(train)`` returns a model. The folds are cut once and stored, so no fold repeats the
    feature work.
    """
    sliced = materialise(time_folds(df, key, folds), "folds")
    scores = []
    for fold in range(1, folds + 1):
        model = fit(sliced.where(F.col("fold") < fold))
        tested = score_table(sliced.where(F.col("fold") == fold), model, [label])
        scores.append(rank_metrics(tested, label, "score").first()["auc_roc"])
    return scores


def fold_table(df: DataFrame, scores: list[float], name: str) -> DataFrame:
    """Fold scores with their mean and spread as rows."""
    usable = [s for s in scores if s is not None]
    rows = [(name, str(i + 1), s) for i, s in enumerate(scores)]
    if usable:
        rows += [(name, "mean", fmean(usable)), (name, "std", pstdev(usable))]
    return small_table(df.sparkSession, rows, "model string, fold string, auc double")


def draw_settings(seed: int, trials: int = TRIALS, ranges: dict | None = None) -> list[dict]:
    """Settings of a seeded random search."""
    rng = random.Random(seed)
    out = []
    for _ in range(trials):
        pick = {}
        for name, (low, high, kind) in (ranges or SEARCH_RANGES).items():
            if kind == "int":
                pick[name] = rng.randint(low, high)
            elif kind == "log":
                pick[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
            else:
                value = rng.uniform(low, high)
                pick[name] = f"{value:.6f}" if kind == "share" else value
        out.append(pick)
    return out


def fold_vectors(
    df: DataFrame, numeric: list[str], categories: list[str], key: str, label: str, folds: int = TIME_FOLDS, late_share: float = LATE_SHARE,
) -> list[DataFrame]:
    """Per time fold one stored table: ``label``, the vector ``features``, and ``part``, which is train, late or test.

    Late rows are the newest share of those before the test slice. Encoders see the rows before the test slice only.
    """
    sliced = materialise(time_folds(df.select(key, label, *numeric, *categories), key, folds), "search")
    stored = []
    for fold in range(1, folds + 1):
        before = sliced.where(F.col("fold") < fold)
        late = F.lit(False) if late_share <= 0 else F.col(key) >= F.lit(first_holdout_key(before, key, late_share))
        part = F.when(F.col("fold") == fold, "test").when(late, "late").otherwise("train")
        rows = run_stages(sliced.where(F.col("fold") <= fold), feature_stages(before, numeric, categories))
        stored.append(materialise(rows.select(label, "features", part.alias("part")), "fold"))
    return stored


def fold_auc(stored: DataFrame, label: str, settings: dict, stop_early: bool) -> float | None:
    """AUC on the test rows of one fold, of trees fitted on the rows before them."""
    rest, factor = _parted(settings)
    train = stored.where("part <> 'test'").select(
        "features", label, positive_weight(F.col(label), factor=factor).alias("_weight"), (F.col("part") == "late").alias("_late")
    )
    columns = {"labelCol": label, "weightCol": "_weight", **({"validationIndicatorCol": "_late"} if stop_early else {})}
    model = gbt(rest, **columns).fit(train)
    tested = probability_of_default(model.transform(stored.where("part = 'test'"))).select(label, "score")
    return rank_metrics(tested, label, "score").first()["auc_roc"]


def random_search(
    df: DataFrame, numeric: list[str], categories: list[str], key: str, label: str, trials: int = TRIALS,
    folds: int = TIME_FOLDS, seed: int = 42, ranges: dict | None = None, fixed: dict | None = None,
    parallel: int = 4, stop_early: bool = False, kept_share: float = 1.0,
) -> DataFrame:
    """Mean time-fold AUC of every drawn setting, best first; trials run side by side, over one stored copy of each fold.

    Each fold is a rung: after it, the best ``kept_share`` of the trials go on to the next one. ``folds`` says how many a trial has seen, and
    trials that saw more stand first. ``stop_early`` ends a trial's boosting when the newest training rows gain no more.
    """
    stored = fold_vectors(df, numeric, categories, key, label, folds, LATE_SHARE if stop_early else 0.0)
    drawn = draw_settings(seed, trials, ranges)
    aucs: dict[int, list[float]] = {number: [] for number in range(trials)}
    seen = dict.fromkeys(aucs, 0)

    def mean(number: int) -> float:
        return fmean(aucs[number]) if aucs[number] else float("nan")

    going = list(aucs)
    with ThreadPoolExecutor(parallel) as pool:
        for rows in stored:
            found = pool.map(lambda number: fold_auc(rows, label, {**drawn[number], **(fixed or {})}, stop_early), going)
            for number, auc in zip(going, list(found)):
                seen[number] += 1
                if auc is not None:
                    aucs[number].append(auc)
            best = sorted(going, key=lambda number: (-mean(number) if aucs[number] else math.inf, number))
            going = best[: max(1, math.ceil(len(best) * kept_share))]
    rows = [(number, json.dumps(drawn[number], sort_keys=True), seen[number], mean(number)) for number in aucs]
    table = small_table(df.sparkSession, rows, "trial int, settings string, folds int, mean_auc double")
    return table.orderBy(F.desc("folds"), F.isnan("mean_auc"), F.desc("mean_auc"), "trial")
