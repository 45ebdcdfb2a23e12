"""Profiles and contracts: missing values, keys, registry coverage, request conformance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.registry import feature_rows
from creditloom.functions.scalars import missing_bucket
from creditloom.runtime import small_table


class ContractError(ValueError):
    """A table breaks a rule its readers rely on."""


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def null_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    """Row count and nulls per column from one scan."""
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_q(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)],
    ).first()
    return row["_rows"], {c: row[f"_{i}"] for i, c in enumerate(df.columns)}


def missing_summary(df: DataFrame, table: str) -> DataFrame:
    """One row per column: type, nulls, missing rate and table size. One scan, one reducer row."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(_q(f.name).isNull()).alias(f"c{i}") for i, f in enumerate(df.schema.fields)],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.col(f"c{i}").alias("null_count"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    rate = F.when(F.col("n_rows") > 0, F.col("null_count") / F.col("n_rows")).otherwise(F.lit(0.0))
    return counts.select("n_rows", F.inline(cells)).select(
        F.lit(table).alias("table"), "column", "dtype", "null_count",
        rate.alias("missing_rate"), "n_rows",
    )


def missing_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Missing summaries of several tables, most-missing first."""
    parts = [missing_summary(df, name) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc("missing_rate"), "table", "column")


def missing_histogram(summary: DataFrame) -> DataFrame:
    """How many columns miss a little, much or most of their values."""
    return (
        summary.where("missing_rate > 0")
        .groupBy(missing_bucket(F.col("missing_rate")).alias("missing_bucket"))
        .agg(F.count(F.lit(1)).alias("n_columns"))
    )


def top_missing(summary: DataFrame, k: int = 25) -> DataFrame:
    return (
        summary.where("missing_rate > 0")
        .orderBy(F.desc("missing_rate"), F.asc("column"))
        .limit(k)
    )


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null count and rate of the given columns, side by side in one row."""
    count = F.count(F.lit(1))
    return df.agg(
        *[F.count_if(_q(c).isNull()).alias(f"{c}_nulls") for c in columns],
        *[F.try_divide(F.count_if(_q(c).isNull()), count).alias(f"{c}_missing_rate") for c in columns],
    )


def residual_nulls(df: DataFrame) -> DataFrame:
    """All null cells of a table as one number."""
    cells = reduce(lambda a, b: a + b, [_q(c).isNull().cast("long") for c in df.columns])
    return df.agg(F.coalesce(F.sum(cells), F.lit(0)).alias("null_cells"))


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table; the counts come from file footers where the format has them."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("file"), "rows", F.lit(len(df.columns)).alias("cols")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def key_contract(df: DataFrame, key: str, label: str | None = None) -> DataFrame:
    """Rows, distinct keys, repeated keys, and null keys or labels of a table."""
    columns = [key] + ([label] if label else [])
    aggregates = [F.count(F.lit(1)).alias("rows")]
    if label:
        aggregates.append(F.count_if(F.col(label).isNull()).alias("null_labels"))
    per_key = df.select(*columns).groupBy(key).agg(*aggregates)
    nulls = F.sum("null_labels") if label else F.lit(0).cast("long")
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("rows") > 1).alias("n_repeated_keys"),
        F.count_if(F.col(key).isNull()).alias("n_null_keys"),
        F.coalesce(nulls, F.lit(0)).alias("n_null_labels"),
    ).withColumn("is_unique", F.col("n_repeated_keys") == 0)


def require_unique(df: DataFrame, key: str, table: str) -> DataFrame:
    if duplicate_keys(df, key).limit(1).count():
        raise ContractError(f"{table}: {key} is not unique")
    return df


def require_no_nulls(df: DataFrame, column: str, table: str) -> DataFrame:
    if df.where(F.col(column).isNull()).limit(1).count():
        raise ContractError(f"{table}: {column} has nulls")
    return df


def id_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many distinct keys two tables share."""
    shared = left.select(key).intersect(right.select(key))
    return shared.agg(F.count(F.lit(1)).alias("n_shared"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column)


def registry_check(df: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Registered features against a table: present, missing, holding nulls, or not registered."""
    spark = df.sparkSession
    features = feature_rows()
    names = {f.name for f in features}
    present = [f.name for f in features if f.name in df.columns]
    schema = "feature string, state string, null_count long"
    fixed = [(f.name, "missing", None) for f in features if f.name not in df.columns]
    fixed += [(c, "unregistered", None) for c in df.columns if c not in names and c not in ignore]
    listed = small_table(spark, fixed, schema)
    if not present:
        return listed
    nulls = missing_summary(df.select(*[_q(c) for c in present]), "registry").select(
        F.col("column").alias("feature"),
        F.when(F.col("null_count") > 0, "has_nulls").otherwise("ok").alias("state"),
        "null_count",
    )
    return nulls.unionByName(listed)


def validate_registry(df: DataFrame) -> DataFrame:
    """Raise if a registered feature is missing or still holds nulls."""
    bad = registry_check(df).where("state IN ('missing', 'has_nulls')").collect()
    missing = sorted(r["feature"] for r in bad if r["state"] == "missing")
    nulls = sorted(r["feature"] for r in bad if r["state"] == "has_nulls")
    if missing or nulls:
        raise ContractError(f"missing features: {missing}; features with nulls: {nulls}")
    return df


def describe_numeric(df: DataFrame, column: str, quartiles: list[float]) -> DataFrame:
    """Count, mean, spread and range, next to quartiles found by exact order statistics."""
    c = F.col(column)
    q25, q50, q75 = [F.lit(q).cast("double") for q in quartiles]
    return df.agg(
        F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"), F.max(c).alias("max"),
    ).select("count", "mean", "std", "min", q25.alias("p25"), q50.alias("p50"), q75.alias("p75"), "max")


def conforming_requests(
    raw: DataFrame, text: str, schema: T.StructType, required: str
) -> tuple[DataFrame, DataFrame]:
    """Parse request documents; returns (accepted, rejected).

    Unknown members are ignored and absent ones become null. A document that is not JSON, or lacks
    ``required`` (a dotted path), is rejected with its text.
    """
    parsed = raw.withColumn("request", F.from_json(text, schema, {"mode": "PERMISSIVE"}))
    good = F.col(f"request.{required}").isNotNull()
    return parsed.where(good), parsed.where(~F.coalesce(good, F.lit(False))).drop("request")
