"""Raw CSV tables to the two model-ready feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.registry import ID_COLUMN, LABEL_COLUMN
from creditloom.operators import features, impute, quality
from creditloom.runtime import small_table
from creditloom.sources.readers import diagonal_union, list_csv, read_raw_table
from creditloom.sources.writers import write_parquet

TRAIN_TABLE = "train_complete"
TEST_TABLE = "test_complete"


def history_features(tables: dict[str, DataFrame]) -> list[DataFrame]:
    months = features.loan_month_features(tables["bureau_balance"])
    return [
        features.bureau_features(tables["bureau"], months),
        features.installment_features(tables["installments_payments"]),
        features.credit_card_features(tables["credit_card_balance"]),
        features.pos_features(tables["POS_CASH_balance"]),
        features.previous_application_features(tables["previous_application"]),
    ]


def feature_path(out: str, name: str) -> str:
    """Where a feature table lies below the folder both are written to."""
    return f"{out.rstrip('/')}/part={name}"


def build_features(spark: SparkSession, raw: str, out: str, per_table_imputer: bool = False) -> None:
    """Write the train and test feature tables (test rows carry an empty label), and the train imputer beside them.

    The imputer is fitted on train and applied to both, unless ``per_table_imputer`` asks for
    each table's own; a column only one of them dropped gets its default there. Both tables go through
    one star join: every history is aggregated once and joined where its aggregation left it, and
    the result is split by folder as it is written. Grouping makes the history keys unique, while
    the applications are checked.
    """
    names = ["bureau", "bureau_balance", "installments_payments", "credit_card_balance",
             "POS_CASH_balance", "previous_application"]
    tables = {name: read_raw_table(spark, raw, name) for name in names}
    train = read_raw_table(spark, raw, "application_train")
    test = read_raw_table(spark, raw, "application_test")
    quality.require_unique(train, ID_COLUMN, "application_train")
    quality.require_unique(test, ID_COLUMN, "application_test")
    quality.require_no_nulls(train, LABEL_COLUMN, "application_train")

    profile = impute.fit_imputer(train, every_column=True)
    own = impute.fit_imputer(test) if per_table_imputer else profile
    applications = diagonal_union(
        [
            impute.apply_imputer(train, profile).withColumn("part", F.lit(TRAIN_TABLE)),
            impute.apply_imputer(test, own).withColumn("part", F.lit(TEST_TABLE)),
        ]
    )
    wide = features.fill_joined_nulls(features.star_join(applications, *history_features(tables)))
    write_parquet(wide, out, partition_by=["part"])
    stored = small_table(spark, [(profile.to_json(),)], "value string")
    stored.write.mode("overwrite").option("partitionOverwriteMode", "static").text(_imputer_path(out))


def _imputer_path(out: str) -> str:
    # readers of the tables pass over names with an underscore
    return f"{out.rstrip('/')}/_imputer"


def stored_imputer(spark: SparkSession, out: str) -> impute.ImputeProfile:
    """The profile the tables below ``out`` were built with."""
    return impute.ImputeProfile.from_json(spark.read.text(_imputer_path(out)).first()["value"])


def profile_raw_tables(spark: SparkSession, raw: str, out: str) -> DataFrame:
    """Missing-value report over every raw table of a folder, stored and returned."""
    names = [n.removesuffix(".csv") for n in list_csv(spark, raw)]
    tables = {f"{n}.csv": read_raw_table(spark, raw, n) for n in names}
    path = f"{out.rstrip('/')}/missing_value_report"
    write_parquet(quality.missing_report(tables), path)
    return spark.read.parquet(path)


def inventory(spark: SparkSession, raw: str) -> DataFrame:
    names = [n.removesuffix(".csv") for n in list_csv(spark, raw)]
    return quality.table_inventory({f"{n}.csv": read_raw_table(spark, raw, n) for n in names})
