"""Readers: typed CSV, Parquet, optional tables, audit scans and drift reports."""

from __future__ import annotations

from fnmatch import fnmatch
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.sources.audit_table import AuditTable
from creditloom.sources.schemas import DRIFT_SCHEMA, raw_schema

# fixed values: files beside the raw tables that are not data
NOT_DATA = ("*_columns_description.csv", "sample_submission.csv")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def list_csv(spark: SparkSession, folder: str, skip: tuple[str, ...] = NOT_DATA) -> list[str]:
    """CSV file names of a folder, without the ones that are not data."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/*.csv")
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop_path) or []
    return sorted(n for n in (f.getPath().getName() for f in found) if not any(fnmatch(n, pattern) for pattern in skip))


def list_tables(spark: SparkSession, folder: str, suffix: str = ".parquet") -> list[str]:
    """Names of the Parquet tables of a folder, whether each is a file or a folder of files."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/"))
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)
    names = (f.getPath().getName() for f in found)
    return sorted(n.removesuffix(suffix) for n in names if n.endswith(suffix))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, charset: str = "UTF-8"
) -> DataFrame:
    """CSV with a header. Types come from ``schema`` by name, never from the data.

    Only the header line is read to learn the column order; columns the schema does not name
    stay text. Bytes that are not valid in ``charset`` become the replacement character.
    """
    reader = spark.read.option("header", True).option("encoding", charset)
    known = {f.name: f.dataType for f in schema.fields} if schema else {}
    names = reader.option("inferSchema", False).csv(path).columns
    typed = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])
    return reader.schema(typed).csv(path)


def read_raw_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the eight raw tables; a missing file is an error."""
    path = f"{folder.rstrip('/')}/{table}.csv"
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return read_csv(spark, path, raw_schema(table))


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if path_exists(spark, path) else None


def read_all_present(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Union of the Parquet tables that exist, columns matched by name; none at all is an error."""
    found = [df for df in (read_optional(spark, p) for p in paths) if df is not None]
    if not found:
        raise FileNotFoundError(f"none of {paths} exist")
    return diagonal_union(found)


def diagonal_union(frames: list[DataFrame]) -> DataFrame:
    """Stack tables by column name; absent columns become null, mixed number types widen."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_audit(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """The audit table as it is now, or its rows from ``since`` on; a table nothing was written to is empty."""
    return AuditTable(spark, path).read(since)


def read_drift_reports(spark: SparkSession, path: str) -> DataFrame:
    """All stored drift reports; lines that are not valid JSON are skipped."""
    return spark.read.schema(DRIFT_SCHEMA).option("mode", "DROPMALFORMED").json(path)


def latest_report(reports: DataFrame) -> DataFrame:
    newest = reports.agg(F.max("report_date").alias("report_date"))
    return reports.join(F.broadcast(newest), "report_date")


def records_to_table(
    parents: DataFrame, field: str, schema: T.StructType, key: str = "SK_ID_CURR"
) -> DataFrame:
    """Child records of nested requests as rows that carry the parent's key.

    The schema is fixed, so requests without children give an empty, fully typed table.
    """
    typed = parents.select(
        F.col(f"request.application.{key}").alias("_key"),
        F.explode(F.col(f"request.{field}")).alias("child"),
    )
    columns = [
        (F.col("_key") if f.name == key else F.col(f"child.{f.name}")).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return typed.select(*columns)


def read_jdbc(
    spark: SparkSession, url: str, query: str, partition_column: str, lower: str, upper: str,
    partitions: int, **options: str,
) -> DataFrame:
    """A database query read in parallel slices of ``partition_column``."""
    return (
        spark.read.format("jdbc").options(**options)
        .option("url", url).option("dbtable", f"({query}) AS q")
        .option("partitionColumn", partition_column).option("lowerBound", lower)
        .option("upperBound", upper).option("numPartitions", partitions).load()
    )
