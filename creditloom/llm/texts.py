"""Helpers that several text operators share: words, lower case, and columns whose names clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the separators of ``[^\x20\x09-\x0D]+``.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[ \x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """A text that is never null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and no other letter, whatever the locale."""
    return F.translate(text, UPPER, LOWER)


def blank_words(text: Column) -> Column:
    """The words ``[^\x20\x09-\x0D]+`` of a text, as an array."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANK_RUN))


def packed(df: DataFrame, *left_out: str, **columns: Column) -> DataFrame:
    """The columns of ``df`` in one struct ``_whole``, where no name can clash with the given new columns beside it."""
    whole = [F.col(f"`{c}`") for c in df.columns if c not in left_out]
    return df.select((F.struct(*whole) if whole else F.lit(None)).alias("_whole"), *(value.alias(name) for name, value in columns.items()))


def replacing(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with the given columns last; columns of the same names, in any case, give way to them."""
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *(value.alias(name) for name, value in columns.items()))
