"""Missing-value treatment of the application table: fit a small profile, then apply it.

``fit_imputer`` runs two aggregations and brings back one number per column; ``apply_imputer`` is
a single projection, so scoring reuses exactly what training saw.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.registry import ID_COLUMN, LABEL_COLUMN
from creditloom.functions.scalars import yes_no_flag
from creditloom.operators.ordering import ROWS_PER_RANGE, exact_medians
from creditloom.operators.quality import null_counts

# fixed values: which sparse columns may be dropped, and from which missing rate
DROP_FROM_RATE = 0.70
DROPPABLE_PREFIXES = (
    "COMMONAREA_",
    "NONLIVINGAPARTMENTS_",
    "NONLIVINGAREA_",
    "FONDKAPREMONT_MODE",
    "LIVINGAPARTMENTS_",
)
# fixed values: columns treated as categories whatever their type
CATEGORY_PREFIXES = ("NAME_", "OCCUPATION_TYPE", "ORGANIZATION_TYPE", "WEEKDAY_")
CATEGORY_NAMES = (
    "CODE_GENDER",
    "FLAG_OWN_CAR",
    "FLAG_OWN_REALTY",
    "HOUSETYPE_MODE",
    "WALLSMATERIAL_MODE",
    "EMERGENCYSTATE_MODE",
)
SCORE_PREFIX = "EXT_SOURCE"
CAR_AGE, CAR_FLAG = "OWN_CAR_AGE", "FLAG_OWN_CAR"
YES_NO_COLUMNS = ("FLAG_OWN_CAR", "FLAG_OWN_REALTY")
# fixed values: fills when a column has no median
SCORE_DEFAULT = 0.5
NUMBER_DEFAULT = 0.0


def is_category(name: str, data_type: T.DataType) -> bool:
    return (
        isinstance(data_type, T.StringType)
        or name in CATEGORY_NAMES
        or name.startswith(CATEGORY_PREFIXES)
    )


def is_droppable(name: str, missing_rate: float) -> bool:
    return missing_rate >= DROP_FROM_RATE and name.startswith(DROPPABLE_PREFIXES)


def split_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric column names and all other names."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return numeric, [c for c in df.columns if c not in numeric]


@dataclass
class ImputeProfile:
    """What training saw: dropped columns and the fill of every treated column."""

    dropped: list[str] = field(default_factory=list)
    scores: dict[str, float] = field(default_factory=dict)
    numbers: dict[str, float] = field(default_factory=dict)
    texts: list[str] = field(default_factory=list)
    #: Medians of columns that were full in training; a later null takes them, and the column keeps its type.
    full_numbers: dict[str, float] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> ImputeProfile:
        return ImputeProfile(**json.loads(text))


def _car_age(age: Column) -> Column:
    """Applicants without a car have a car age of 0."""
    return F.when(F.col(CAR_FLAG) == "N", F.lit(0.0)).otherwise(age)


def _car_age_zeroed(df: DataFrame) -> DataFrame:
    if CAR_AGE not in df.columns or CAR_FLAG not in df.columns:
        return df
    return df.withColumn(CAR_AGE, _car_age(F.col(CAR_AGE)))


def _keeps_type(f: T.StructField) -> bool:
    """Whether a fill leaves the column's type as it is: text, and numbers that are not categories by name."""
    return isinstance(f.dataType, T.StringType) or (isinstance(f.dataType, T.NumericType) and not is_category(f.name, f.dataType))


def fit_imputer(
    df: DataFrame,
    skip: tuple[str, ...] = (ID_COLUMN, LABEL_COLUMN),
    rows_per_range: int = ROWS_PER_RANGE,
    every_column: bool = False,
) -> ImputeProfile:
    """Fills of a training table. With ``every_column``, columns that are full get one too, for tables scored later."""
    zeroed = _car_age_zeroed(df)
    n_rows, raw_nulls = null_counts(df)
    dropped = [c for c in df.columns if is_droppable(c, raw_nulls[c] / n_rows if n_rows else 0.0)]
    kept = zeroed.drop(*dropped)
    # zeroing only touches the car age, so all other counts still hold
    nulls = dict(raw_nulls)
    if CAR_AGE in kept.columns and nulls.get(CAR_AGE):
        nulls[CAR_AGE] = null_counts(kept.select(CAR_AGE))[1][CAR_AGE]

    profile = ImputeProfile(dropped=dropped)
    medians_for: list[str] = []
    for f in kept.schema.fields:
        if f.name in skip:
            continue
        if f.name.startswith(SCORE_PREFIX):
            medians_for.append(f.name)
        elif nulls[f.name] == 0 and not (every_column and _keeps_type(f)):
            continue
        elif is_category(f.name, f.dataType):
            profile.texts.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            medians_for.append(f.name)
        else:
            profile.numbers[f.name] = NUMBER_DEFAULT
    for name, median in exact_medians(kept, medians_for, rows_per_range).items():
        if name.startswith(SCORE_PREFIX):
            profile.scores[name] = SCORE_DEFAULT if median is None else median
        elif nulls[name]:
            profile.numbers[name] = NUMBER_DEFAULT if median is None else median
        elif median is not None:
            profile.full_numbers[name] = median
    return profile


def _as_number(c: Column, data_type: T.DataType) -> Column:
    """A column of any type as a number: dates as days, times as microseconds."""
    if isinstance(data_type, T.DateType):
        c = F.unix_date(c)
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_micros(c.cast("timestamp"))
    return c.cast("double")


def imputed_columns(schema: T.StructType, profile: ImputeProfile) -> list[Column]:
    """The projection that fills a table of this schema; a job with many small batches builds it once."""
    types = {f.name: f.dataType for f in schema.fields if f.name not in profile.dropped}

    def treated(name: str) -> Column:
        c = F.col(f"`{name}`")
        if name == CAR_AGE and CAR_FLAG in types:
            c = _car_age(c)
        if name in profile.scores:
            c = F.coalesce(c.cast("double"), F.lit(float(profile.scores[name])))
        elif name in profile.texts:
            c = F.coalesce(c.cast("string"), F.lit("Missing"))
        elif name in profile.numbers:
            c = F.coalesce(_as_number(c, types[name]), F.lit(float(profile.numbers[name])))
        elif name in profile.full_numbers:
            c = F.coalesce(c, F.lit(float(profile.full_numbers[name])).cast(types[name]))
        if name in YES_NO_COLUMNS:
            c = yes_no_flag(c)
        return c.alias(name)

    flags = [F.col(f"`{c}`").isNull().cast("tinyint").alias(f"MISSING_{c}") for c in types if c in profile.scores]
    return [*[treated(c) for c in types], *flags]


def apply_imputer(df: DataFrame, profile: ImputeProfile) -> DataFrame:
    return df.select(*imputed_columns(df.schema, profile))


def impute(df: DataFrame, train: DataFrame | None = None, **kwargs) -> DataFrame:
    """Fit on ``train`` and apply to ``df``; without ``train`` the table is its own training data."""
    return apply_imputer(df, fit_imputer(df if train is None else train, **kwargs))


def align_to(df: DataFrame, columns: list[str], categories: list[str]) -> DataFrame:
    """Select ``columns``, adding absent ones as "Missing" or 0.0; other columns are kept first."""
    absent = [c for c in columns if c not in df.columns]
    defaults = [
        (F.lit("Missing") if c in categories else F.lit(0.0)).alias(c) for c in absent
    ]
    return df.select("*", *defaults)
