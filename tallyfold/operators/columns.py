"""Column-level steps: names, dates, alignment. One projection each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.config import ConfigError, clean_name
from tallyfold.functions import text as X

# Columns the record check adds, and the mark of a date column.
OUTCOME_COLUMNS = (
    "DataQualityRulesPass",
    "DataQualityRulesFail",
    "DataQualityRulesSkip",
    "DataQualityEvaluationResult",
)
DATE_MARK = "_DATE"


def clean_names(df: DataFrame) -> DataFrame:
    names = [clean_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ConfigError(f"cleaning makes column names collide: {', '.join(twice)}")
    return df.toDF(*names)


def date_columns(names: Sequence[str], chosen: Sequence[str] | None = None) -> list[str]:
    """The columns that hold dates: those of a list, or those whose name contains the date mark."""
    return [c for c in names if (c in chosen if chosen is not None else DATE_MARK in c)]


def parse_dates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """yyyyMMdd text to dates, null where unreadable.

    Without a list, every column whose name contains the date mark is taken.
    """
    chosen = set(date_columns(df.columns, columns))

    def shaped(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if f.name not in chosen or isinstance(f.dataType, T.DateType):
            return c
        return X.date_or_null(c.cast("string")).alias(f.name)

    return df.select([shaped(f) for f in df.schema.fields])


def drop_outcomes(df: DataFrame) -> DataFrame:
    return df.drop(*OUTCOME_COLUMNS)


def align(df: DataFrame, like: DataFrame, add_missing: bool = False) -> DataFrame:
    """Columns of `df` in the order of `like`; absent ones as nulls on request."""
    have = set(df.columns)
    absent = [f for f in like.schema.fields if f.name not in have]
    if absent and not add_missing:
        raise ConfigError("missing columns: " + ", ".join(f.name for f in absent))
    filled = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}) if absent else df
    return filled.select(*[F.col(f"`{c}`") for c in like.columns])


def pick(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Configured columns; unknown ones are an error before any job runs."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ConfigError("unknown columns: " + ", ".join(absent))
    return df.select(*[F.col(f"`{n}`") for n in names])
