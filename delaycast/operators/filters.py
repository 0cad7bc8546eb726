"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_col
from ..functions.timeops import shift


def equals(df: DataFrame, col: str, value) -> DataFrame:
    """equality filter (pushed to the Parquet scan)."""
    return df.where(F.col(col) == F.lit(value))


def recent(df: DataFrame, ts_col: str, seconds: float, within: DataFrame | None = None) -> DataFrame:
    """rows with ``ts >= max(ts) - seconds``; max taken over the data
    itself (or over ``within``) as a scalar subquery - no cross join, no
    driver round trip in the plan."""
    src = within if within is not None else df
    anchor = src.select(F.max(F.col(ts_col))).scalar()
    return df.where(F.col(ts_col) >= shift(anchor, -seconds))


def regex_contains_ci(text, pattern) -> Column:
    """case-insensitive regex containment with a per-row pattern."""
    return F.rlike(as_col(text), F.concat(F.lit("(?i)"), as_col(pattern)))


def quote_regex(c) -> Column:
    """Escape regex metacharacters in per-row text used inside a pattern."""
    return F.regexp_replace(as_col(c), r"([\\.\[\]\{\}\(\)\*\+\?\^\$\|])", r"\\$1")


def drop_any_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """drop rows holding a null in any (or the given) column."""
    return df.na.drop("any", subset=subset)


def file_name_contains(df: DataFrame, text: str, whole_path: bool = False) -> DataFrame:
    """keep rows whose source file name (or path) contains ``text`` exactly once."""
    name = F.col("_metadata.file_path" if whole_path else "_metadata.file_name")
    n = (F.length(name) - F.length(F.replace(name, F.lit(text), F.lit("")))) / F.lit(len(text))
    return df.where(n == 1)
