"""Dedup, latest/first per key, sort, union (D1-D9, K1/K2 upsert rule).

"First"/"latest" per key are aggregates (``min_by``/``max_by`` over an
explicit order struct), not windows: Spark combines them map-side, so a key
holding a third of all rows never lands whole in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Full-row (or subset) dedup; works on batch and stream frames."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def _pick(df: DataFrame, keys: list[str], order: list[str], fn) -> DataFrame:
    if not order:
        raise ValueError("an explicit order (tie-break included) is required")
    rest = [c for c in df.columns if c not in keys]
    payload = F.struct(*[F.col(c) for c in rest])
    ordering = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(*keys).agg(fn(payload, ordering).alias("_row"))
    return agg.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def first_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """D3: keep the first row per key by ``order`` (ascending)."""
    return _pick(df, keys, order, F.min_by)


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """D5 / K1-K2 upsert rule: keep the newest row per key by ``order``."""
    return _pick(df, keys, order, F.max_by)


def latest_overall(df: DataFrame, order: list[str], n: int = 1) -> DataFrame:
    """Top-n by ``order`` descending (TakeOrderedAndProject: each task keeps
    n rows, the driver merges n x tasks)."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def sort_by(df: DataFrame, cols: list[str], ascending: bool = True) -> DataFrame:
    """Global sort (range-partitioned)."""
    return df.orderBy(*[F.col(c).asc() if ascending else F.col(c).desc() for c in cols])


def union_all(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Bag union by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
