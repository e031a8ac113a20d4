"""Duplicate handling by key, as aggregates with map-side combine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only rows whose key occurs once; all members of a duplicate set go."""
    others = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("copies"), *[F.any_value(c).alias(c) for c in others])
        .where(F.col("copies") == 1)
        .select(*df.columns)
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by `order`; the remaining columns break ties.

    The least of a struct: combined before the shuffle, by sorting where Spark keeps no hash table for structs.
    """
    others = [c for c in df.columns if c not in keys]
    ranked = F.struct(*order, *[c for c in others if c not in order])
    return (
        df.groupBy(*keys)
        .agg(F.min(ranked).alias("row"))
        .select(*keys, "row.*")
        .select(*df.columns)
    )


def split_by(df: DataFrame, condition) -> tuple[DataFrame, DataFrame]:
    """Rows that meet a condition and the rest; a null condition counts as not met."""
    met = F.coalesce(condition, F.lit(False))
    return df.where(met), df.where(~met)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values, null included as a value."""
    return df.select(column).distinct().agg(F.count("*").alias("n"))
