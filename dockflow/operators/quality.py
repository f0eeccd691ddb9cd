"""Table checks and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, one row, one pass."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def duplicate_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count, distinct key count and whether they differ. A null key counts as one value.

    Rows are counted per key before the shuffle, so a key with many copies travels as one row per task.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumn("has_duplicates", F.col("total_rows") != F.col("distinct_rows"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in a given order.

    A rank filter: Spark applies it within each task before the shuffle and again after it, so a hot key sends at
    most ``n`` rows per task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key. Without an order the remaining columns decide, so the choice is the same on every run."""
    rest = [c for c in df.columns if c not in keys]
    return first_per_key(df, keys, order or rest or list(keys))


def unique_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of some columns."""
    return df.select(*columns).distinct()
