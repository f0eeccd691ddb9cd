"""Running totals over a global order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.llm.common import settle


def blocks(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """Rows cut into consecutive ranges of ``order``; ``_block`` numbers the ranges. Written once, so numbers are fixed."""
    return settle(df.repartitionByRange(*order).withColumn("_block", F.spark_partition_id()), label)


def running(
    df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column], label: str, by: Sequence[str] = ()
) -> DataFrame:
    """Add running totals (own row included) and ``_total_*`` whole totals of ``sums`` in ``order``.

    ``by`` must lead ``order`` and hold no nulls; totals then restart with each of its values. Blocks are totalled
    first; what a block starts from comes from one row per block and ``by`` value, which are as few as blocks plus
    values. A value with a third of all rows spans many blocks.
    """
    cut = blocks(df.withColumns({f"_add_{k}": v for k, v in sums.items()}), order, label)
    per = cut.groupBy("_block", *by).agg(*(F.sum(f"_add_{k}").alias(f"_sum_{k}") for k in sums))
    frame = Window.partitionBy(*by)
    upto = frame.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(
        "_block",
        *by,
        *(F.coalesce(F.sum(f"_sum_{k}").over(upto), F.lit(0)).alias(f"_before_{k}") for k in sums),
        *(F.sum(f"_sum_{k}").over(frame).alias(f"_total_{k}") for k in sums),
    )
    within = Window.partitionBy("_block", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = cut.withColumns({f"_run_{k}": F.sum(f"_add_{k}").over(within) for k in sums})
    joined = inner.join(offsets, ["_block", *by])
    return joined.withColumns({k: F.col(f"_run_{k}") + F.col(f"_before_{k}") for k in sums}).drop(
        "_block", *(f"_{p}_{k}" for k in sums for p in ("add", "run", "before"))
    )
