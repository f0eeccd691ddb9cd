"""Join each row with the newest row of another table at or before its time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.operators.series import forward_fill


def tagged(left: DataFrame, right: DataFrame, ts: str, right_ts: str, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of both tables on one line of time: (by..., _at, _side, _row, _seen); at equal times the right ones first."""
    whole = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    seen = F.struct(F.col(right_ts).alias("at"), *[F.col(f"`{c}`") for c in columns])
    ours = left.select(*by, F.col(ts).alias("_at"), F.lit(1).alias("_side"), whole.alias("_row"))
    known = right.where(F.col(right_ts).isNotNull())
    for c in by:
        known = known.where(F.col(c).isNotNull())
    theirs = known.select(*by, F.col(right_ts).alias("_at"), F.lit(0).alias("_side"), seen.alias("_seen"))
    return ours.unionByName(theirs, allowMissingColumns=True)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    ts: str,
    right_ts: str,
    by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    tolerance: timedelta | None = None,
    prefix: str = "",
) -> DataFrame:
    """All rows of ``left`` with ``columns`` of the newest row of ``right`` at or before them, in the same series.

    Both times must have one type. A row with nothing before it, or nothing within ``tolerance``, or without a time or
    a series, has nulls. Of right rows of one series and time the one with the largest columns counts. The matched
    time comes along if ``right_ts`` is among the columns; ``prefix`` is put before the new names.

    There is no join on time. The tables are united, cut by range into blocks of about equal size, so that a series
    with half of all rows is spread over many tasks, and the last right row is carried along within a block and, one
    row per block, from block to block.
    """
    by = list(by)
    columns = [c for c in right.columns if c not in by] if columns is None else list(columns)
    rows = forward_fill(tagged(left, right, ts, right_ts, by, columns), by, "_at", ["_seen"], ties=["_side", "_seen"])
    near = F.col("_at").isNotNull()
    for c in by:
        near = near & F.col(c).isNotNull()
    if tolerance is not None:
        near = near & (F.col("_at") <= F.col("_seen.at") + F.expr(f"INTERVAL {int(tolerance.total_seconds())} SECONDS"))
    names = {c: f"_seen.`{c}`" if c != right_ts else "_seen.at" for c in columns}
    found = [F.when(near, F.col(source)).alias(f"{prefix}{c}") for c, source in names.items()]
    return rows.where("_side = 1").select("_row.*", *found)
