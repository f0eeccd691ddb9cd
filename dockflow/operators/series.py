"""Ordered computations on station series: running totals, gap filling, exact percentiles, future hours.

A window over a whole series runs as one task, and one station may hold a large share of all rows. Running totals and
fills are therefore done within blocks; only one small row per series and block goes into the window that carries
state from block to block. Blocks are ranges of the series' rows, cut by Spark to about equal size, so a station that
reports a million times a day is spread over many; the ranges are written once and read for rows and for blocks.
Where rows per series and time are known to be few, as in hourly tables, blocks can be time units instead, which need
no exchange by range. Null keys are a series of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.sources.writers import settle


def _blocked(df: DataFrame, by: Sequence[str], ts: str, ties: Sequence[str], block: str | None) -> DataFrame:
    # one struct key per series: it is never null itself, so plain equality also matches series with null names
    df = df.withColumn("_series", F.struct(*by) if by else F.lit(0))
    if block:
        return df.withColumn("_block", F.date_trunc(block, F.col(ts)))
    ranged = df.repartitionByRange(*[F.col(c) for c in (*by, ts, *ties)])
    return settle(ranged.withColumn("_block", F.spark_partition_id()), "series-blocks")


def _carry(blocks: DataFrame, columns: dict) -> DataFrame:
    """Per series, state at the start of each block from the blocks before it."""
    before = W.partitionBy("_series").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    return blocks.select("_series", "_block", *[fold.over(before).alias(name) for name, fold in columns.items()])


def _join_carry(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Bring the state to the rows. Plain equality, so rows already placed by series and block stay where they are."""
    return rows.join(carry, ["_series", "_block"], "left")


def running_total(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    value: str,
    out: str,
    ties: Sequence[str] = (),
    block: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Sum of ``value`` up to and including each row of its series.

    Missing values add nothing; with ``strict`` the total is unknown, null, from the first missing value on. ``block``
    names a time unit that holds few rows of a series; without it rows are cut by range.
    """
    rows = _blocked(df, by, ts, ties, block)
    inside = W.partitionBy("_series", "_block").orderBy(ts, *ties).rowsBetween(W.unboundedPreceding, 0)
    gap = F.when(F.col(value).isNull(), 1).otherwise(0)
    local = rows.withColumns({out: F.coalesce(F.sum(value).over(inside), F.lit(0)), "_gaps": F.sum(gap).over(inside)})
    totals = rows.groupBy("_series", "_block").agg(F.sum(value).alias("_total"), F.sum(gap).alias("_missing"))
    carry = _carry(totals, {"_before": F.sum("_total"), "_lost": F.sum("_missing")})
    total = F.col(out) + F.coalesce(F.col("_before"), F.lit(0))
    if strict:
        total = F.when(F.col("_gaps") + F.coalesce("_lost", F.lit(0)) == 0, total)
    return _join_carry(local, carry).withColumn(out, total).select(*df.columns, out)


def forward_fill(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    columns: Sequence[str],
    ties: Sequence[str] = (),
    block: str | None = None,
) -> DataFrame:
    """Replace nulls by the last earlier value of the same series; leading nulls stay.

    ``block`` names a time unit that holds few rows of a series; without it rows are cut by range. What a block hands
    on is its last filled row, so nothing is aggregated over structs.
    """
    rows = _blocked(df, by, ts, ties, block)
    order = W.partitionBy("_series", "_block").orderBy(ts, *ties)
    inside = order.rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns})
    ends = rows.select(
        "_series",
        "_block",
        F.lead(F.lit(1)).over(order).alias("_more"),
        *[F.last(c, ignorenulls=True).over(inside).alias(f"_tail_{c}") for c in columns],
    ).where(F.col("_more").isNull())
    carry = _carry(ends, {f"_carry_{c}": F.last(f"_tail_{c}", ignorenulls=True) for c in columns})
    filled = {c: F.coalesce(F.col(c), F.col(f"_carry_{c}")) for c in columns}
    return _join_carry(local, carry).withColumns(filled).select(df.columns)


def future_hours(df: DataFrame, by: Sequence[str], ts: str, hours: int = 24) -> DataFrame:
    """The next ``hours`` whole hours after each series' last row."""
    step = F.expr("INTERVAL 1 HOUR")
    last = df.groupBy(*by).agg(F.max(ts).alias("_last"))
    ahead = F.sequence(F.col("_last") + step, F.col("_last") + F.expr(f"INTERVAL {int(hours)} HOURS"), step)
    return last.select(*by, F.explode(ahead).alias(ts))


def future_frame(df: DataFrame, by: Sequence[str], ts: str, hours: int = 24) -> DataFrame:
    """Times of the history and of the next ``hours``; ``is_future`` tells them apart."""
    past = df.select(*by, ts).withColumn("is_future", F.lit(False))
    return past.unionByName(future_hours(df, by, ts, hours).withColumn("is_future", F.lit(True)))


def _slice_of(value: Column, grain: int) -> Column:
    """Number of a value's slice: monotone in the value, about ``1/grain`` wide relative to its size.

    Infinities have the outermost slices, and NaN one after all others, as Spark orders it.
    """
    edge = 1 << 62
    finite = F.floor(F.signum(value) * F.log1p(F.abs(value) * float(1 << 20)) * grain).cast("long")
    return (
        F.when(F.isnan(value), F.lit(edge + 1))
        .when(value == float("inf"), F.lit(edge))
        .when(value == float("-inf"), F.lit(-edge))
        .otherwise(finite)
    )


#: Items a sketch keeps at its widest; its rank error is then about 0.2 % of the rows.
SKETCH_SIZE = 1600


def sketch_columns(value: Column, k: int = SKETCH_SIZE) -> list[Column]:
    """Aggregates from which :func:`exact_percentiles` starts: values, those that are numbers, and a KLL sketch of these.

    They can stand beside other aggregates, so that one pass serves both. Sketches of parts, such as days, merge with
    ``kll_merge_agg_double`` into that of the whole.
    """
    plain = F.when(~F.isnan(value), value)
    return [F.count(value).alias("_rows"), F.count(plain).alias("_plain"), F.kll_sketch_agg_double(plain, k).alias("_sketch")]


def _brackets(sketches: DataFrame, keys: Sequence[str], probabilities: Sequence[float], k: int, slack: float) -> DataFrame:
    """For each probability the two ranks it lies between, and values that enclose them as far as a sketch can tell."""
    error = slack * 2.3 / k**0.97
    # ranks move by one row at most between all rows and the sketch's share, and by any number where there are NaNs
    narrow = (F.col("_plain") == F.col("_rows")) & (F.col("_plain") * error > 4)
    found = []
    for p in probabilities:
        spot = (F.col("_rows") - 1) * float(p)
        at = lambda rank: F.kll_sketch_get_quantile_double("_sketch", F.lit(rank))
        low, high = F.lit(float("-inf")), F.lit(float("nan"))
        if p - error > 0:
            low = F.when(narrow, at(p - error)).otherwise(low)
        if p + error < 1:
            high = F.when(narrow, at(p + error)).otherwise(high)
        found.append(F.struct(F.floor(spot).cast("long").alias("first"), F.ceil(spot).cast("long").alias("last"), low.alias("low"), high.alias("high")))
    return sketches.where("_rows > 0").select(*keys, "_rows", F.array(*found).alias("_wanted"))


def exact_percentiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    grain: int = 4096,
    sketches: DataFrame | None = None,
    k: int = SKETCH_SIZE,
) -> DataFrame:
    """Exact, interpolated percentiles of each group, as an array column ``percentiles``.

    The built-in exact ``percentile`` keeps every distinct value of a group in one task's memory. Here a first pass
    makes a quantile sketch of each group, which says between which values a wanted rank lies; give ``sketches``, one
    row per group with :func:`sketch_columns` and better a written table, to spare it. A second pass counts what is below, and counts equal values
    together only between: well under one percent of the rows are ordered and written, by narrow value slices if they
    are still many. A rank that a sketch missed is looked for again between wider bounds, so results are exact.

    NaN and infinities count as values, in Spark's order. Groups without a value have no row. A slice is ``1/grain``
    wide relative to its values; raise ``grain`` for values that are large against their spread, such as epochs.
    """
    by = list(by)
    keys = by or ["_all"]
    rows = df.select(*(by or [F.lit(0).alias("_all")]), F.col(value).cast("double").alias("_value")).where(F.col("_value").isNotNull())
    if sketches is None:
        sketches = settle(rows.groupBy(*keys).agg(*sketch_columns(F.col("_value"), k)), "percentile-sketches")
    elif not by:
        sketches = sketches.withColumn("_all", F.lit(0))
    sketches = sketches.select(*keys, "_rows", "_plain", "_sketch")
    parts, slack = [], 2.0
    while True:
        bounds = _brackets(sketches, keys, probabilities, k, slack)
        found = settle(_ranked_values(rows, bounds, keys, grain), "percentile-ranks")
        whole = F.size("_at") == F.size(F.array_distinct(F.flatten(F.transform("_wanted", lambda w: F.array(w["first"], w["last"])))))
        parts.append(found.where(whole))
        rest = found.where(~whole)
        if rest.isEmpty():
            break
        missed = rest.select(*[F.col(c).alias(f"_w_{c}") for c in keys])
        sketches, slack = sketches.join(missed, _same(sketches, missed, keys), "left_semi"), slack * 16
    done = parts[0]
    for more in parts[1:]:
        done = done.unionAll(more)

    def interpolated(p: float):
        spot = (F.col("_rows") - 1) * float(p)
        low = F.element_at("_at", F.floor(spot).cast("long"))
        high = F.element_at("_at", F.ceil(spot).cast("long"))
        part = spot - F.floor(spot)
        return F.when((part == 0) | (low == high), low).otherwise(low * (1 - part) + high * part)

    return done.select(*by, F.array(*[interpolated(p) for p in probabilities]).alias("percentiles"))


def _same(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> Column:
    match = F.lit(True)
    for c in keys:
        match = match & rows[c].eqNullSafe(other[f"_w_{c}"])
    return match


def _ranked_values(rows: DataFrame, bounds: DataFrame, keys: Sequence[str], grain: int) -> DataFrame:
    """(keys, _rows, _wanted, _at): the values at the wanted ranks that lie between their bounds, by rank.

    Every value is below, between or above the bounds of each probability. Those below are counted, those above left
    out, and those between counted by value, in one aggregate whose partial sums take in what is below at once.
    """
    plain = bounds.select(*[F.col(c).alias(f"_w_{c}") for c in keys], F.col("_rows"), F.col("_wanted"))
    near = rows.join(plain, _same(rows, plain, keys))
    v = F.col("_value")
    spots = F.transform(
        "_wanted",
        lambda w, i: F.when(v < w["low"], F.struct(i.alias("_spot"), F.lit(None).cast("double").alias("_value"))).when(
            v <= w["high"], F.struct(i.alias("_spot"), v.alias("_value"))
        ),
    )
    counts = near.select(*keys, F.explode(F.filter(spots, lambda x: x.isNotNull())).alias("_s")).select(*keys, "_s.*")
    counts = settle(
        counts.groupBy(*keys, "_spot", "_value").agg(F.count(F.lit(1)).alias("_copies")).withColumn("_slice", _slice_of(F.col("_value"), grain)),
        "percentile-counts",
    )
    slices = counts.groupBy(*keys, "_spot", "_slice").agg(F.sum("_copies").alias("_size"))
    upto = F.sum("_size").over(W.partitionBy(*keys, "_spot").orderBy(F.col("_slice").asc_nulls_first()))
    slices = slices.withColumn("_upto", upto).where(F.col("_slice").isNotNull())
    ranked = slices.join(plain, _same(slices, plain, keys)).withColumn("_w", F.get("_wanted", F.col("_spot")))
    ranks = F.array_distinct(F.array("_w.first", "_w.last"))
    held = F.filter(ranks, lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("_size")))
    wanted = (
        ranked.withColumn("_ranks", held)
        .where(F.size("_ranks") > 0)
        .select(*[F.col(c).alias(f"_w_{c}") for c in [*keys, "_spot", "_slice"]], "_ranks", (F.col("_upto") - F.col("_size")).alias("_skip"))
    )
    inside = F.sum("_copies").over(W.partitionBy(*keys, "_spot", "_slice").orderBy("_value")) + F.col("_skip")
    placed = counts.join(wanted, _same(counts, wanted, [*keys, "_spot", "_slice"])).withColumn("_upto", inside)
    hit = F.filter("_ranks", lambda r: (r < F.col("_upto")) & (r >= F.col("_upto") - F.col("_copies")))
    hits = placed.select(*keys, F.explode(hit).alias("_rank"), "_value").distinct()
    at = hits.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))
    nothing = F.map_from_arrays(F.array().cast("array<bigint>"), F.array().cast("array<double>"))
    whole = plain.join(at, _same(at, plain, keys), "left").withColumn("_at", F.coalesce("_at", nothing))
    return whole.select(*[F.col(f"_w_{c}").alias(c) for c in keys], "_rows", "_wanted", "_at")
