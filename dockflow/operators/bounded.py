"""Inventory that stays between nothing and the docks: a prefix scan of clamp functions.

A step takes a stock x to ``min(max(x + a, lo), hi)``. Such functions are closed under composition, so the steps of a
block become one function of three numbers, whatever the stock the block starts with. Blocks are composed on their own,
wherever they lie; one row per series and block then carries the stock from block to block, and each block is gone
through once more from the stock it starts with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.stock import is_full, stock_status
from dockflow.spec import DEFAULT_CAPACITY

_FAR = 1 << 50
_CLAMP = "struct<add:bigint,low:bigint,high:bigint,known:boolean>"


def _clamp(add: Column, low: Column, high: Column, known: Column) -> Column:
    return F.struct(add.alias("add"), low.alias("low"), high.alias("high"), known.alias("known")).cast(_CLAMP)


def apply_clamp(clamp: Column, stock: Column) -> Column:
    """The stock after a composed step; null if the stock or a step of it is unknown."""
    after = F.least(F.greatest(stock + clamp["add"], clamp["low"]), clamp["high"])
    return F.when(stock.isNotNull() & clamp["known"], after)


def then(first: Column, second: Column) -> Column:
    """One clamp for two, the first applied first."""
    through = lambda x: F.least(F.greatest(x + second["add"], second["low"]), second["high"])
    return _clamp(first["add"] + second["add"], through(first["low"]), through(first["high"]), first["known"] & second["known"])


def bounded_inventory(
    forecast: DataFrame,
    stock: Column | int,
    by: Sequence[str] = ("station",),
    ts: str = "ds",
    change: str = "yhat",
    capacity: Column | int = DEFAULT_CAPACITY,
    block: str = "day",
) -> DataFrame:
    """Stock after each forecast step, never below 0 or above the docks, and what the bounds turned away.

    Adds ``num_bikes_available``, ``lost_departures`` (riders who found no bike), ``lost_arrivals`` (riders who found no
    dock), ``status_message`` and ``is_full``. The rounded change of a step (halves to even) is applied first and then
    cut; ``stock`` is the stock before a series' first step, a number or a column of which the first row counts. From
    the first missing change on the stock is unknown and null, as it is everywhere if it is unknown at the start or the
    docks are. Steps of one series and time are taken in the order of their change, rises last. Null keys are a series.

    ``block`` is a time unit that holds few steps of a series, since its steps are gone through in one place.
    """
    by = list(by)
    docks = capacity if isinstance(capacity, Column) else F.lit(capacity)
    start = stock if isinstance(stock, Column) else F.lit(stock)
    names = [c for c in forecast.columns]
    step = F.struct(
        F.col(ts).alias("at"),
        F.bround(F.col(change)).cast("long").alias("change"),
        docks.cast("long").alias("docks"),
        start.cast("long").alias("start"),
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
    )
    series = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    steps = forecast.select(series.alias("series"), F.date_trunc(block, F.col(ts)).alias("block"), step.alias("step"))
    blocks = steps.groupBy("series", "block").agg(F.sort_array(F.collect_list("step")).alias("steps"))

    def one(s: Column) -> Column:
        known = s["change"].isNotNull() & s["docks"].isNotNull()
        return _clamp(F.coalesce(s["change"], F.lit(0)), F.lit(0), F.coalesce(s["docks"], F.lit(0)), known)

    nothing = _clamp(F.lit(0), F.lit(-_FAR), F.lit(_FAR), F.lit(True))
    composed = F.aggregate("steps", nothing, lambda all_, s: then(all_, one(s)))
    heads = blocks.select("series", F.struct("block", composed.alias("clamp"), F.get("steps", F.lit(0))["start"].alias("start")).alias("b"))
    lines = heads.groupBy("series").agg(F.sort_array(F.collect_list("b")).alias("blocks"))
    carried = "struct<stock:bigint,starts:array<struct<block:timestamp,stock:bigint>>>"
    first = F.get("blocks", F.lit(0))["start"]
    empty = F.array().cast("array<struct<block:timestamp,stock:bigint>>")
    walk = F.aggregate(
        "blocks",
        F.struct(first.alias("stock"), empty.alias("starts")).cast(carried),
        lambda a, b: F.struct(
            apply_clamp(b["clamp"], a["stock"]).alias("stock"),
            F.concat(a["starts"], F.array(F.struct(b["block"].cast("timestamp").alias("block"), a["stock"].alias("stock")))).alias("starts"),
        ).cast(carried),
    )
    starts = lines.select("series", F.explode(walk["starts"]).alias("s")).select("series", F.col("s.block").alias("from"), F.col("s.stock").alias("stock"))
    # a null block holds the steps without a time; it comes first and is matched by null-safe equality
    same = (blocks["series"] == starts["series"]) & blocks["block"].cast("timestamp").eqNullSafe(starts["from"])
    opened = blocks.join(starts, same).select("steps", "stock")
    result = "num_bikes_available bigint, lost_departures bigint, lost_arrivals bigint"
    kept = forecast.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).schema["row"].dataType.simpleString()
    state = f"struct<stock:bigint,rows:array<struct<row:{kept},out:struct<{result.replace(' bigint', ':bigint')}>>>>"

    def go(a: Column, s: Column) -> Column:
        wish = a["stock"] + s["change"]
        after = F.when(wish.isNotNull() & s["docks"].isNotNull(), F.least(F.greatest(wish, F.lit(0)), s["docks"]))
        out = F.struct(
            after.alias("num_bikes_available"),
            F.when(after.isNotNull(), F.greatest(-wish, F.lit(0))).alias("lost_departures"),
            F.when(after.isNotNull(), F.greatest(wish - s["docks"], F.lit(0))).alias("lost_arrivals"),
        )
        row = F.struct(s["row"].alias("row"), out.alias("out"))
        return F.struct(after.alias("stock"), F.concat(a["rows"], F.array(row)).alias("rows")).cast(state)

    begin = F.struct(F.col("stock"), F.array().cast(state[state.index("rows:") + 5 : -1]).alias("rows")).cast(state)
    done = opened.select(F.explode(F.aggregate("steps", begin, go)["rows"]).alias("r")).select("r.row.*", "r.out.*")
    bikes = F.col("num_bikes_available")
    return done.withColumns({"status_message": stock_status(bikes, docks), "is_full": is_full(bikes, docks)})
