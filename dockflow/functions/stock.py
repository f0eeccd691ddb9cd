"""Stock level of a station as a message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest share of capacity for each message, fullest first; below the last one nothing is left.
STOCK_TIERS = [
    (0.5, "Enough Bikes Available"),
    (0.25, "Some Bikes Available, Restocking should be considered"),
    (0.1, "Few Bikes Available, Restocking should be immminent"),
]
STOCK_LOW = "Very Few Bikes Available, Restock As Soon As Possible"
STOCK_OUT = "No Bikes Available, Restock Now"


def stock_status(bikes: Column, capacity: Column) -> Column:
    """Message for the share of docks that hold a bike. Null stock gives a null message."""
    share = F.try_divide(bikes.cast("double"), capacity.cast("double"))
    tiers = F.when(share.isNull(), F.lit(None).cast("string"))
    for floor, message in STOCK_TIERS:
        tiers = tiers.when(share >= floor, message)
    return tiers.when(share > 0, STOCK_LOW).otherwise(STOCK_OUT)


def is_full(bikes: Column, capacity: Column) -> Column:
    """No free dock is left."""
    return bikes >= capacity
