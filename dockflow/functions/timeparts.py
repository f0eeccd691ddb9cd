"""Calendar and clock columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of the hour and of the weekday, Monday first.
HOUR_LABEL = "HH:00"
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def epoch_to_ts(df: DataFrame, column: str) -> DataFrame:
    """Replace epoch seconds by the instant they name."""
    return df.withColumn(column, F.timestamp_seconds(F.col(column)))


def epoch_to_text(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` text in the session zone."""
    return df.withColumn(out or column, F.from_unixtime(F.col(column)))


def hour_of(ts: Column) -> Column:
    """The hour a timestamp falls in. A long underneath, so the cheapest key to group by."""
    return F.date_trunc("hour", ts)


def hour_label(ts: Column) -> Column:
    return F.date_format(ts, HOUR_LABEL)


def weekday_name(day_number: Column) -> Column:
    """Name of a ``weekday()`` number. Group by the number first, name the few groups afterwards."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), day_number + 1)


def year_month(ts: Column) -> Column:
    return F.year(ts) * 100 + F.month(ts)


def with_time_parts(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    """Date, year-month, year, month, hour and weekday of one timestamp column, under a common prefix."""
    at = F.col(ts)
    return df.withColumns(
        {
            f"{prefix}date": F.to_date(at),
            f"{prefix}year_month": year_month(at),
            f"{prefix}year": F.year(at),
            f"{prefix}month": F.month(at),
            f"{prefix}hour": F.hour(at),
            f"{prefix}hour_label": hour_label(at),
            f"{prefix}day_of_week": weekday_name(F.weekday(at)),
        }
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from one timestamp to the other; negative when they are out of order."""
    return F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))


def with_duration(df: DataFrame, start: str, end: str) -> DataFrame:
    """Trip length in seconds and as ``[-]HH:mm:ss``, where hours run past 24 instead of wrapping."""
    seconds = seconds_between(F.col(start), F.col(end))
    size = F.abs(F.col("duration_seconds"))
    label = F.concat(
        F.when(F.col("duration_seconds") < 0, "-").otherwise(""),
        F.format_string(
            "%02d:%02d:%02d",
            F.floor(size / 3600),
            F.floor(F.pmod(size, F.lit(3600)) / 60),
            F.pmod(size, F.lit(60)),
        ),
    )
    return df.withColumn("duration_seconds", seconds).withColumn(
        "trip_duration", F.when(F.col("duration_seconds").isNotNull(), label)
    )


def model_time(date: Column, label: Column) -> Column:
    """Timestamp of a (date, ``HH:00``) pair."""
    return F.to_timestamp(F.concat_ws(" ", date.cast("string"), label), "yyyy-MM-dd HH:mm")
