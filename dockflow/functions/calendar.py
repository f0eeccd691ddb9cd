"""Holidays and weekends as column rules, and a calendar table built from them.

A rule reads only the month, the day and the weekday of a date, so flagging a table needs neither a join nor a lookup
in Python. Holidays that follow no such rule come in through a caller's own (date, holiday_name) table.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MON, TUE, WED, THU, FRI, SAT, SUN = range(7)
LAST = -1


class OnDay(NamedTuple):
    name: str
    month: int
    day: int
    since: int = 0


class OnWeekday(NamedTuple):
    """The nth (or last) given weekday of a month; ``shift`` days later."""

    name: str
    month: int
    weekday: int
    nth: int
    shift: int = 0


# Federal holidays, and those the extended set adds.
FEDERAL = [
    OnDay("New Year's Day", 1, 1),
    OnWeekday("Martin Luther King Jr. Day", 1, MON, 3),
    OnWeekday("Presidents' Day", 2, MON, 3),
    OnWeekday("Memorial Day", 5, MON, LAST),
    OnDay("Independence Day", 7, 4),
    OnWeekday("Labor Day", 9, MON, 1),
    OnWeekday("Columbus Day", 10, MON, 2),
    OnDay("Veterans Day", 11, 11),
    OnWeekday("Thanksgiving Day", 11, THU, 4),
    OnDay("Christmas Day", 12, 25),
]
EXTENDED = FEDERAL + [
    OnDay("Lincoln's Birthday", 2, 12),
    OnDay("Susan B. Anthony Day", 2, 15),
    OnDay("Juneteenth", 6, 19, 2021),
    OnWeekday("Election Day", 11, MON, 1, 1),
]
RULES = {"federal": FEDERAL, "extended": EXTENDED}
# The span over which the reproduced off-day flag knows weekends, and the years of its holidays.
OFF_DAY_WEEKENDS = ("2021-01-01", "2023-03-31")
OFF_DAY_YEARS = (2021, 2023)


def _falls_on(rule: OnDay | OnWeekday, date: Column) -> Column:
    if isinstance(rule, OnDay):
        hit = (F.month(date) == rule.month) & (F.dayofmonth(date) == rule.day)
        return hit & (F.year(date) >= rule.since) if rule.since else hit
    date = F.date_sub(date, rule.shift) if rule.shift else date
    day = F.dayofmonth(date)
    if rule.nth == LAST:
        week = F.dayofmonth(F.last_day(date)) - day < 7
    else:
        week = F.ceil(day / 7) == rule.nth
    return (F.month(date) == rule.month) & (F.weekday(date) == rule.weekday) & week


def _moved_to(rule: OnDay | OnWeekday, date: Column) -> Column:
    """The Friday before or the Monday after a fixed holiday that falls on a weekend."""
    if not isinstance(rule, OnDay):
        return F.lit(False)
    return ((F.weekday(date) == FRI) & _falls_on(rule, F.date_add(date, 1))) | (
        (F.weekday(date) == MON) & _falls_on(rule, F.date_sub(date, 1))
    )


def holiday_name(date: Column, rules: str = "federal") -> Column:
    """Name of the holiday on a date, else null. The extended set also has the weekday a weekend holiday moves to."""
    chosen = RULES[rules]
    named = [F.when(_falls_on(r, date), F.lit(r.name)) for r in chosen]
    if rules == "extended":
        fixed = [r for r in chosen if isinstance(r, OnDay)]
        named += [F.when(_moved_to(r, date), F.lit(f"{r.name} (Observed)")) for r in fixed]
    return F.coalesce(*named)


def holiday_flags(date: Column, rules: str = "federal") -> list[Column]:
    """One 0/1 column per holiday of the set; in the extended set a moved holiday counts on both days."""
    hits = [_falls_on(r, date) | _moved_to(r, date) if rules == "extended" else _falls_on(r, date) for r in RULES[rules]]
    return [F.coalesce(hit, F.lit(False)).cast("double") for hit in hits]


def is_holiday(date: Column, rules: str = "federal") -> Column:
    """True on a holiday; false, never null, for a missing date."""
    return holiday_name(date, rules).isNotNull()


def is_weekend(date: Column) -> Column:
    return F.coalesce(F.weekday(date) >= SAT, F.lit(False))


def is_off_day(
    date: Column,
    weekends: tuple[str, str] | None = None,
    years: tuple[int, int] | None = None,
    rules: str = "federal",
) -> Column:
    """Holiday or weekend, each optionally known over a limited span only."""
    weekend = is_weekend(date)
    if weekends:
        weekend = weekend & date.between(*[F.lit(d).cast("date") for d in weekends])
    holiday = is_holiday(date, rules)
    if years:
        holiday = holiday & F.year(date).between(*years)
    return F.coalesce(weekend | holiday, F.lit(False))


def _describe(days: DataFrame, rules: str) -> DataFrame:
    date = F.col("date")
    return days.select(
        "date",
        is_weekend(date).alias("is_weekend"),
        is_holiday(date, rules).alias("is_holiday"),
        is_off_day(date, rules=rules).alias("is_off_day"),
        holiday_name(date, rules).alias("holiday_name"),
    )


def calendar(spark: SparkSession, start: str, end: str, rules: str = "federal") -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    first, last = (F.lit(d).cast("date") for d in (start, end))
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("date"))
    return _describe(days, rules)


def calendar_of(df: DataFrame, ts: str, rules: str = "federal", most_days: int = 73_200) -> DataFrame:
    """One row per day of the span a table covers, days without rows included.

    A span of over ``most_days`` comes from a wrong date and stops the run; :func:`calendar` takes the span instead.
    """
    span = df.agg(F.min(ts).cast("date").alias("first"), F.max(ts).cast("date").alias("last"))
    message = F.concat(F.lit("dates from "), F.col("first").cast("string"), F.lit(" to "), F.col("last").cast("string"))
    last = F.when(F.datediff("last", "first") > most_days, F.raise_error(message).cast("date")).otherwise(F.col("last"))
    days = span.where(F.col("first").isNotNull()).select(F.explode(F.sequence(F.col("first"), last)).alias("date"))
    return _describe(days, rules)


def flag_holidays(
    df: DataFrame, date: str, holidays: DataFrame | None = None, rules: str = "federal"
) -> DataFrame:
    """Add ``is_holiday``, by rule or from a table with a ``date`` column.

    The table side is reduced to one row per date, so the join never multiplies rows. It carries no hint: Spark
    broadcasts it when its size allows and joins by sort and merge when it does not.
    """
    if holidays is None:
        return df.withColumn("is_holiday", is_holiday(F.col(date), rules))
    marks = holidays.select(F.col("date").alias(date)).distinct().withColumn("_mark", F.lit(True))
    return (
        df.join(marks, date, "left")
        .withColumn("is_holiday", F.coalesce("_mark", F.lit(False)))
        .drop("_mark")
    )
