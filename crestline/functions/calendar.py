"""Business-calendar expressions: prime time, fiscal years, month ends."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """The lattice of business days and intervals of a day."""

    minutes: int = 60
    start: int = 8 * 60
    end: int = 17 * 60
    fiscal_start: int = 11
    holidays: frozenset[date] = field(default_factory=frozenset)

    def __post_init__(self):
        if self.minutes <= 0 or (self.end - self.start) % self.minutes:
            raise ValueError("the window must divide evenly into intervals")

    @property
    def per_day(self) -> int:
        return (self.end - self.start) // self.minutes

    def fiscal_year_of(self, day: date) -> int:
        return day.year + (day.month >= self.fiscal_start)

    def bounds(self, fiscal_year: int) -> tuple[date, date]:
        return date(fiscal_year - 1, self.fiscal_start, 1), date(fiscal_year, self.fiscal_start, 1) - timedelta(days=1)

    def horizon(self, anchor: date, years: int) -> tuple[date, date]:
        """The days after the anchor up to the end of the n-th fiscal year after the anchor's."""
        return anchor + timedelta(days=1), self.bounds(self.fiscal_year_of(anchor) + years)[1]


def business_day(day: Column, grid: Grid = Grid()) -> Column:
    out = F.weekday(day) < 5
    return out & ~day.isin(sorted(grid.holidays)) if grid.holidays else out


def fiscal_year(day: Column, grid: Grid = Grid()) -> Column:
    return (F.year(day) + (F.month(day) >= grid.fiscal_start).cast("int")).cast("int")


def interval_index(ts: Column, grid: Grid = Grid()) -> Column:
    """The interval that starts at ts, -1 outside the window or off the grid; seconds don't count."""
    at = F.hour(ts) * 60 + F.minute(ts)
    on = (at >= grid.start) & (at < grid.end) & ((at - grid.start) % grid.minutes == 0)
    return F.when(on, F.floor((at - grid.start) / grid.minutes)).otherwise(-1).cast("int")


def days(spark: SparkSession, start: date, end: date, grid: Grid = Grid()) -> DataFrame:
    """The calendar dimension: business_date, fiscal_year, month_end (fewer than two business days follow in its month), quarter_end, fy_position."""
    # One row a day of a few years, whole months so that month ends know what follows.
    first = start.replace(day=1)
    last = (end.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)
    day = F.col("business_date")
    df = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("business_date")).where(business_day(day, grid))
    month = Window.partitionBy(F.year(day), F.month(day)).orderBy(day)
    df = df.withColumn("month_end", F.count("*").over(month.rowsBetween(1, Window.unboundedFollowing)) < 2)
    fy = fiscal_year(day, grid)
    fy_start = F.make_date(fy - 1, F.lit(grid.fiscal_start), F.lit(1))
    fy_end = F.date_sub(F.make_date(fy, F.lit(grid.fiscal_start), F.lit(1)), 1)
    return df.where(day.between(F.lit(start), F.lit(end))).select(
        "business_date", fy.alias("fiscal_year"), "month_end",
        (F.col("month_end") & (F.month(day) % 3 == 0)).alias("quarter_end"),
        (F.datediff(day, fy_start) / F.datediff(fy_end, fy_start)).alias("fy_position"),
    )
