"""A synthetic source: a seeded panel of apps with shared swings, heavy tails, growth, month ends and labelled events.

Every draw is a function of the seed and of the cell, so rows are the same however they are partitioned, and
the panel is made by the executors. Only the calendar and the events, a few rows, are made on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from math import pi

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.functions import calendar as cal
from crestline.operators.ingest import label
from crestline.sources.lake import clipped, register_source


@dataclass(frozen=True)
class Spec:
    """What the panel is like. Events are (kind, how many, factor, share of apps)."""

    start: date = date(2023, 11, 1)
    end: date = date(2025, 10, 31)
    apps: int = 35
    lpars: tuple[str, ...] = ("PRDA", "PRDB")
    seed: int = 20260101
    noise: float = 0.12
    common: float = 1.0
    freedom: int = 5
    events: tuple[tuple[str, int, float, float], ...] = (("DR", 4, 3.0, 1.0), ("IST", 6, 1.8, 0.35), ("GCC_SDF", 3, 2.4, 0.6))


def uniform(seed: int, name: str, *keys: str) -> Column:
    """A draw strictly between 0 and 1 from the seed, a name and the cell."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(name), *keys), 12) + F.lit(0.5)) / F.lit(2.0**52)


def normal(seed: int, name: str, *keys: str) -> Column:
    return F.sqrt(-2 * F.log(uniform(seed, f"{name}/r", *keys))) * F.cos(2 * pi * uniform(seed, f"{name}/a", *keys))


def _apps(spark: SparkSession, spec: Spec) -> DataFrame:
    n = lambda name, mean, sd: F.lit(mean) + sd * normal(spec.seed, name, "k")
    u = lambda name, low, high: F.lit(low) + (high - low) * uniform(spec.seed, name, "k")
    lpar = F.get(F.lit(list(spec.lpars)), (F.col("k") % len(spec.lpars)).cast("int"))
    return spark.range(1, spec.apps + 1).withColumnRenamed("id", "k").select(
        "k", F.concat(F.lit("APP"), F.lpad(F.col("k").cast("string"), 3, "0")).alias("app_id"), lpar.alias("lpar"),
        F.exp(n("level", np.log(120.0), 0.9)).alias("level"), u("at", 0.15, 0.92).alias("at"), u("width", 0.06, 0.22).alias("width"),
        F.exp(n("growth", 0.03, 0.05)).alias("growth"), F.exp(n("month", 0.12, 0.1)).alias("month_lift"), F.exp(n("quarter", 0.22, 0.12)).alias("quarter_lift"), u("beta", 0.3, 1.6).alias("beta"),
    )


def _days(spark: SparkSession, spec: Spec, grid: cal.Grid) -> DataFrame:
    """The calendar with a shared swing that carries over from day to day."""
    known = cal.days(spark, spec.start, spec.end, grid).orderBy("business_date").collect()
    if not known:
        raise ValueError("no business days")
    rng, swing, rows = np.random.default_rng(spec.seed), 0.0, []
    for i, r in enumerate(known):
        swing = 0.55 * swing + (0.09 * rng.standard_normal() if i else 0.0)
        rows.append((r["business_date"], r["fiscal_year"], r["month_end"], r["quarter_end"], (r["business_date"] - known[0]["business_date"]).days / 365.25, float(swing)))
    return spark.createDataFrame(rows, "business_date date, fiscal_year int, month_end boolean, quarter_end boolean, years double, swing double")


def events(spark: SparkSession, spec: Spec, grid: cal.Grid = cal.Grid()) -> DataFrame:
    """event_seq, event_id, event_type, lpar, app_id, start_ts, end_ts, note and factor: windows inside prime time."""
    days = [r[0] for r in cal.days(spark, spec.start, spec.end, grid).select("business_date").orderBy("business_date").collect()]
    rng, rows = np.random.default_rng([spec.seed, 1]), []
    for kind, count, factor, share in spec.events:
        for k in range(count):
            day, first = days[int(rng.integers(len(days)))], int(rng.integers(max(1, grid.per_day - 8)))
            last = min(grid.per_day, first + int(rng.integers(4, 12)))
            touched = [int(x) + 1 for x in (range(spec.apps) if share >= 1 else rng.choice(spec.apps, max(1, int(share * spec.apps)), replace=False))]
            at = lambda i: datetime(day.year, day.month, day.day) + timedelta(minutes=grid.start + i * grid.minutes)  # noqa: E731, B023
            app = "*" if len(touched) > 1 else f"APP{touched[0]:03d}"
            rows.append((len(rows), f"{kind}-{k:03d}", kind, "*", app, at(first), at(last), f"synthetic {kind}", factor, touched))
    return spark.createDataFrame(rows, "event_seq int, event_id string, event_type string, lpar string, app_id string, start_ts timestamp_ntz, end_ts timestamp_ntz, note string, factor double, touched array<long>")


def generate(spark: SparkSession, spec: Spec = Spec(), grid: cal.Grid = cal.Grid()) -> dict[str, DataFrame]:
    """intervals, events, lpar_totals and submissions; `truth` has the intervals before events."""
    cell = ["k", "business_date", "interval_idx"]
    # The calendar and the apps are both small by the spec; their product is the panel.
    base = _days(spark, spec, grid).repartition(max(1, spec.apps // 4), "business_date").join(F.broadcast(_apps(spark, spec)))
    base = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid.per_day - 1))).alias("interval_idx"))
    x = F.col("interval_idx") / max(1, grid.per_day - 1)
    bell = lambda at, width: F.exp(-0.5 * ((x - at) / width) * ((x - at) / width))
    shape = F.greatest(F.lit(0.05), 0.35 + bell(F.col("at"), F.col("width")) + 0.55 * bell(F.lit(0.18), F.lit(0.12)) - 0.25 * bell(F.lit(0.45), F.lit(0.07)))
    weekday = 1 + 0.05 * normal(spec.seed, "weekday", "k", "_dow")
    level = F.col("level") * F.pow("growth", F.col("years")) * weekday * F.when(F.col("month_end"), F.col("month_lift")).otherwise(1.0) * F.when(F.col("quarter_end"), F.col("quarter_lift")).otherwise(1.0)
    shared = 1 + spec.common * F.col("beta") * (F.col("swing") + 0.05 * normal(spec.seed, "hour", "business_date", "interval_idx"))
    squares = [normal(spec.seed, f"tail{i}", *cell) for i in range(spec.freedom)]
    t = normal(spec.seed, "noise", *cell) / F.sqrt(sum((s * s for s in squares[1:]), squares[0] * squares[0]) / spec.freedom)
    value = level * shape * shared * (1 + spec.noise * t * ((spec.freedom - 2) / spec.freedom) ** 0.5)
    ts = F.col("business_date").cast("timestamp_ntz") + F.make_dt_interval(mins=F.lit(grid.start) + F.col("interval_idx") * grid.minutes)
    truth = base.withColumn("_dow", F.weekday("business_date")).select(
        ts.alias("ts"), "business_date", "interval_idx", "fiscal_year", "k", "app_id", "lpar", F.lit("PROD").alias("environment"), F.greatest(F.lit(0.5), value).alias("mips")
    )
    found = events(spark, spec, grid)
    touched = lambda r: F.col("k").isin(r["touched"]) & (F.col("ts") >= F.lit(r["start_ts"])) & (F.col("ts") < F.lit(r["end_ts"]))
    lifts = [F.when(touched(r), r["factor"]).otherwise(1.0) for r in found.collect()]
    lifted = F.col("mips")
    for f in lifts:
        lifted = lifted * f
    intervals = label(truth.withColumn("mips", lifted), found).drop("k")
    summed = intervals.groupBy("business_date", "lpar", "fiscal_year", "interval_idx").agg(F.sum("mips").alias("v"))
    totals = summed.groupBy("business_date", "lpar", "fiscal_year").agg(
        F.max("v").alias("peak_mips"), F.max_by("interval_idx", F.struct("v", -F.col("interval_idx"))).alias("peak_interval_idx"), F.avg("v").alias("mean_mips")
    )
    peaks = truth.groupBy("app_id", "fiscal_year").agg(F.max("mips").alias("peak"), F.first("k").alias("k"))
    ratio = F.exp(0.05 + 0.2 * normal(spec.seed, "habit", "k") + 0.1 * normal(spec.seed, "claim", "k", "fiscal_year"))
    claims = peaks.select("app_id", "fiscal_year", F.make_date(F.col("fiscal_year") - 1, F.lit(8), F.lit(1)).alias("submitted_on"), (F.col("peak") * ratio).alias("submitted_peak_mips"), F.lit("synthetic").alias("basis"))
    return {"intervals": intervals, "events": found.drop("event_seq", "factor", "touched"), "lpar_totals": totals, "submissions": claims, "truth": truth.drop("k")}


@register_source("synthetic")
@dataclass
class SyntheticSource:
    """The generator as a source."""

    spark: SparkSession
    spec: Spec = field(default_factory=Spec)
    grid: cal.Grid = field(default_factory=cal.Grid)

    def __post_init__(self):
        self._made: dict[str, DataFrame] | None = None

    def fetch(self, table: str, start: date, end: date) -> DataFrame | None:
        self._made = self._made or generate(self.spark, self.spec, self.grid)
        got = self._made.get(table)
        return None if got is None else clipped(got, table, start, end)
