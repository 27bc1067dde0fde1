"""Features, baselines, reducers, evaluation and scenarios."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Quantiles forecast, lags and rolling widths of business days.
QUANTILES = [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
LAGS, ROLLS = [1, 2, 3, 5, 10, 20], [5, 20, 60]


def lag_features(dense: DataFrame) -> DataFrame:
    """Lags and past-only rolling means and population deviations per app and interval, on a dense panel."""
    lane = Window.partitionBy("app_id", "interval_idx").orderBy("business_date")
    new = {f"lag_{k}": F.lag("mips", k).over(lane) for k in LAGS}
    for w in ROLLS:
        past = lane.rowsBetween(-w, -1)
        new |= {f"mean_{w}": F.avg("mips").over(past), f"std_{w}": F.stddev_pop("mips").over(past)}
    return dense.withColumns(new)


def fourier(x: Column, period: float, k: int) -> tuple[Column, Column]:
    angle = x * (2 * 3.141592653589793 * k / period)
    return F.sin(angle), F.cos(angle)


def damped_years(day: Column, origin: Column, most: float, phi: float) -> Column:
    """Years since the origin; beyond `most`, further years count phi."""
    years = F.datediff(day, origin) / 365.25
    return F.when(years <= most, years).otherwise(most + phi * (years - most))


def scales(rows: DataFrame) -> DataFrame:
    return rows.groupBy("app_id").agg(F.greatest(F.coalesce(F.percentile("mips", 0.5), F.lit(1.0)), F.lit(1.0)).alias("scale"))


def growth(rows: DataFrame, low: float = -0.15, high: float = 0.4, least: int = 30) -> DataFrame:
    """Per app: the slope of the log daily median on years, 0 with fewer than `least` days, clipped."""
    days = rows.groupBy("app_id", "business_date").agg(F.percentile("mips", 0.5).alias("m")).where("m > 0")
    first = Window.partitionBy("app_id")
    days = days.withColumn("x", F.datediff("business_date", F.min("business_date").over(first)) / 365.25)
    slope = F.when(F.count("*") >= least, F.regr_slope(F.ln("m"), F.col("x"))).otherwise(0.0)
    return days.groupBy("app_id").agg(F.greatest(F.lit(low), F.least(F.lit(high), slope)).alias("growth"), F.count("*").alias("n_days"))


def feed_correction(rows: DataFrame) -> DataFrame:
    ratio = F.avg("mips") / F.nullif(F.percentile("mips", 0.5), F.lit(0.0))
    return rows.groupBy("app_id", "interval_idx").agg(F.coalesce(F.greatest(F.lit(0.8), F.least(F.lit(1.6), ratio)), F.lit(1.0)).alias("feed"))


def recent(rows: DataFrame, days: int) -> DataFrame:
    """Rows of the last `days` dates."""
    last = rows.select("business_date").distinct().orderBy(F.desc("business_date")).limit(days)
    return rows.join(last, "business_date", "left_semi")


def climatology(rows: DataFrame, quantiles: list[float] = QUANTILES, days: int = 250) -> DataFrame:
    """Quantiles per app, interval and weekday over the last `days` dates, one row a quantile."""
    q = F.percentile("mips", F.array(*map(F.lit, quantiles)))
    df = recent(rows, days).groupBy("app_id", "interval_idx", F.weekday("business_date").alias("dow")).agg(q.alias("q"))
    return df.select("app_id", "interval_idx", "dow", F.posexplode("q").alias("i", "value")).withColumn("tau", F.element_at(F.array(*map(F.lit, quantiles)), F.col("i") + 1)).drop("i")


def seasonal_naive(rows: DataFrame, quantiles: list[float], days: int = 250) -> DataFrame:
    """The last same-weekday value times quantiles of week-over-week ratios."""
    lane = Window.partitionBy("app_id", "interval_idx", "dow").orderBy("business_date")
    df = rows.withColumn("dow", F.weekday("business_date")).withColumn("prev", F.lag("mips").over(lane))
    ratio = F.when(F.col("prev") > 0, F.col("mips") / F.col("prev"))
    base = df.groupBy("app_id", "interval_idx", "dow").agg(F.max_by("mips", "business_date").alias("base"))
    spread = recent(df.withColumn("ratio", ratio), days).groupBy("app_id", "interval_idx").agg(F.percentile("ratio", F.array(*map(F.lit, quantiles))).alias("r"))
    out = base.join(spread, ["app_id", "interval_idx"]).select("app_id", "interval_idx", "dow", "base", F.posexplode("r").alias("i", "r"))
    return out.select("app_id", "interval_idx", "dow", F.element_at(F.array(*map(F.lit, quantiles)), F.col("i") + 1).alias("tau"), (F.col("base") * F.coalesce("r", F.lit(1.0))).alias("value"))


def coverage(scored: DataFrame) -> DataFrame:
    """Per tau: share of y <= q, its error and z, and the pinball loss."""
    e = F.col("y") - F.col("q")
    df = scored.groupBy("tau").agg(
        F.avg((F.col("y") <= F.col("q")).cast("double")).alias("empirical"), F.count("*").alias("n"),
        F.avg(F.greatest(F.col("tau") * e, (F.col("tau") - 1) * e)).alias("pinball"),
    )
    se = F.sqrt(F.col("tau") * (1 - F.col("tau")) / F.col("n"))
    return df.withColumn("error", F.col("empirical") - F.col("tau")).withColumn("z", F.col("error") / se)


#: Reducers of daily series to one figure: functions of a daily column name and a month-peak flag.
REDUCERS: dict[str, Callable[[], Column]] = {
    "annual_max": lambda: F.max("daily_peak"),
    "p95_of_daily_peaks": lambda: F.percentile("daily_peak", 0.95),
    "p99_of_daily_peaks": lambda: F.percentile("daily_peak", 0.99),
    "mean_of_daily_peaks": lambda: F.avg("daily_peak"),
    "mean_daily_mean": lambda: F.avg("daily_mean"),
    "mean_of_monthly_peaks": lambda: F.avg(F.when(F.col("month_first"), F.col("month_peak"))),
    "max_of_monthly_peaks": lambda: F.max("month_peak"),
    "top4_mean_of_daily_peaks": lambda: F.avg(F.when(F.col("day_rank") <= 4, F.col("daily_peak"))),
    "monthly_peak_r4ha": lambda: F.avg(F.when(F.col("month_first"), F.col("month_r4ha"))),
    "annual_peak_r4ha": lambda: F.max("daily_r4ha"),
    "p95_of_daily_r4ha": lambda: F.percentile("daily_r4ha", 0.95),
    "mean_of_daily_r4ha": lambda: F.avg("daily_r4ha"),
}
#: Which decision a reducer serves.
FAMILIES = {
    "hardware": ["annual_max", "max_of_monthly_peaks", "p99_of_daily_peaks", "top4_mean_of_daily_peaks"],
    "sustained": ["mean_of_monthly_peaks", "p95_of_daily_peaks", "mean_of_daily_peaks", "mean_daily_mean"],
    "software_cost": ["monthly_peak_r4ha", "annual_peak_r4ha", "p95_of_daily_r4ha", "mean_of_daily_r4ha"],
}


def needs_r4ha(names: list[str]) -> bool:
    """Whether one of the reducers works on daily rolling averages."""
    return any("r4ha" in n for n in names)


def reduced(daily: DataFrame, keys: list[str], names: list[str] | None = None) -> DataFrame:
    """One row per keys with a column for each reducer; `daily` has business_date, daily_peak, daily_mean, and daily_r4ha for those that need it."""
    rolled = "daily_r4ha" in daily.columns
    names = names or [n for n in REDUCERS if rolled or not needs_r4ha([n])]
    if unknown := set(names) - set(REDUCERS):
        raise KeyError(f"unknown reducers: {sorted(unknown)}")
    if needs_r4ha(names) and not rolled:
        raise ValueError("these reducers need daily_r4ha")
    month = Window.partitionBy(*keys, F.year("business_date"), F.month("business_date"))
    df = daily.withColumns({
        "month_peak": F.max("daily_peak").over(month), "month_first": F.row_number().over(month.orderBy("business_date")) == 1,
        "day_rank": F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("daily_peak"), "business_date")),
    })
    if rolled:
        df = df.withColumn("month_r4ha", F.max("daily_r4ha").over(month))
    return df.groupBy(*keys).agg(*[REDUCERS[n]().alias(n) for n in names])


def r4ha(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Daily maximum of full rolling windows over the intervals, running on across days; 0 before the first."""
    order = Window.partitionBy(*keys).orderBy("business_date", "interval_idx").rowsBetween(-(width - 1), 0)
    df = rows.withColumns({"a": F.avg("mips").over(order), "c": F.count("*").over(order)})
    return df.groupBy(*keys, "business_date").agg(F.coalesce(F.max(F.when(F.col("c") == width, F.col("a"))), F.lit(0.0)).alias("r4ha"))


def scenario(
    forecast: DataFrame, multiplier: dict[str, float], steps: dict[str, tuple[str, float]], apps: list[str], rates: dict[str, float] | None = None, growth: DataFrame | None = None, anchor: date | None = None
) -> DataFrame:
    """value times level multipliers and steps from a date on (inclusive), by app.

    An app in `rates` grows by that rate a year from `anchor` on, in place of its fitted one in `growth` (0 where it has none).
    """
    rates = rates or {}
    if unknown := (set(multiplier) | set(steps) | set(rates)) - set(apps):
        raise KeyError(f"unknown apps: {sorted(unknown)}")
    f = F.lit(1.0)
    if rates:
        if anchor is None:
            raise ValueError("rates need an anchor")
        columns = forecast.columns
        old = F.lit(0.0)
        if growth is not None:
            # One row an app named in `rates`, which a user writes.
            forecast = forecast.join(F.broadcast(growth.where(F.col("app_id").isin(list(rates))).select("app_id", F.col("growth").alias("_old"))), "app_id", "left")
            old = F.coalesce("_old", F.lit(0.0))
        years = F.datediff("business_date", F.lit(anchor)) / 365.25
        for app, rate in sorted(rates.items()):
            f = f * F.when(F.col("app_id") == app, F.exp((rate - old) * years)).otherwise(1.0)
        forecast = forecast.withColumn("value", F.col("value") * f).select(*columns)
        f = F.lit(1.0)
    for app, m in sorted(multiplier.items()):
        f = f * F.when(F.col("app_id") == app, m).otherwise(1.0)
    for app, (day, m) in sorted(steps.items()):
        f = f * F.when((F.col("app_id") == app) & (F.col("business_date") >= F.lit(day).cast("date")), m).otherwise(1.0)
    return forecast.withColumn("value", F.col("value") * f)
