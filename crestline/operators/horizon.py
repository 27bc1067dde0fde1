"""Paths over a horizon whose forecast differs by day: sums over apps, rolling averages across days, coincidence factors.

A cell's value depends on its day and on the pool day drawn, not on the path. Values are worked out once for
each (day, pool day) that is drawn, and paths look them up: the work grows with days times pool days, not with paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Days of history whose factors may become literals of the plan, and days a weekday needs for a pool of its own.
MOST_FACTORS, LEAST_WEEKDAY = 20_000, 20


def cells(drawn: DataFrame, pooled: DataFrame, forecast: DataFrame) -> DataFrame:
    """day_idx, pool_idx, app_id, x: an app's values by interval, for each (day, pool day) drawn.

    `drawn` has path_id, day_idx, pool_idx; `pooled` pool_idx, app_id, interval_idx, r; `forecast` day_idx, app_id,
    interval_idx, med and half. Values are floored at 0. An array has a day's intervals.
    """
    lane = lambda *v: F.array_sort(F.collect_list(F.struct("interval_idx", *v)))
    pool = pooled.groupBy("pool_idx", "app_id").agg(lane("r").alias("_p"))
    days = forecast.groupBy("day_idx", "app_id").agg(lane("med", "half").alias("_f"))
    pairs = drawn.select("day_idx", "pool_idx").distinct()
    x = F.zip_with("_f", "_p", lambda f, p: F.greatest(F.lit(0.0), f["med"] + p["r"] * f["half"]))
    return pairs.join(pool, "pool_idx").join(days, ["day_idx", "app_id"]).select("day_idx", "pool_idx", "app_id", x.alias("x"))


def totals(cells: DataFrame, per_day: int) -> DataFrame:
    """day_idx, pool_idx, total (by interval), peak and mean of it, and sum_app_peaks: summed over apps first, then reduced."""
    sums = [F.sum(F.get("x", F.lit(i))).alias(f"_{i}") for i in range(per_day)]
    summed = cells.groupBy("day_idx", "pool_idx").agg(*sums, F.sum(F.array_max("x")).alias("sum_app_peaks"))
    total = F.array(*[F.col(f"_{i}") for i in range(per_day)])
    mean = sum((F.col(f"_{i}") for i in range(1, per_day)), F.col("_0")) / per_day
    return summed.select("day_idx", "pool_idx", total.alias("total"), F.array_max(total).alias("peak"), mean.alias("mean"), "sum_app_peaks")


def daily(drawn: DataFrame, totals: DataFrame) -> DataFrame:
    """The totals of each path's days."""
    return drawn.select("path_id", "day_idx", "pool_idx").join(totals, ["day_idx", "pool_idx"]).drop("pool_idx")


def app_peaks(drawn: DataFrame, cells: DataFrame) -> DataFrame:
    """path_id, app_id, peak: each app's greatest value over the whole horizon."""
    peaks = cells.select("day_idx", "pool_idx", "app_id", F.array_max("x").alias("x"))
    return drawn.select("path_id", "day_idx", "pool_idx").join(peaks, ["day_idx", "pool_idx"]).groupBy("path_id", "app_id").agg(F.max("x").alias("peak"))


def rolling(days: DataFrame, keys: list[str], column: str, width: int, per_day: int) -> DataFrame:
    """`days` with r4ha: the greatest mean of `width` intervals that ends in the day.

    Intervals run on from one day to the next within `keys`; only whole windows count, and a day without one has 0.
    """
    if width < 1:
        raise ValueError("a window has at least one interval")
    order = Window.partitionBy(*keys).orderBy("day_idx")
    none = F.array().cast("array<double>")
    back = -(-(width - 1) // per_day)
    before = F.concat(none, *[F.coalesce(F.lag(column, k).over(order), none) for k in range(back, 0, -1)])
    df = days.withColumn("_before", before).withColumn("_all", F.concat("_before", column))
    ends = F.filter(F.sequence(F.size("_before") + 1, F.size("_all")), lambda e: e >= width)
    mean = lambda e: F.aggregate(F.slice("_all", e - (width - 1), F.lit(width)), F.lit(0.0), lambda a, b: a + b) / width
    return df.withColumn("r4ha", F.coalesce(F.array_max(F.transform(ends, mean)), F.lit(0.0))).drop("_before", "_all")


def sum_app_r4ha(drawn: DataFrame, cells: DataFrame, width: int, per_day: int) -> DataFrame:
    """path_id, day_idx, sum_app_r4ha: the sum of each app's own greatest rolling average of the day."""
    rows = drawn.select("path_id", "day_idx", "pool_idx").join(cells, ["day_idx", "pool_idx"]).drop("pool_idx")
    return rolling(rows, ["path_id", "app_id"], "x", width, per_day).groupBy("path_id", "day_idx").agg(F.sum("r4ha").alias("sum_app_r4ha"))


def with_factor(daily: DataFrame, factors: DataFrame, per_day: int, seed: int = 20260101) -> DataFrame:
    """`daily` (with dow) whose total, peak and mean are scaled by a coincidence factor drawn for each path and day.

    Only a forecast of one interval a day lacks coincidence; with more, a factor would count it twice. Draws are
    from the factors of the same weekday where there are LEAST_WEEKDAY of them, else from all. `factors` has
    business_date, dow and factor: one row a date.
    """
    if per_day != 1:
        raise ValueError("a coincidence factor is for forecasts of one interval a day")
    found = factors.where("factor is not null").select("business_date", "dow", "factor").orderBy("business_date").limit(MOST_FACTORS + 1).collect()
    if not 0 < len(found) <= MOST_FACTORS:
        raise ValueError(f"1 to {MOST_FACTORS} factors are needed, not {len(found)}")
    pools = {k: [r["factor"] for r in found if r["dow"] == k] for k in {r["dow"] for r in found}}
    pool = F.lit([r["factor"] for r in found])
    for k, v in sorted(pools.items()):
        if len(v) >= LEAST_WEEKDAY:
            pool = F.when(F.col("dow") == k, F.lit(v)).otherwise(pool)
    df = daily.withColumn("_pool", pool)
    at = F.pmod(F.xxhash64(F.lit(seed), "path_id", "day_idx"), F.size("_pool")).cast("int")
    df = df.withColumn("factor", F.get("_pool", at)).drop("_pool")
    return df.withColumns({"total": F.transform("total", lambda v: v * F.col("factor")), "peak": F.col("peak") * F.col("factor"), "mean": F.col("mean") * F.col("factor")})


def coincidence(daily: DataFrame, peaks: DataFrame) -> DataFrame:
    """One row: mean and quantiles of the daily ratio of peaks, the mean ratio over the horizon, and its two parts."""
    ratio = F.col("peak") / F.greatest(F.col("sum_app_peaks"), F.lit(1e-9))
    each = daily.agg(F.avg(ratio).alias("daily_mean"), F.percentile(ratio, 0.05).alias("daily_p05"), F.percentile(ratio, 0.95).alias("daily_p95"))
    most = daily.groupBy("path_id").agg(F.max("peak").alias("most"))
    sums = peaks.groupBy("path_id").agg(F.sum("peak").alias("apps"))
    whole = most.join(sums, "path_id").agg(
        F.avg(F.col("most") / F.greatest(F.col("apps"), F.lit(1e-9))).alias("horizon_mean"), F.avg("most").alias("mean_peak_of_sum"), F.avg("apps").alias("mean_sum_of_app_peaks")
    )
    return each.join(F.broadcast(whole))


def coincidence_by_target(daily: DataFrame) -> DataFrame:
    """One row: mean ratio of interval peaks, of rolling averages, of the two, and what the averaging gains; `daily` has r4ha and sum_app_r4ha."""
    low = lambda c: F.greatest(F.col(c), F.lit(1e-9))
    out = daily.agg(
        F.avg(F.col("peak") / low("sum_app_peaks")).alias("interval_peak"), F.avg(F.col("r4ha") / low("sum_app_r4ha")).alias("r4ha"),
        F.avg(F.col("r4ha") / low("peak")).alias("r4ha_to_peak"),
    )
    return out.withColumn("gain", F.col("r4ha") - F.col("interval_peak"))


def above_p99(days: DataFrame, keys: list[str], column: str = "total") -> DataFrame:
    """Per keys: how many intervals lie above the 99 % quantile of all of them."""
    flat = days.select(*keys, F.explode(column).alias("_v"))
    cut = flat.groupBy(*keys).agg(F.percentile("_v", 0.99).alias("_cut"))
    return flat.join(cut, keys).groupBy(*keys).agg(F.count_if(F.col("_v") > F.col("_cut")).alias("intervals_above_p99"))
