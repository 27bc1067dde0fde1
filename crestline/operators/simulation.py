"""Residual pools, day-block bootstrap and path simulation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A pool of residual days this large is sent to every task; a larger one is joined by shuffle.
BROADCAST_ROWS = 200_000


def residuals(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """(y - median) / half the spread, winsorised at 8; fitted has median, q10 and q90 by app and interval."""
    half = F.greatest((F.col("q90") - F.col("q10")) / 2, F.greatest(F.abs("med") * 0.02, F.lit(0.1)))
    return rows.join(fitted, ["app_id", "interval_idx"]).select(
        "app_id", "business_date", "interval_idx", F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.col("mips") - F.col("med")) / half)).alias("r")
    )


def pool(res: DataFrame) -> DataFrame:
    """Residuals of days on which every app has every interval, with pool_idx by date."""
    cells = res.agg(F.countDistinct("app_id", "interval_idx")).first()[0]
    whole = res.groupBy("business_date").agg(F.count("r").alias("n")).where(F.col("n") == cells)
    # One row a date: the dense index of a few thousand days.
    ranked = whole.select("business_date", (F.row_number().over(Window.orderBy("business_date")) - 1).alias("pool_idx"))
    return res.join(ranked, "business_date")


def draws(spark: SparkSession, paths: int, days: int, pick: Column, parts: int = 8) -> DataFrame:
    """(path_id, day_idx, pool_idx): a pure function of path and day."""
    p = spark.range(0, paths, 1, parts).withColumnRenamed("id", "path_id")
    return p.select("path_id", F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("day_idx")).withColumn("pool_idx", pick.cast("int"))


def hashed(seed: int, n: int, block: int = 1) -> Column:
    """Uniform draw of a day, or of consecutive days in blocks, by hash."""
    starts = n - block + 1
    if n < 1 or starts < 1:
        raise ValueError("the residual pool is smaller than a block")
    step = F.floor(F.col("day_idx") / block)
    return F.pmod(F.xxhash64(F.lit(seed), "path_id", step), F.lit(starts)) + F.col("day_idx") % block


def simulate(drawn: DataFrame, pooled: DataFrame, forecast: DataFrame) -> DataFrame:
    """Per path and day: the peak and mean over intervals of the sum over apps, and the sum of the apps' peaks.

    forecast has med and half (half the spread) by app and interval. Values are floored at 0 before the sum.
    """
    cells = pooled.join(forecast, ["app_id", "interval_idx"]).select("pool_idx", "app_id", "interval_idx", F.greatest(F.lit(0.0), F.col("med") + F.col("r") * F.col("half")).alias("x"))
    # Sums over apps and intervals depend on the pool day alone: reduce before the join.
    summed = cells.groupBy("pool_idx", "interval_idx").agg(F.sum("x").alias("s")).groupBy("pool_idx").agg(F.max("s").alias("peak"), F.avg("s").alias("mean"))
    apps = cells.groupBy("pool_idx", "app_id").agg(F.max("x").alias("m")).groupBy("pool_idx").agg(F.sum("m").alias("sum_app_peaks"))
    per_day = summed.join(apps, "pool_idx")
    small = per_day.count() <= BROADCAST_ROWS
    return drawn.join(F.broadcast(per_day) if small else per_day, "pool_idx").select("path_id", "day_idx", "peak", "mean", "sum_app_peaks")


def correlation(res: DataFrame) -> DataFrame:
    """Pearson correlation of each two apps over common cells."""
    a = res.select("business_date", "interval_idx", F.col("app_id").alias("a"), F.col("r").alias("ra"))
    b = res.select("business_date", "interval_idx", F.col("app_id").alias("b"), F.col("r").alias("rb"))
    return a.join(b, ["business_date", "interval_idx"]).where("a < b").groupBy("a", "b").agg(F.corr("ra", "rb").alias("corr"), F.count("*").alias("n"))


def factor(rows: DataFrame) -> DataFrame:
    """Per date: the peak of the sum over the sum of the apps' peaks."""
    summed = rows.groupBy("business_date", "interval_idx").agg(F.sum("mips").alias("s")).groupBy("business_date").agg(F.max("s").alias("num"))
    apps = rows.groupBy("business_date", "app_id").agg(F.max("mips").alias("m")).groupBy("business_date").agg(F.sum("m").alias("den"))
    return summed.join(apps, "business_date").where("den > 0").select("business_date", F.weekday("business_date").alias("dow"), (F.col("num") / F.col("den")).alias("factor"))
