"""Serving tables of simulated paths, their publication, and the comparison of two simulations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.operators import model as mod

LEVELS = [0.5, 0.9, 0.95, 0.99]
#: The serving tables and their names on disk.
TABLES = ("fy_summary", "app_peaks", "daily_profile")


def _levels(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One row per keys and level: the quantile of `column` and its mean."""
    got = df.groupBy(*keys).agg(F.percentile(column, F.array(*map(F.lit, LEVELS))).alias("q"), F.avg(column).alias("mean"))
    return got.select(*keys, F.posexplode("q").alias("i", "value"), "mean").withColumn("level", F.get(F.array(*map(F.lit, LEVELS)), F.col("i"))).drop("i")


def path_figures(daily: DataFrame, names: list[str]) -> DataFrame:
    """path_id, fiscal_year (null: the whole horizon), reducer, value."""
    whole = mod.reduced(daily, ["path_id"], names).withColumn("fiscal_year", F.lit(None).cast("int"))
    each = mod.reduced(daily, ["path_id", "fiscal_year"], names).unionByName(whole)
    return each.unpivot(["path_id", "fiscal_year"], names, "reducer", "value")


def fy_summary(figures: DataFrame) -> DataFrame:
    """Levels over paths of each reducer's figure, per fiscal year."""
    return _levels(figures.where("fiscal_year is not null"), ["fiscal_year", "reducer"], "value")


def app_peaks(peaks: DataFrame) -> DataFrame:
    """Levels over paths of each app's peak; `peaks` has path_id, app_id, peak. Peaks of apps do not add up."""
    return _levels(peaks, ["app_id"], "peak").withColumn("do_not_sum", F.lit(True))


def daily_profile(daily: DataFrame) -> DataFrame:
    """Levels over paths of each day's peak."""
    return _levels(daily, ["business_date"], "daily_peak")


def compare(base: DataFrame, other: DataFrame) -> DataFrame:
    """One row per fiscal year and reducer: median and 95 % figure of both, and the changes in per cent."""
    def figures(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("fiscal_year", "reducer").agg(F.percentile("value", 0.5).alias(f"{name}_p50"), F.percentile("value", 0.95).alias(f"{name}_p95"))

    a, b = figures(base, "base").alias("a"), figures(other, "other").alias("b")
    same = F.col("a.fiscal_year").eqNullSafe(F.col("b.fiscal_year")) & (F.col("a.reducer") == F.col("b.reducer"))
    out = a.join(b, same).select("a.*", "other_p50", "other_p95")
    return out.withColumns({f"delta_{p}_pct": 100 * (F.col(f"other_{p}") / F.nullif(F.col(f"base_{p}"), F.lit(0.0)) - 1) for p in ("p50", "p95")})


def publish(tables: dict[str, DataFrame], folder: str) -> None:
    """Writes the serving tables over those in the folder."""
    if unknown := set(tables) - set(TABLES):
        raise KeyError(f"unknown serving tables: {sorted(unknown)}")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def read_published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")
