"""Coincidence, profile and peak-spread diagnostics of interval panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def coincidence(intervals: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Daily peak of the sum against the sum of the apps' peaks, per lpar; totals are whole-lpar peaks if known."""
    apps = intervals.groupBy("lpar", "business_date", "fiscal_year", "app_id").agg(F.max("mips").alias("peak"))
    apps = apps.groupBy("lpar", "business_date", "fiscal_year").agg(F.sum("peak").alias("sum_app_peaks"), F.count("*").alias("n_apps"))
    summed = intervals.groupBy("lpar", "business_date", "interval_idx").agg(F.sum("mips").alias("v"))
    whole = summed.groupBy("lpar", "business_date").agg(
        F.max("v").alias("peak_of_sum"), F.max_by("interval_idx", F.struct("v", -F.col("interval_idx"))).alias("peak_interval_idx")
    )
    out = apps.join(whole if totals is None else totals, ["lpar", "business_date"])
    return out.withColumn("coincidence", F.col("peak_of_sum") / F.nullif(F.col("sum_app_peaks"), F.lit(0.0))).withColumn(
        "unattributed", F.col("peak_of_sum") > F.col("sum_app_peaks")
    )


def coincidence_summary(daily: DataFrame) -> DataFrame:
    """Per lpar and fiscal year: mean, median, 5 % and 95 % quantiles, range."""
    c = F.col("coincidence")
    return daily.groupBy("lpar", "fiscal_year").agg(
        F.count("*").alias("n_days"), F.avg(c).alias("mean_c"), F.percentile(c, 0.5).alias("median_c"), F.percentile(c, 0.05).alias("p05_c"),
        F.percentile(c, 0.95).alias("p95_c"), F.min(c).alias("min_c"), F.max(c).alias("max_c"), F.count_if("unattributed").alias("n_unattributed"),
    )


def headline(daily: DataFrame) -> DataFrame:
    """One row over all days."""
    over = F.col("sum_app_peaks") - F.col("peak_of_sum")
    return daily.agg(
        F.count("*").alias("n_days"), F.avg("coincidence").alias("mean_c"), F.percentile("coincidence", 0.05).alias("p05_c"), F.percentile("coincidence", 0.95).alias("p95_c"),
        F.avg(over).alias("mean_over"), F.avg(over / F.nullif(F.col("peak_of_sum"), F.lit(0.0)) * 100).alias("mean_over_pct"), F.count_if("unattributed").alias("n_unattributed"),
    )


def verdict(mean: float | None, threshold: float = 0.95) -> str:
    if mean is None:
        return "INCONCLUSIVE"
    return "STOP AND RECONSIDER" if mean >= threshold else "PROCEED"


def profile(intervals: DataFrame) -> DataFrame:
    """Per app and lpar: coverage and shape."""
    return intervals.groupBy("app_id", "lpar").agg(
        F.count("*").alias("n_rows"), F.countDistinct("business_date").alias("n_days"), F.count_if(F.col("mips").isNull()).alias("n_null"), F.count_if(F.col("mips") == 0).alias("n_zero"),
        F.avg("mips").alias("mean_mips"), F.max("mips").alias("max_mips"), F.percentile("mips", 0.99).alias("p99_mips"),
        (F.max("mips") / F.nullif(F.avg("mips"), F.lit(0.0))).alias("peak_to_mean"),
    )


def peak_spread(intervals: DataFrame) -> DataFrame:
    """How often each interval holds an app's daily peak, as a share of its days."""
    at = intervals.where("mips is not null").groupBy("app_id", "business_date").agg(F.max_by("interval_idx", F.struct("mips", -F.col("interval_idx"))).alias("interval_idx"))
    n = at.groupBy("app_id", "interval_idx").agg(F.count("*").alias("n_days"))
    return n.withColumn("share", F.col("n_days") / F.sum("n_days").over(Window.partitionBy("app_id")))


def submission_bias(intervals: DataFrame, submissions: DataFrame) -> DataFrame:
    """Submitted against realised peaks per app and fiscal year."""
    real = intervals.groupBy("app_id", "fiscal_year").agg(F.max("mips").alias("realised"))
    ratio = F.col("submitted_peak_mips") / F.nullif(F.col("realised"), F.lit(0.0))
    return real.join(submissions, ["app_id", "fiscal_year"]).select(
        "app_id", "fiscal_year", "realised", "submitted_peak_mips", ratio.alias("ratio"), (F.col("submitted_peak_mips") - F.col("realised")).alias("difference"),
        F.ln(F.when(ratio > 0, ratio)).alias("log_ratio"),
    )


def bias_summary(bias: DataFrame) -> DataFrame:
    """Per app: mean and geometric mean ratio, spread, how consistently one side."""
    over, under = F.count_if(F.col("ratio") > 1), F.count_if(F.col("ratio") < 1)
    return bias.groupBy("app_id").agg(
        F.count("*").alias("n_cycles"), F.avg("ratio").alias("mean_ratio"), F.exp(F.avg("log_ratio")).alias("geo_ratio"), F.stddev_samp("log_ratio").alias("sd_log"),
        over.alias("n_over"), under.alias("n_under"), (F.greatest(over, under) / F.count("*")).alias("sign_consistency"),
    )
