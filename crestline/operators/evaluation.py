"""Scores of quantile forecasts, rolling-origin comparison, and the comparison with submitted figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins over which ranks of PIT values are taken; each is ordered apart from the others.
PIT_BINS = 4096


def pit(y: Column, q: Column, taus: Sequence[float]) -> Column:
    """The share of the forecast distribution below y: linear between the ascending quantiles `q`, 0 below and 1 above them."""
    grid, n = F.array(*map(F.lit, taus)), len(taus)
    below = F.size(F.filter(q, lambda x: x <= y))
    low, high = F.get(q, below - 1), F.get(q, below)
    inner = F.get(grid, below - 1) + (F.get(grid, below) - F.get(grid, below - 1)) * (y - low) / (high - low)
    return F.when(y.isNull() | q.isNull(), F.lit(None)).when(below == 0, 0.0).when(below < n, inner).when(y == F.get(q, F.lit(n - 1)), float(taus[-1])).when(below == n, 1.0)


def pit_uniformity(values: DataFrame) -> DataFrame:
    """One row: the Kolmogorov-Smirnov distance of column `pit` from uniform, mean, population variance, dispersion, n.

    Equal values are counted first, and cumulated in bins of the unit interval, so no task orders all rows.
    """
    known = values.where("pit is not null")
    counts = known.groupBy("pit").agg(F.count("*").alias("c")).withColumn("bin", F.least(F.floor(F.col("pit") * PIT_BINS), F.lit(PIT_BINS - 1)))
    bins = counts.groupBy("bin").agg(F.sum("c").alias("total"))
    # At most PIT_BINS rows.
    before = bins.select("bin", (F.sum("total").over(Window.orderBy("bin")) - F.col("total")).alias("before"))
    within = Window.partitionBy("bin").orderBy("pit")
    ranked = counts.join(F.broadcast(before), "bin").withColumn("upto", F.col("before") + F.sum("c").over(within))
    total = known.agg(F.count("*").alias("n"), F.avg("pit").alias("pit_mean"), F.var_pop("pit").alias("pit_var"))
    gap = F.greatest(F.col("upto") / F.col("n") - F.col("pit"), F.col("pit") - (F.col("upto") - F.col("c")) / F.col("n"))
    ks = ranked.join(F.broadcast(total.select("n"))).agg(F.max(gap).alias("ks_stat"))
    return ks.join(F.broadcast(total)).withColumn("dispersion", F.when(F.col("pit_var") > 1 / 12, "under").otherwise("over"))


def ks_pvalue(statistic: float, n: int, terms: int = 100) -> float:
    """The asymptotic Kolmogorov p-value, with the usual small-sample correction of the argument."""
    from math import exp, sqrt

    x = (sqrt(n) + 0.12 + 0.11 / sqrt(n)) * statistic
    return 1.0 if x < 0.2 else min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * exp(-2 * (k * x) ** 2) for k in range(1, terms + 1))))


def interval_score(y: Column, low: Column, high: Column, level: float = 0.9) -> Column:
    """Winkler's score of one central interval: its width, and 2/alpha of the distance by which it misses."""
    miss = F.greatest(low - y, y - high, F.lit(0.0))
    return (high - low) + miss * (2.0 / (1.0 - level))


def pinball(y: Column, q: Column, taus: Sequence[float]) -> Column:
    """The mean over `taus` of the pinball losses of the quantiles in array `q`."""
    losses = [F.greatest(t * (y - F.get(q, F.lit(i))), (t - 1) * (y - F.get(q, F.lit(i)))) for i, t in enumerate(taus)]
    return sum(losses[1:], losses[0]) / len(taus)


def origins(n_days: int, folds: int, step: int, horizon: int, least: int) -> list[int]:
    """Positions of the last training day of each fold, ascending; every fold has its whole horizon."""
    latest = n_days - horizon - 1
    return sorted(p for p in (latest - k * step for k in range(folds)) if p >= least)


def folds(rows: DataFrame, n: int, step: int, horizon: int, least: int) -> DataFrame:
    """fold, origin, until: one row a fold, over the distinct dates of `rows` (a few thousand)."""
    found = sorted(r[0] for r in rows.select("business_date").distinct().collect())
    at = origins(len(found), n, step, horizon, least)
    made = [(i, found[p], found[p + horizon]) for i, p in enumerate(at)]
    return rows.sparkSession.createDataFrame(made, "fold int, origin date, until date")


def rolling_origin(rows: DataFrame, split: DataFrame, taus: Sequence[float], days: int = 250) -> DataFrame:
    """fold, model, n, pinball_mean, interval_score_90 of the baselines; all folds in one job.

    A fold's training rows are those up to its origin, its test rows those after it up to `until`.
    """
    split = F.broadcast(split)
    train = rows.join(split, F.col("business_date") <= F.col("origin")).withColumn("dow", F.weekday("business_date"))
    test = rows.join(split, (F.col("business_date") > F.col("origin")) & (F.col("business_date") <= F.col("until"))).withColumn("dow", F.weekday("business_date"))
    dates = train.select("fold", "business_date").distinct()
    # One row a fold and date.
    rank = F.row_number().over(Window.partitionBy("fold").orderBy(F.desc("business_date")))
    last = F.broadcast(dates.withColumn("r", rank).where(F.col("r") <= days).drop("r"))
    grid, lane = F.array(*map(F.lit, taus)), ["fold", "app_id", "interval_idx"]
    prev = F.lag("mips").over(Window.partitionBy(*lane, "dow").orderBy("business_date"))
    train = train.withColumn("prev", prev)
    near = train.join(last, ["fold", "business_date"], "left_semi")
    climate = near.groupBy(*lane, "dow").agg(F.percentile("mips", grid).alias("q"))
    ratios = near.groupBy(*lane).agg(F.percentile(F.when(F.col("prev") > 0, F.col("mips") / F.col("prev")), grid).alias("r"))
    base = train.groupBy(*lane, "dow").agg(F.max_by("mips", "business_date").alias("base"))
    naive = base.join(ratios, lane).select(*lane, "dow", F.transform(F.coalesce("r", F.lit([1.0] * len(taus))), lambda r: r * F.col("base")).alias("q"))
    models = climate.withColumn("model", F.lit("interval_climatology")).unionByName(naive.withColumn("model", F.lit("seasonal_naive")))
    scored = test.join(models, [*lane, "dow"])
    y, q = F.col("mips"), F.col("q")
    score = interval_score(y, F.get(q, F.lit(0)), F.get(q, F.lit(len(taus) - 1)), taus[-1] - taus[0])
    return scored.groupBy("fold", "model").agg(F.count("*").alias("n"), F.avg(pinball(y, q, taus)).alias("pinball_mean"), F.avg(score).alias("interval_score"))


def leaderboard(scores: DataFrame) -> DataFrame:
    """Mean scores per model over folds, and the rank by pinball loss."""
    board = scores.groupBy("model").agg(F.count("*").alias("n_folds"), F.avg("pinball_mean").alias("pinball_mean"), F.avg("interval_score").alias("interval_score"))
    # One row a model.
    return board.withColumn("place", F.row_number().over(Window.orderBy("pinball_mean", "model")))


def compare_to_submissions(model: DataFrame, submissions: DataFrame, realised: DataFrame) -> DataFrame:
    """Errors of the modelled and the submitted peak against the realised one, per app and fiscal year."""
    out = realised.join(submissions, ["app_id", "fiscal_year"]).join(model, ["app_id", "fiscal_year"])
    truth = F.col("realised_peak_mips")
    for side, column in (("submission", "submitted_peak_mips"), ("model", "model_peak_mips")):
        out = out.withColumn(f"{side}_error", F.col(column) - truth).withColumn(f"{side}_abs_pct", 100 * F.abs(F.col(column) - truth) / F.nullif(truth, F.lit(0.0)))
    return out.withColumn("model_better", F.col("model_abs_pct") < F.col("submission_abs_pct"))


def summarise(comparison: DataFrame) -> DataFrame:
    """One row: plain and size-weighted errors, biases, and the model's share of wins, overall and in the top fifth."""
    truth = F.col("realised_peak_mips")
    n = comparison.count()
    top = comparison.orderBy(F.desc(truth), "app_id", "fiscal_year").limit(max(1, n // 5))
    sides = [
        f(side)
        for side in ("submission", "model")
        for f in (
            lambda s: F.avg(f"{s}_abs_pct").alias(f"{s}_mape"),
            lambda s: (F.sum(truth * F.col(f"{s}_abs_pct")) / F.sum(truth)).alias(f"{s}_mape_weighted"),
            lambda s: (100 * F.avg(F.col(f"{s}_error") / truth)).alias(f"{s}_bias_pct"),
        )
    ]
    won = F.avg(F.col("model_better").cast("double"))
    whole = comparison.agg(F.count("*").alias("n_comparisons"), won.alias("model_better_share"), *sides)
    return whole.join(F.broadcast(top.agg(won.alias("model_better_share_top"))))


def debiased_submissions(submissions: DataFrame, bias: DataFrame) -> DataFrame:
    """Submissions over the app's past ratio; an app with fewer than two cycles keeps its figure. `bias`: app_id, bias_ratio, n_cycles."""
    out = submissions.join(bias.select("app_id", "bias_ratio", "n_cycles"), "app_id", "left")
    ratio = F.when(F.coalesce("n_cycles", F.lit(0)) < 2, 1.0).otherwise(F.coalesce("bias_ratio", F.lit(1.0)))
    return out.withColumn("bias_ratio", ratio).withColumn("debiased_peak_mips", F.col("submitted_peak_mips") / F.col("bias_ratio"))


def gate_verdict(board: DataFrame, champion: str) -> str:
    """Whether the champion has the least mean pinball loss."""
    ranked = [r["model"] for r in board.orderBy("place").collect()]
    if champion not in ranked:
        return "INCONCLUSIVE"
    return "PASSED" if ranked[0] == champion else f"FAILED: {ranked[0]} scores better"


def realised(rows: DataFrame, dirty: DataFrame | None = None) -> DataFrame:
    """Per lpar: the greatest daily total peak, with and without the dates in `dirty`, and how many dates those are."""
    daily = rows.groupBy("lpar", "business_date", "interval_idx").agg(F.sum("mips").alias("v")).groupBy("lpar", "business_date").agg(F.max("v").alias("peak"))
    flag = F.lit(False)
    if dirty is not None:
        marked = dirty.select("business_date").distinct().withColumn("_dirty", F.lit(True))
        daily, flag = daily.join(marked, "business_date", "left"), F.coalesce("_dirty", F.lit(False))
    return daily.groupBy("lpar").agg(
        F.max("peak").alias("all_days"), F.max(F.when(~flag, F.col("peak"))).alias("clean_days"), F.count_if(flag).alias("n_excluded")
    )
