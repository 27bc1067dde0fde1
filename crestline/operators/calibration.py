"""Split-conformal calibration: a forecast made without the last days is held against them, and shifts make up for what it misses."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.operators import quantile as qua

CELL = ["app_id", "business_date", "interval_idx"]
#: Scores of a group are cut into as many bins, of which one is sorted.
BINS = 64
SHIFTS = "app_id string, tau double, adj double, used_pooled boolean, n_scores bigint"
#: Given rows to train on and the days to come: a cube (app_id, business_date, interval_idx, q).
Forecaster = Callable[[DataFrame, Sequence[date]], DataFrame]


def split_holdout(rows: DataFrame, days: int) -> tuple[DataFrame, DataFrame]:
    """The rows before the last `days` dates, and those of the last `days` dates; ValueError where none or all would be held out."""
    dates = rows.where("business_date is not null").select("business_date").distinct()
    last = [r[0] for r in dates.orderBy(F.desc("business_date")).limit(days + 1).collect()] if days > 0 else []
    if len(last) <= max(days, 0):
        raise ValueError(f"{days} dates cannot be held out")
    return rows.where(F.col("business_date") <= F.lit(last[-1])), rows.where(F.col("business_date") > F.lit(last[-1]))


def observed(rows: DataFrame) -> DataFrame:
    """The load of each cell without anomalous rows and missing values; the lpars of an app are added up."""
    if "is_anomaly" in rows.columns:
        rows = rows.where(~F.coalesce("is_anomaly", F.lit(False)))
    return rows.groupBy(*CELL).agg(F.sum("mips").alias("y")).where("y is not null")


def outside(y: Column, low: Column, high: Column) -> Column:
    """How far a value lies outside its interval; below 0, how far inside."""
    return F.greatest(low - y, y - high)


def order_statistic(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys: n and adj, the conformal quantile of `s` at `level` (a column that keys determine).

    That is the value at position ceil(l * (n - 1)) from 0, with l = min(1, ceil((n + 1) * level) / n). Equal scores
    are counted before they move, a group is cut into bins at its approximate quantiles, and only the bin that holds
    the position is sorted, so no task gets a group whole. Null and NaN scores are left out.
    """
    known = scores.where(F.col("s").isNotNull() & ~F.isnan("s"))
    counted = known.groupBy(*keys, "s").agg(F.count("*").alias("c"))
    cuts = F.percentile_approx("s", [i / BINS for i in range(1, BINS)], 10_000).alias("cuts")
    groups = known.groupBy(*keys).agg(cuts, F.count("*").alias("n"), F.first("level").alias("level"))
    share = F.least(F.lit(1.0), F.ceil((F.col("n") + 1) * F.round("level", 9)) / F.col("n"))
    groups = groups.withColumn("at", F.ceil(F.round(share * (F.col("n") - 1), 9)))
    # Without the app, keys are a few levels, so that the groups are a few rows.
    small = (lambda df: df) if "app_id" in keys else F.broadcast
    binned = counted.join(small(groups), keys).withColumn("bin", F.size(F.filter("cuts", lambda e: e < F.col("s"))))
    upto = F.sum("size").over(Window.partitionBy(*keys).orderBy("bin"))  # at most BINS rows a group
    sizes = binned.groupBy(*keys, "bin").agg(F.sum("c").alias("size"), F.first("at").alias("at")).withColumn("upto", upto)
    hit = sizes.where((F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("size")))
    hit = hit.select(*keys, "bin", (F.col("at") - F.col("upto") + F.col("size")).alias("left"))
    inside = binned.join(small(hit), [*keys, "bin"]).withColumn("upto", F.sum("c").over(Window.partitionBy(*keys).orderBy("s")))
    return inside.where((F.col("left") < F.col("upto")) & (F.col("left") >= F.col("upto") - F.col("c"))).select(*keys, "n", F.col("s").alias("adj"))


def _by_app(scores: DataFrame, key: str, least: int) -> DataFrame:
    """app_id, key, adj, used_pooled, n_scores; of all apps together where an app has fewer than `least` scores."""
    own, pooled = order_statistic(scores, ["app_id", key]), order_statistic(scores, [key]).select(key, F.col("adj").alias("pooled"))
    few = F.col("n") < least
    return own.join(F.broadcast(pooled), key).select("app_id", key, F.when(few, F.col("pooled")).otherwise(F.col("adj")).alias("adj"), few.alias("used_pooled"), F.col("n").alias("n_scores"))


def one_sided(scored: DataFrame, least: int = 200) -> DataFrame:
    """Per app and tau the shift that makes y <= q hold with probability tau; `scored` has app_id, tau, y and q."""
    return _by_app(scored.select("app_id", "tau", (F.col("y") - F.col("q")).alias("s"), F.col("tau").alias("level")), "tau", least)


def symmetric(scored: DataFrame, taus: Sequence[float], least: int = 200) -> DataFrame:
    """Per app and tau the shift of intervals that are widened or narrowed by the same amount at both ends.

    `scored` has app_id, y and q, an array by `taus`. Quantiles are paired by position from the ends to the one next
    to 0.5; those without a partner stay where they are.
    """
    centre = min(range(len(taus)), key=lambda i: abs(taus[i] - 0.5))
    ends = [(low, high) for low, high in zip(range(centre), reversed(range(len(taus)))) if low < high]
    if not ends:
        return scored.sparkSession.createDataFrame([], SHIFTS)
    pair = [F.struct(F.lit(a).alias("pair"), F.lit(taus[b] - taus[a]).alias("level"), outside(F.col("y"), F.get("q", F.lit(a)), F.get("q", F.lit(b))).alias("s")) for a, b in ends]
    widths = _by_app(scored.select("app_id", F.inline(F.array(*pair))), "pair", least)

    def shift(tau: float, sign: float) -> Column:
        return F.struct(F.lit(tau).alias("tau"), (F.col("adj") * sign if sign else F.lit(0.0)).alias("adj"))

    alone = [shift(t, 0.0) for i, t in enumerate(taus) if all(i not in e for e in ends)]
    out = F.lit(None)
    for a, b in reversed(ends):
        out = F.when(F.col("pair") == a, F.array(shift(taus[a], -1.0), shift(taus[b], 1.0), *(alone if a == 0 else []))).otherwise(out)
    return widths.select("app_id", "used_pooled", "n_scores", F.inline(out)).select("app_id", "tau", "adj", "used_pooled", "n_scores")


def shifted(cube: DataFrame, shifts: DataFrame, taus: Sequence[float]) -> DataFrame:
    """The cube with its quantiles shifted, put back in order and not below 0.

    An app without shifts, or with shifts at other levels than `taus`, is an error when its rows are read; shifts of
    apps that the cube lacks are of no effect.
    """
    grid = F.array(*[F.lit(round(t, 9)) for t in taus])
    steps = F.array_sort(F.collect_list(F.struct(F.round("tau", 9).alias("tau"), "adj")))  # one a level
    per_app = shifts.groupBy("app_id").agg(steps.alias("_steps"))
    fits = F.col("_steps.tau") == grid
    q = qua.monotone(F.zip_with("q", "_steps.adj", lambda v, a: v + a))
    wrong = F.raise_error(F.concat(F.lit("no shifts at these levels for app "), F.coalesce("app_id", F.lit("null"))))
    return cube.join(per_app, "app_id", "left").withColumn("q", F.when(F.coalesce(fits, F.lit(False)), q).otherwise(wrong)).drop("_steps").select(*cube.columns)


@dataclass
class Calibration:
    """What calibrate() found. `scored` is kept for its readers until release()."""

    shifts: DataFrame
    scored: DataFrame
    taus: Sequence[float]

    def coverage(self) -> DataFrame:
        """Per tau: n, and the share of y <= q before and after the shifts, on the very days they were learned from."""
        both = shifted(self.scored.withColumn("raw", F.col("q")), self.shifts, self.taus)
        levels = F.arrays_zip(F.array(*map(F.lit, self.taus)).alias("tau"), F.col("raw"), F.col("q"))
        long = both.select("y", F.explode(levels).alias("e")).select("y", F.col("e")["tau"].alias("tau"), F.col("e")["raw"].alias("raw"), F.col("e")["q"].alias("q"))
        share = lambda c: F.avg((F.col("y") <= F.col(c)).cast("double"))
        return long.groupBy("tau").agg(F.count("*").alias("n"), share("raw").alias("before"), share("q").alias("after"))

    def summary(self) -> DataFrame:
        """One row: sizes of the shifts, apps that took the pooled ones, and the mean distance of shares from levels."""
        a = self.shifts.agg(F.avg(F.abs("adj")).alias("mean_abs_shift"), F.max(F.abs("adj")).alias("max_abs_shift"), F.countDistinct(F.when(F.col("used_pooled"), F.col("app_id"))).alias("apps_pooled"))
        off = lambda c: F.avg(F.abs(F.col(c) - F.col("tau")))
        return a.join(F.broadcast(self.coverage().agg(off("before").alias("error_before"), off("after").alias("error_after"))), how="cross")  # one row by one

    def release(self) -> None:
        self.scored.unpersist()


def calibrate(rows: DataFrame, days: int, forecaster: Forecaster, taus: Sequence[float], least: int = 200, method: str = "one_sided") -> Calibration:
    """Forecasts the last `days` dates from the rows before them and learns the shifts from the scores.

    The forecaster never sees the days it is scored on. Anomalous rows are neither trained on nor scored.
    """
    if method not in ("one_sided", "symmetric"):
        raise ValueError(f"unknown method {method!r}")
    train, held = split_holdout(rows, days)
    ahead = sorted(r[0] for r in held.select("business_date").distinct().collect())  # `days` dates
    seen = train.where(~F.coalesce("is_anomaly", F.lit(False))) if "is_anomaly" in rows.columns else train
    scored = observed(held).join(forecaster(seen, ahead), CELL).select(*CELL, "y", "q").persist()
    if method == "symmetric":
        return Calibration(symmetric(scored, taus, least), scored, taus)
    long = qua.to_long(scored.select(*CELL, "q", "y"), taus, keep=["y"]).withColumnRenamed("value", "q")
    return Calibration(one_sided(long, least), scored, taus)
