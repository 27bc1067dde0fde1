"""Linear quantile regression on distributed Gram matrices, and the recursive forecast per application."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.functions import calendar as cal
from crestline.operators import model as mod

INTRADAY, ANNUAL = 3, 2
#: Days of past values a forecast's features look at.
CONTEXT = max(mod.ROLLS)


@dataclass
class Spec:
    """The origin and damping of the trend, fixed when fitting."""

    origin: date
    years_max: float
    phi: float = 0.5
    per_day: int = 9

    def calendar_columns(self) -> dict[str, Column]:
        """Features of business_date and interval_idx alone; rows have month_end, quarter_end and fy_position."""
        out: dict[str, Column] = {}
        for name, x, period, most in (("intraday", F.col("interval_idx"), float(self.per_day), INTRADAY), ("annual", F.dayofyear("business_date"), 365.25, ANNUAL)):
            for k in range(1, most + 1):
                out[f"{name}_sin{k}"], out[f"{name}_cos{k}"] = mod.fourier(x, period, k)
        out |= {f"dow_{i}": (F.least(F.weekday("business_date"), F.lit(4)) == i).cast("double") for i in range(5)}
        out |= {"f_month_end": F.col("month_end").cast("double"), "f_quarter_end": F.col("quarter_end").cast("double"), "f_fy_position": F.col("fy_position").cast("double")}
        out["years_elapsed"] = mod.damped_years(F.col("business_date"), F.lit(self.origin), self.years_max, self.phi)
        return out

    def names(self) -> list[str]:
        past = [f"lag_{k}" for k in mod.LAGS] + [f"{s}_{w}" for w in mod.ROLLS for s in ("mean", "std")]
        return [*self.calendar_columns(), *past, "log_scale"]


def design(dense: DataFrame, days: DataFrame, scales: DataFrame, spec: Spec) -> DataFrame:
    """app_id, business_date, interval_idx, y, x (the features in order), valid.

    `dense` has every app, date and interval, mips null where it is missing or anomalous. A row is
    valid if its value and all features are there.
    """
    rows = dense.join(F.broadcast(scales), "app_id").withColumn("mips", F.col("mips") / F.col("scale"))
    rows = mod.lag_features(rows).join(F.broadcast(days.select("business_date", "month_end", "quarter_end", "fy_position")), "business_date")
    rows = rows.withColumns(spec.calendar_columns()).withColumn("log_scale", F.ln("scale"))
    x = F.array(*[F.col(n).cast("double") for n in spec.names()])
    full = F.col("mips").isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v))
    return rows.select("app_id", "business_date", "interval_idx", F.col("mips").alias("y"), x.alias("x"), full.alias("valid"))


@dataclass
class QuantileRidge:
    """Ridge-penalised quantile regression by reweighted least squares, all quantiles in each pass over the rows.

    Each pass yields one weighted Gram matrix a partition and quantile; the driver adds and solves them.
    `max_rows` bounds the sample fitted on, chosen by hash, and with it the number of partitions.
    """

    taus: Sequence[float]
    alpha: float = 1.0
    passes: int = 40
    first: float = 0.5
    last: float = 1e-5
    tolerance: float = 1e-6
    max_rows: int = 400_000
    coef: np.ndarray = field(default=None, repr=False)
    mean: np.ndarray = field(default=None, repr=False)
    std: np.ndarray = field(default=None, repr=False)

    def fit(self, rows: DataFrame) -> QuantileRidge:
        """`rows` as made by design(); only valid ones are used."""
        used = rows.where("valid").select("y", "x", F.xxhash64("app_id", "business_date", "interval_idx").alias("h"))
        n = used.count()
        if not n:
            raise ValueError("no valid rows to fit on")
        if n > self.max_rows:
            used = used.where(F.pmod("h", F.lit(1_000_000)) < int(1_000_000 * self.max_rows / n))
        used = used.select("y", "x").coalesce(32).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._standardise(used)
            self._iterate(used)
        finally:
            used.unpersist()
        return self

    def _standardise(self, used: DataFrame) -> None:
        width = len(used.select("x").first()["x"])
        one = lambda i: F.get("x", F.lit(i))
        got = used.agg(*[f(one(i)) for f in (F.avg, F.stddev_pop) for i in range(width)]).first()
        self.mean = np.array(got[:width], dtype=float)
        self.std = np.maximum(np.array(got[width:], dtype=float), 1e-8)

    def _gram(self, used: DataFrame, coef: np.ndarray | None, eps: float) -> np.ndarray:
        """Per quantile, X'WX with X'Wy as a last column; one plain Gram matrix without coefficients."""
        taus, mean, std = np.array(self.taus), self.mean, self.std

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for b in batches:
                if not len(b):
                    continue
                x = np.column_stack([np.ones(len(b)), (np.stack(b["x"].to_numpy()) - mean) / std])
                y = b["y"].to_numpy()
                if coef is None:
                    weights = np.ones((1, len(b)))
                else:
                    r = y - coef @ x.T
                    weights = np.where(r >= 0, taus[:, None], 1 - taus[:, None]) / np.maximum(np.abs(r), eps)
                xy = np.column_stack([x, y])
                made = np.stack([(x.T * w) @ xy for w in weights])
                total = made if total is None else total + made
            if total is not None:
                yield pd.DataFrame({"i": range(len(total)), "g": [t.ravel() for t in total]})

        got = used.mapInPandas(part, "i int, g array<double>").collect()
        p = len(mean) + 1
        out = np.zeros((1 if coef is None else len(taus), p, p + 1))
        for row in got:
            out[row["i"]] += np.array(row["g"]).reshape(p, p + 1)
        return out

    def _iterate(self, used: DataFrame) -> None:
        p = len(self.mean) + 1
        penalty = self.alpha * np.eye(p)
        penalty[0, 0] = 0.0
        solved = lambda g: np.stack([np.linalg.solve(m[:, :p] + penalty, m[:, p]) for m in g])
        coef = np.repeat(solved(self._gram(used, None, 0.0)), len(self.taus), axis=0)
        for eps in np.geomspace(self.first, self.last, self.passes):
            new = solved(self._gram(used, coef, eps))
            moved, coef = np.abs(new - coef).max(), new
            if moved < self.tolerance and eps <= self.last:
                break
        self.coef = coef

    def predict(self, x: Column) -> Column:
        """The quantiles of a row with features `x`, ascending; JVM expressions only."""
        if self.coef is None:
            raise RuntimeError("predict before fit")
        slopes = self.coef[:, 1:] / self.std
        starts = self.coef[:, 0] - slopes @ self.mean
        dots = [reduce(lambda a, b: a + b, [F.get(x, F.lit(i)) * float(v) for i, v in enumerate(s)], F.lit(float(c))) for s, c in zip(slopes, starts)]
        return F.array_sort(F.array(*dots))

    def predict_rows(self, x: np.ndarray) -> np.ndarray:
        return np.sort(np.column_stack([np.ones(len(x)), (x - self.mean) / self.std]) @ self.coef.T, axis=1)


#: Backends by name.
BACKENDS = {"quantile_ridge": QuantileRidge}


def build_backend(name: str, taus: Sequence[float], **more):
    if name == "neuralforecast":
        raise NotImplementedError("the neural backend needs a library that is not installed")
    if name not in BACKENDS:
        raise KeyError(f"unknown backend {name!r}; there are {sorted(BACKENDS)}")
    return BACKENDS[name](taus=taus, **more)


def fitted(rows: DataFrame, model: QuantileRidge, scales: DataFrame) -> DataFrame:
    """In-sample quantiles `q` in MIPS; null on rows that aren't valid."""
    out = rows.join(F.broadcast(scales), "app_id").withColumn("q", F.when(F.col("valid"), model.predict(F.col("x"))))
    return out.select("app_id", "business_date", "interval_idx", (F.col("y") * F.col("scale")).alias("mips"), F.transform("q", lambda v: v * F.col("scale")).alias("q"))


def monotone(q: Column) -> Column:
    """Quantiles in ascending order, none below 0."""
    return F.transform(F.array_sort(q), lambda v: F.greatest(v, F.lit(0.0)))


def spread(q: Column, taus: Sequence[float], low: float, high: float) -> Column:
    """The distance between the quantiles nearest to low and high, at least a fiftieth of the median and a tenth."""
    at = lambda t: F.get(q, F.lit(int(np.argmin(np.abs(np.array(taus) - t)))))
    return F.greatest(at(high) - at(low), 0.02 * F.abs(at(0.5)), F.lit(0.1))


def recursion_weight(step: int, pure: int = 20, blend: int = 20) -> float:
    """How much of the model's own median is fed back at a step: 1 at first, then falling linearly to 0."""
    if step < pure:
        return 1.0
    return max(0.0, 1 - (step - pure + 1) / blend) if blend > 0 else 0.0


def profile(dense: DataFrame, scales: DataFrame, days: int = 250) -> DataFrame:
    """The scaled median per app and interval over the last dates; 0 where there is none."""
    out = mod.recent(dense, days).groupBy("app_id", "interval_idx").agg(F.percentile("mips", 0.5).alias("m")).join(F.broadcast(scales), "app_id")
    return out.select("app_id", "interval_idx", F.coalesce(F.col("m") / F.col("scale"), F.lit(0.0)).alias("profile"))


def forecast(dense: DataFrame, future: DataFrame, scales: DataFrame, growth: DataFrame, feed: DataFrame, model: QuantileRidge, spec: Spec) -> DataFrame:
    """app_id, business_date, interval_idx, q: quantiles in MIPS over the dates of `future`.

    A day's features need the days before it, so each application runs its own loop; applications
    are independent. A group holds CONTEXT days of one application, whatever the history's length.
    """
    grid = spec.per_day
    base = future.crossJoin(future.sparkSession.range(grid).select(F.col("id").cast("int").alias("interval_idx")))
    # One row a future day and interval: a horizon of a few hundred days.
    known = spec.calendar_columns()
    ahead = base.select("business_date", "interval_idx", *[v.alias(k) for k, v in known.items()]).orderBy("business_date", "interval_idx").toPandas()
    dates = ahead["business_date"].iloc[::grid].tolist()
    marks = ahead[list(known)].to_numpy(dtype=float).reshape(len(dates), grid, -1)
    last = dense.agg(F.max("business_date")).first()[0]
    lanes = Window.partitionBy("app_id", "interval_idx").orderBy(F.desc("business_date"))
    tail = dense.withColumn("back", F.row_number().over(lanes)).where(F.col("back") <= CONTEXT)
    tail = tail.join(profile(dense, scales), ["app_id", "interval_idx"]).join(feed, ["app_id", "interval_idx"], "left").join(F.broadcast(scales), "app_id").join(F.broadcast(growth.select("app_id", "growth")), "app_id", "left")
    columns = ["app_id", "interval_idx", "back", "mips", "profile", "scale", F.coalesce("feed", F.lit(1.0)).alias("feed"), F.coalesce("growth", F.lit(0.0)).alias("growth")]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        scale, rate = float(rows["scale"].iloc[0]), float(rows["growth"].iloc[0])
        past = rows.pivot_table(index="back", columns="interval_idx", values="mips", dropna=False).reindex(index=range(CONTEXT, 0, -1), columns=range(grid)).to_numpy(dtype=float) / scale
        middle = np.array([np.median(c[~np.isnan(c)]) if (~np.isnan(c)).any() else 0.0 for c in past.T])
        past = np.where(np.isnan(past), middle, past)
        cells = rows.drop_duplicates("interval_idx").set_index("interval_idx").reindex(range(grid))
        anchor, gross = cells["profile"].fillna(0.0).to_numpy(dtype=float), cells["feed"].fillna(1.0).to_numpy(dtype=float)
        centre = int(np.argmin(np.abs(np.array(model.taus) - 0.5)))
        made = []
        for step, day in enumerate(dates):
            seen = [past[-k] for k in mod.LAGS] + [f(past[-w:], axis=0) for w in mod.ROLLS for f in (np.mean, np.std)]
            q = model.predict_rows(np.column_stack([marks[step], *seen, np.full(grid, np.log(scale))]))
            made.append(q)
            years = (day - last).days / 365.25 * spec.phi
            w = recursion_weight(step)
            fed = (w * q[:, centre] + (1 - w) * anchor * np.exp(rate * years)) * gross
            past = np.vstack([past[1:], fed])
        q = np.maximum(np.sort(np.concatenate(made), axis=1) * scale, 0.0)
        return pd.DataFrame({"app_id": rows["app_id"].iloc[0], "business_date": np.repeat(dates, grid), "interval_idx": np.tile(np.arange(grid), len(dates)), "q": list(q)})

    return tail.select(*columns).groupBy("app_id").applyInPandas(run, "app_id string, business_date date, interval_idx int, q array<double>")


def to_long(cube: DataFrame, taus: Sequence[float], keep: Sequence[str] = ()) -> DataFrame:
    """One row per cell and quantile: tau, value, and the columns to keep."""
    grid = F.array(*map(F.lit, taus))
    return cube.select("app_id", "business_date", "interval_idx", *keep, F.posexplode("q").alias("i", "value")).withColumn("tau", F.get(grid, F.col("i"))).drop("i")


def trained(dense: DataFrame, days: DataFrame, spec: Spec, taus: Sequence[float] = tuple(mod.QUANTILES), backend: str = "quantile_ridge") -> tuple[QuantileRidge, DataFrame, DataFrame]:
    """The fitted model, the design and the scales of a dense panel."""
    scales = mod.scales(dense).persist()
    rows = design(dense, days, scales, spec)
    return build_backend(backend, taus).fit(rows), rows, scales
