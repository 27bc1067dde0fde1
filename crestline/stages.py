"""The stages of a planning run: from a source to the lake, from the lake to recorded runs.

Runs are written by Spark, so on a cluster the registry's folder must be one that driver and executors share.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crestline.functions import calendar as cal
from crestline.operators import backtest as bat
from crestline.operators import calibration as con
from crestline.operators import dependence as dep
from crestline.operators import diagnostics as dia
from crestline.operators import evaluation as eva
from crestline.operators import horizon as hor
from crestline.operators import ingest as ing
from crestline.operators import model as mod
from crestline.operators import pack as pck
from crestline.operators import serving as srv
from crestline.operators import simulation as sim
from crestline.registry import Registry, Run
from crestline.sources import lake

SHIFTS = "shifts"
REDUCERS = ["annual_max", "mean_of_monthly_peaks", "p95_of_daily_peaks"]


def _save(run: Run, name: str, df: DataFrame) -> None:
    df.write.mode("overwrite").parquet(str(run.folder / name))
    run.add(name, name)


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return lake.read_table(spark, folder, "intervals").where("not coalesce(is_anomaly, false)")


def tables(spark: SparkSession, folder: str) -> dict[str, int]:
    """Rows of each table the lake has."""
    return {t: lake.read_table(spark, folder, t).count() for t in lake.register_views(spark, folder)}


def ingest(spark: SparkSession, source: lake.Source, start: date, end: date, folder: str, grid: cal.Grid = cal.Grid(), environments: Sequence[str] = ("PROD",), apps: int | None = None) -> list[str]:
    """Extracts, labels, scopes and writes; the names of the tables written. Anomalies that the source states stay."""
    got = lake.extract(source, start, end, grid)
    rows = got["intervals"]
    if "events" in got:
        # A few hundred events.
        seq = F.row_number().over(Window.orderBy("start_ts", "event_id"))
        rows = ing.label(rows, got["events"].withColumn("event_seq", seq))
    rows = ing.scope(rows, list(environments), grid=grid)
    got["intervals"] = ing.top_apps(rows, apps) if apps else rows
    written = lake.write_lake(got, folder)
    if lake.read_table(spark, folder, "intervals").isEmpty():
        raise RuntimeError("no intervals are in scope")
    return written


def diagnostics(spark: SparkSession, folder: str, runs: Registry) -> str:
    """Coincidence and profile of the lake, saved; the verdict on going on."""
    run, rows = runs.start("diagnostics"), _clean(spark, folder)
    daily = dia.coincidence(rows)
    _save(run, "coincidence", dia.coincidence_summary(daily))
    _save(run, "profile", dia.profile(rows))
    head = dia.headline(daily).first().asDict()
    said = dia.verdict(head["mean_c"])
    run.note("metrics", head | {"verdict": said})
    run.finish()
    return said


def coincidence(spark: SparkSession, folder: str, runs: Registry, days: int = 250) -> str:
    """Daily factors of the last dates, saved; the verdict on their number."""
    run, rows = runs.start("coincidence"), _clean(spark, folder)
    factors = sim.factor(mod.recent(rows, days))
    _save(run, "factors", factors)
    found = dep.adequacy(factors).first().asDict()
    run.note("metrics", found | dep.factor_summary(factors).first().asDict())
    run.finish()
    return found["verdict"]


def _dense(spark: SparkSession, folder: str) -> DataFrame:
    return ing.densify(_clean(spark, folder)).select("app_id", "business_date", "interval_idx", "mips")


def train(spark: SparkSession, folder: str, runs: Registry, grid: cal.Grid = cal.Grid(), held: int = 60) -> dict[float, float]:
    """Fits on the whole lake; per tau the share of in-sample values below its quantile. Growth is saved.

    Where the history is longer than twice `held` dates, the fit is repeated without the last of them, and the
    shifts that calibrate it are saved with the coverage before and after.
    """
    run, dense = runs.start("train"), _dense(spark, folder).persist()
    last = dense.agg(F.max("business_date")).first()[0]
    first, _ = grid.horizon(last, 1)
    ahead = [r[0] for r in cal.days(spark, first, date(first.year + 1, first.month, 1), grid).limit(1).collect()]
    known, _ = bat.regression(grid, grid.per_day)(dense, ahead)
    shares = known.agg(*[F.avg((F.col("mips") <= F.col(q)).cast("double")) for q in ("q10", "med", "q90")]).first()
    _save(run, "growth", mod.growth(dense.where("mips is not null")))
    found = dict(zip(bat.TAUS, shares))
    run.note("metrics", {f"coverage_{t}": v for t, v in found.items()})
    if dense.select("business_date").distinct().count() > 2 * held:
        cube = lambda rows, days: bat.refitted(rows, days, grid, grid.per_day)[1]
        got = con.calibrate(dense, held, cube, bat.TAUS)
        _save(run, SHIFTS, got.shifts)
        _save(run, "coverage", got.coverage())
        run.note("calibration", {"held_days": held} | got.summary().first().asDict())
        got.release()
    run.finish()
    dense.unpersist()
    return found


def _shifts(spark: SparkSession, runs: Registry) -> DataFrame | None:
    """The shifts of the latest training, if it has any."""
    if not runs.runs("train"):
        return None
    folder = runs.find("train").folder / SHIFTS
    return spark.read.parquet(str(folder)) if folder.exists() else None


def simulate(spark: SparkSession, folder: str, runs: Registry, grid: cal.Grid = cal.Grid(), years: int = 2, paths: int = 1000, seed: int = 20260101, block: int = 1, reducers: Sequence[str] = REDUCERS, factors: DataFrame | None = None) -> Run:
    """Paths up to the end of the n-th fiscal year ahead, reduced to the serving tables, which are saved.

    The forecast is calibrated by the shifts of the latest training, which must know every application.
    """
    run, dense = runs.start("simulate"), _dense(spark, folder).persist()
    last = dense.agg(F.max("business_date")).first()[0]
    calendar = cal.days(spark, *grid.horizon(last, years), grid).select("business_date", "fiscal_year")
    ahead = [(r[0], r[1], i) for i, r in enumerate(calendar.orderBy("business_date").collect())]
    days = F.broadcast(spark.createDataFrame(ahead, "business_date date, fiscal_year int, day_idx int"))
    shifts = _shifts(spark, runs)
    known, forecast = bat.regression(grid, grid.per_day, shifts=shifts)(dense, [a[0] for a in ahead])
    r = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.col("mips") - F.col("med")) / bat.half_spread()))
    pooled = sim.pool(known.select("app_id", "business_date", "interval_idx", r.alias("r"))).persist()
    n = (pooled.agg(F.max("pool_idx")).first()[0] if not pooled.isEmpty() else -1) + 1
    by_day = forecast.join(days, "business_date").select("day_idx", "app_id", "interval_idx", "med", bat.half_spread().alias("half"))
    drawn = sim.draws(spark, paths, len(ahead), sim.hashed(seed, n, block))
    cells = hor.cells(drawn, pooled, by_day).persist()
    daily = hor.daily(drawn, hor.totals(cells, grid.per_day)).join(days, "day_idx")
    if factors is not None:
        daily = hor.with_factor(daily.withColumn("dow", F.weekday("business_date")), factors, grid.per_day, seed)
    if mod.needs_r4ha(list(reducers)):
        daily = hor.rolling(daily, ["path_id"], "total", max(1, round(240 / grid.minutes)), grid.per_day).withColumnRenamed("r4ha", "daily_r4ha")
    daily = daily.drop("total").withColumnsRenamed({"peak": "daily_peak", "mean": "daily_mean"}).persist()
    peaks = hor.app_peaks(drawn, cells)
    _save(run, "sim_daily", daily)
    _save(run, "fy_summary", srv.fy_summary(srv.path_figures(daily, list(reducers))))
    _save(run, "app_peaks", srv.app_peaks(peaks))
    _save(run, "daily_profile", srv.daily_profile(daily))
    _save(run, "growth", mod.growth(dense.where("mips is not null")))
    run.note("metrics", hor.coincidence(daily.withColumnRenamed("daily_peak", "peak"), peaks).first().asDict())
    run.note("record", {"paths": paths, "seed": seed, "pool_days": n, "calibrated": shifts is not None, "reducers": list(reducers)})
    run.finish()
    for df in (dense, pooled, cells, daily):
        df.unpersist()
    return run


def evaluate(spark: SparkSession, folder: str, runs: Registry, folds: int = 3, horizon: int = 60) -> str:
    """The baselines over rolling origins, saved; the leader."""
    run, rows = runs.start("evaluate"), _clean(spark, folder)
    scores = eva.rolling_origin(rows, eva.folds(rows, folds, horizon, horizon, horizon), mod.QUANTILES)
    board = eva.leaderboard(scores)
    _save(run, "leaderboard", board)
    leader = board.orderBy("place").first()
    run.finish()
    if leader is None:
        raise ValueError("the history is too short for a fold")
    return leader["model"]


def backtest(spark: SparkSession, folder: str, runs: Registry, grid: cal.Grid = cal.Grid(), horizon: int = 120, folds: int = 3, paths: int = 500) -> str:
    """The simulation of the regression, refitted at each origin, against what came, saved; the verdict."""
    rows = lake.read_table(spark, folder, "intervals")
    run, dirty = runs.start("backtest"), rows.where("is_anomaly").select("business_date").distinct()

    def stage1(past: DataFrame, ahead: Sequence[date]) -> tuple[DataFrame, DataFrame]:
        return bat.regression(grid, grid.per_day)(ing.densify(past).select(*con.CELL, "mips"), ahead)

    found = bat.backtest(rows, horizon, stage1, folds=folds, paths=paths, per_day=grid.per_day, dirty=dirty)
    _save(run, "folds", found)
    said = bat.verdict(found)
    run.finish(note=said)
    return said


def pack(spark: SparkSession, runs: Registry, out: str, run_id: str = "latest") -> list[Path]:
    """The pack of a simulation, with the growth of the same run."""
    run = runs.find("simulate", run_id)
    frames = [srv.read_published(spark, str(run.folder), n) for n in ("fy_summary", "app_peaks", "growth")]
    return pck.write(out, *frames, families=mod.FAMILIES)
