"""Calibration against numpy, and what it refuses; labels, growth and counts."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from crestline.operators import calibration as con
from crestline.operators import ingest as ing
from crestline.operators import model as mod

TAUS = [0.05, 0.5, 0.95]


def picked(scores, level):
    n = len(scores)
    return float(np.quantile(scores, min(1.0, np.ceil(round((n + 1) * level, 9)) / n), method="higher"))


@pytest.fixture(scope="module")
def scores():
    """Sizes from one to many, one app of few values, so that ties fill whole bins."""
    rng = np.random.default_rng(3)
    return {a: np.round(rng.normal(size=n), d) for a, n, d in (("one", 1, 3), ("two", 2, 3), ("ten", 10, 3), ("many", 3000, 6), ("ties", 900, 0))}


def test_order_statistic(spark, scores):
    for level in (0.05, 0.5, 0.95, 0.99):
        rows = [(a, 1, float(v), level) for a, s in scores.items() for v in s] + [("none", 1, None, level), ("ten", 1, float("nan"), level)]
        df = spark.createDataFrame(rows, "app_id string, k int, s double, level double")
        got = {r["app_id"]: (r["n"], r["adj"]) for r in con.order_statistic(df, ["app_id"]).collect()}
        assert got == {a: (len(s), picked(s, level)) for a, s in scores.items()}
        everything = np.concatenate(list(scores.values()))
        assert [r["adj"] for r in con.order_statistic(df, ["k"]).collect()] == [picked(everything, level)]


def test_symmetric(spark, scores):
    rows = [(a, float(v), [-1.0, 0.0, 1.0]) for a, s in scores.items() for v in s]
    got = {(r["app_id"], r["tau"]): r for r in con.symmetric(spark.createDataFrame(rows, "app_id string, y double, q array<double>"), TAUS).collect()}
    out = {a: np.maximum(-1.0 - s, s - 1.0) for a, s in scores.items()}
    pooled = picked(np.concatenate(list(out.values())), 0.9)
    assert len(got) == 3 * len(scores)
    for a, s in out.items():
        width = picked(s, 0.9) if len(s) >= 200 else pooled
        assert [got[a, t]["adj"] for t in TAUS] == [-width, 0.0, width]
        assert got[a, 0.5]["used_pooled"] == (len(s) < 200) and got[a, 0.5]["n_scores"] == len(s)


def test_shifted(spark):
    day = date(2025, 1, 6)
    cube = spark.createDataFrame([("A", day, 0, [1.0, 2.0, 3.0]), ("B", day, 0, [1.0, 2.0, 3.0])], "app_id string, business_date date, interval_idx int, q array<double>")
    rows = [("A", 0.05, -5.0, False, 300), ("A", 0.5, 2.0, False, 300), ("A", 0.95, 0.5, False, 300)]
    shifts = spark.createDataFrame(rows, con.SHIFTS)
    assert con.shifted(cube.where("app_id = 'A'"), shifts, TAUS).first()["q"] == [0.0, 3.5, 4.0]
    for df, taus in ((cube, TAUS), (cube.where("app_id = 'A'"), [0.05, 0.5, 0.9])):
        with pytest.raises(PySparkException, match="no shifts"):
            con.shifted(df, shifts, taus).collect()


@pytest.fixture(scope="module")
def panel(spark):
    rng, first = np.random.default_rng(8), date(2024, 1, 1)
    rows = [(a, "P", first + timedelta(days=d), i, float(level * (1 + 0.2 * rng.standard_normal())), d % 17 == 0) for a, level in (("A", 100.0), ("B", 900.0)) for d in range(300) for i in range(3)]
    return spark.createDataFrame(rows, "app_id string, lpar string, business_date date, interval_idx int, mips double, is_anomaly boolean")


@pytest.mark.parametrize("method", ["one_sided", "symmetric"])
def test_calibrate(panel, method):
    held = [date(2024, 1, 1) + timedelta(days=d) for d in range(200, 300)]

    def narrow(train, ahead):
        """Too narrow and too low a forecast of all days."""
        assert ahead == held
        assert train.where("is_anomaly").isEmpty() and train.agg(F.max("business_date")).first()[0] < held[0]
        q = train.groupBy("app_id").agg((F.avg("mips") * 0.9).alias("m"))
        days = train.sparkSession.createDataFrame([(d, i) for d in ahead for i in range(3)], "business_date date, interval_idx int")
        return days.join(q, how="cross").select(*con.CELL, F.array(F.col("m") * 0.95, F.col("m"), F.col("m") * 1.05).alias("q"))

    got = con.calibrate(panel, 100, narrow, TAUS, method=method)
    want = panel.where(F.col("business_date").isin(held) & ~F.col("is_anomaly"))
    assert got.scored.count() == want.count()
    found, s = got.coverage().collect(), got.summary().first()
    assert {r["n"] for r in found} == {want.count()} and s["apps_pooled"] == 0 and s["max_abs_shift"] >= s["mean_abs_shift"] > 0
    assert s["error_after"] < s["error_before"]
    if method == "one_sided":
        assert all(0 <= r["after"] - r["tau"] < 0.02 for r in found)
    got.release()
    with pytest.raises(ValueError):
        con.calibrate(panel, 100, narrow, TAUS, method="other")


@pytest.mark.parametrize("days", [-1, 0, 300, 400])
def test_split_refuses(panel, days):
    with pytest.raises(ValueError):
        con.split_holdout(panel, days)


def test_given_anomalies_stay(spark):
    at = datetime(2025, 1, 6, 9)
    rows = spark.createDataFrame(
        [(at, "A", "P", True, "OWN"), (at, "B", "P", True, None), (at, "C", "P", False, None), (at, "D", "Q", None, "NOTE"), (at, "E", "Q", False, None)],
        "ts timestamp_ntz, app_id string, lpar string, is_anomaly boolean, event_label string",
    )
    windows = spark.createDataFrame([(0, "DR", "P", "*", at, at + timedelta(hours=1))], "event_seq int, event_type string, lpar string, app_id string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    got = {r["app_id"]: (r["is_anomaly"], r["event_label"]) for r in ing.label(rows, windows).collect()}
    assert got == {"A": (True, "OWN"), "B": (True, None), "C": (True, "DR"), "D": (False, "NOTE"), "E": (False, None)}


def test_growth_override(spark):
    f = spark.createDataFrame([("A", date(2026, 1, 1), 100.0), ("B", date(2026, 1, 1), 100.0)], "app_id string, business_date date, value double")
    g = spark.createDataFrame([("A", 0.1)], "app_id string, growth double")
    years = 365 / 365.25
    got = {r["app_id"]: r["value"] for r in mod.scenario(f, {"B": 2.0}, {}, ["A", "B"], {"A": 0.3, "B": 0.1}, g, date(2025, 1, 1)).collect()}
    assert got["A"] == pytest.approx(100 * np.exp(0.2 * years)) and got["B"] == pytest.approx(200 * np.exp(0.1 * years))
    with pytest.raises(KeyError):
        mod.scenario(f, {}, {}, ["A", "B"], {"X": 0.1}, g, date(2025, 1, 1))
    with pytest.raises(ValueError):
        mod.scenario(f, {}, {}, ["A", "B"], {"A": 0.1}, g)
