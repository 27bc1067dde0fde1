"""Horizon simulation, backtest, synthetic source, registry and pack by hand-made cases."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from crestline import registry
from crestline.functions.calendar import Grid
from crestline.operators import backtest as bat
from crestline.operators import horizon as hor
from crestline.operators import model as mod
from crestline.operators import pack
from crestline.sources import lake, synthetic


def brute(values, width):
    """Per day: the greatest whole window that ends in it."""
    flat, out, at = [v for d in values for v in d], [], 0
    for d in values:
        found = [sum(flat[e - width + 1 : e + 1]) / width for e in range(at, at + len(d)) if e >= width - 1]
        out.append(max(found, default=0.0))
        at += len(d)
    return out


@pytest.mark.parametrize(("values", "width"), [
    ([[10.0, 20, 60, 80, 30, 20, 10, 10, 10]] * 3, 4), ([[100.0, 100, 1, 1, 1, 1, 1, 100, 100]] * 3, 4), ([[1000.0] + [0.0] * 8] * 2, 4), ([[5.0], [7.0], [1.0], [9.0]], 3), ([[1.0, 2.0]], 1),
])
def test_rolling_runs_across_days(spark, values, width):
    days = spark.createDataFrame([(1, i, v) for i, v in enumerate([[float(x) for x in d] for d in values])], "path_id int, day_idx int, total array<double>")
    got = hor.rolling(days, ["path_id"], "total", width, len(values[0])).orderBy("day_idx").collect()
    assert [r["r4ha"] for r in got] == pytest.approx(brute(values, width))


def test_sum_before_maximum(spark):
    flat = lambda at: [100.0 if i == at else 10.0 for i in range(36)]
    drawn = spark.createDataFrame([(0, 0, 0)], "path_id long, day_idx int, pool_idx int")
    pooled = spark.createDataFrame([(0, a, i, 0.0) for a in "AB" for i in range(36)], "pool_idx int, app_id string, interval_idx int, r double")
    forecast = spark.createDataFrame([(0, a, i, v, 1.0) for a, at in (("A", 5), ("B", 25)) for i, v in enumerate(flat(at))], "day_idx int, app_id string, interval_idx int, med double, half double")
    cells = hor.cells(drawn, pooled, forecast)
    row = hor.daily(drawn, hor.totals(cells, 36)).first()
    assert (row["peak"], row["sum_app_peaks"]) == (110.0, 200.0)
    out = hor.coincidence(hor.daily(drawn, hor.totals(cells, 36)), hor.app_peaks(drawn, cells)).first()
    assert out["daily_mean"] == pytest.approx(0.55) and out["horizon_mean"] == pytest.approx(0.55)


def test_factor_is_for_daily_grain(spark):
    daily = spark.createDataFrame([(p, d, d % 5, 100.0, 100.0, [100.0]) for p in range(50) for d in range(10)], "path_id long, day_idx int, dow int, peak double, mean double, total array<double>")
    factors = spark.createDataFrame([(date(2024, 1, 1 + i), i % 7, 0.5 if i % 7 == 0 else 0.9) for i in range(28)], "business_date date, dow int, factor double")
    got = hor.with_factor(daily, factors, 1)
    assert {r[0] for r in got.select("peak").distinct().collect()} == {50.0, 90.0} and got.where("total[0] <> peak").count() == 0
    with pytest.raises(ValueError):
        hor.with_factor(daily, factors, 9)
    with pytest.raises(ValueError):
        hor.with_factor(daily, factors.limit(0), 1)


def test_reducers_that_need_rolling(spark):
    daily = spark.createDataFrame([(1, date(2026, 1, 5), 2.0, 1.0)], "path_id int, business_date date, daily_peak double, daily_mean double")
    with pytest.raises(ValueError):
        mod.reduced(daily, ["path_id"], ["annual_peak_r4ha"])
    assert mod.needs_r4ha(["annual_peak_r4ha"]) and not mod.needs_r4ha(["annual_max"])
    assert sorted(n for names in mod.FAMILIES.values() for n in names) == sorted(mod.REDUCERS)


def test_origins():
    days = [date(2024, 1, 1 + i) for i in range(20)]
    assert bat.origins(days, 6) == [days[p] for p in (1, 4, 7, 10, 13)] and bat.origins(days, 20) == []


@pytest.fixture(scope="module")
def made(spark):
    return {k: v.persist() for k, v in synthetic.generate(spark, synthetic.Spec(start=date(2024, 1, 1), end=date(2024, 12, 31), apps=5)).items()}


def test_synthetic_panel(spark, made):
    rows = made["intervals"]
    n_days = rows.select("business_date").distinct().count()
    assert rows.count() == 5 * n_days * Grid().per_day and rows.where("mips < 0.5 or mips is null").count() == 0
    again = synthetic.generate(spark, synthetic.Spec(start=date(2024, 1, 1), end=date(2024, 12, 31), apps=5))["intervals"]
    total = lambda df: df.agg(F.round(F.sum("mips"), 4)).first()[0]
    assert total(rows) == total(again)
    assert {r[0] for r in rows.where("is_anomaly").select("event_label").distinct().collect()} <= {"DR", "IST", "GCC_SDF"}
    peaks = made["lpar_totals"].agg(F.count("*")).first()[0]
    assert peaks == 2 * n_days and made["submissions"].count() > 0
    source = lake.get_source("synthetic", spark=spark, spec=synthetic.Spec(start=date(2024, 1, 1), end=date(2024, 3, 31), apps=2))
    tables = lake.extract(source, date(2024, 2, 1), date(2024, 2, 29))
    assert set(tables) == {"intervals", "events", "lpar_totals", "submissions"}
    assert tables["intervals"].agg(F.min("business_date"), F.max("business_date")).first() == (date(2024, 2, 1), date(2024, 2, 29))


def test_backtest_reproduces_coincidence(spark, made):
    folds = bat.backtest(made["truth"], 60, folds=1, paths=100, per_day=Grid().per_day).collect()
    assert len(folds) == 1 and 0 <= folds[0]["pit"] <= 1
    assert abs(folds[0]["simulated_coincidence"] - folds[0]["historical_coincidence"]) < 0.1
    table = spark.createDataFrame(folds, bat.FOLD)
    assert "coincidence" in bat.verdict(table) and bat.verdict(table.limit(0)) == "NO FOLDS"
    dirty = made["truth"].select("business_date").distinct().orderBy(F.desc("business_date")).limit(2)
    clean, whole, n = bat.realised(made["truth"], [r[0] for r in dirty.collect()][::-1], "annual_max", dirty.limit(1))
    assert n == 1 and clean <= whole


def test_registry(tmp_path):
    runs = registry.Registry(tmp_path)
    run = runs.start("train", "a")
    run.note("metrics", {"loss": 1})
    run.write_json("x.json", {"a": 1})
    run.finish()
    assert runs.runs("train") == ["a"] and runs.find("train").manifest["metrics"] == {"loss": 1} and runs.verify("train") == []
    (run.folder / "x.json").write_text("other")
    assert runs.verify("train") == ["changed: x.json"]
    (run.folder / "x.json").unlink()
    assert runs.verify("train") == ["missing: x.json"]
    with pytest.raises(FileNotFoundError):
        runs.find("simulate")


def test_pack(spark, tmp_path):
    assert [pack.text_of(v, c) for v, c in ((2027, "fiscal_year"), (1234567, "n"), (9.0, "idx"), (float("nan"), "x"), (1.5, "x"), (12345.6, "x"), (True, "x"))] == ["2027", "1,234,567", "9", "-", "1.500", "12,346", "yes"]
    fy = spark.createDataFrame([(2027, "annual_max", 0.5, 6100.0, 6000.0)], "fiscal_year int, reducer string, level double, value double, mean double")
    peaks = spark.createDataFrame([("A/1", 0.5, 10.0, 9.0)], "app_id string, level double, value double, mean double")
    growth = spark.createDataFrame([("A/1", 0.03)], "app_id string, growth double")
    out = pack.write(tmp_path, fy, peaks, growth, "LEVEL OK", mod.FAMILIES)
    assert [p.name for p in out] == ["overview.md", "A_1.md"] and "| 2027 | annual_max | hardware |" in out[0].read_text()
