"""Properties of what SQL cannot express: the regression, the forecast, the copula, sources."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from crestline.functions import calendar as cal
from crestline.operators import dependence as dep
from crestline.operators import evaluation as eva
from crestline.operators import model as mod
from crestline.operators import quantile as qua
from crestline.sources import lake

TAUS = [0.1, 0.5, 0.9]


@pytest.fixture(scope="module")
def panel(spark):
    """Two apps of 300 days and three intervals: a level, a weekday effect, noise."""
    rng, days = np.random.default_rng(5), [r[0] for r in cal.days(spark, date(2024, 1, 1), date(2025, 2, 21)).select("business_date").orderBy("business_date").collect()]
    rows = [(a, d, i, float(level * (1 + 0.05 * d.weekday() + 0.2 * i) * (1 + 0.1 * rng.standard_normal()))) for a, level in (("A", 100.0), ("B", 900.0)) for d in days for i in range(3)]
    return spark.createDataFrame(rows, "app_id string, business_date date, interval_idx int, mips double").persist()


@pytest.fixture(scope="module")
def trained(spark, panel):
    spec = qua.Spec(date(2024, 1, 1), 1.2, 0.5, 3)
    return (spec, *qua.trained(panel, cal.days(spark, date(2024, 1, 1), date(2025, 2, 21)), spec, TAUS))


def test_regression_covers(trained):
    _, model, rows, scales = trained
    assert len(model.mean) == 32
    got = qua.fitted(rows, model, scales).where("q is not null")
    shares = got.agg(*[F.avg((F.col("mips") <= F.col("q")[i]).cast("double")) for i in range(3)]).first()
    assert all(abs(s - t) < 0.04 for s, t in zip(shares, TAUS))
    assert qua.fitted(rows, model, scales).where("q is null").count() > 0


def test_expression_equals_numpy(trained):
    _, model, rows, _ = trained
    some = rows.where("valid").select("x", model.predict(F.col("x")).alias("q")).limit(50).collect()
    assert np.allclose(model.predict_rows(np.array([r["x"] for r in some])), [r["q"] for r in some])


def test_forecast(spark, panel, trained):
    spec, model, _, scales = trained
    future = cal.days(spark, date(2025, 2, 24), date(2025, 6, 30))
    cube = qua.forecast(panel, future, scales, mod.growth(panel), mod.feed_correction(panel), model, spec)
    got = cube.collect()
    assert len(got) == 2 * 3 * future.count()
    assert all(r["q"] == sorted(r["q"]) and r["q"][0] >= 0 for r in got)
    level = {a: np.mean([r["q"][1] for r in got if r["app_id"] == a]) for a in "AB"}
    assert 80 < level["A"] < 200 and 720 < level["B"] < 1800


def test_weights_and_backends():
    assert [qua.recursion_weight(s) for s in (0, 19, 29, 39)] == [1.0, 1.0, 0.5, 0.0]
    with pytest.raises(KeyError):
        qua.build_backend("none", TAUS)


def test_spread_floor(spark):
    got = spark.range(1).select(qua.spread(F.array(*[F.lit(2000.0)] * 3), TAUS, 0.1, 0.9).alias("s"), qua.monotone(F.array(F.lit(3.0), F.lit(-1.0))).alias("m")).first()
    assert got["s"] == 40 and got["m"] == [0.0, 3.0]


def test_copula(spark):
    rng = np.random.default_rng(1)
    z = rng.multivariate_normal([0, 0], [[1, 0.8], [0.8, 1]], 800)
    rows = [(k, a, 0, float(z[k, j])) for k in range(800) for j, a in enumerate("AB")]
    pooled = spark.createDataFrame(rows, "pool_idx int, app_id string, interval_idx int, r double")
    copula = dep.fit_copula(pooled, shrinkage=0.0)
    x = copula.draw(20_000, np.random.default_rng(2))
    assert abs(np.corrcoef(x.T)[0, 1] - 0.8) < 0.05
    assert np.allclose(np.quantile(x, TAUS, axis=0), np.quantile(z, TAUS, axis=0), atol=0.1)
    forecast = spark.createDataFrame([("A", 0, 10.0, 1.0), ("B", 0, 20.0, 1.0)], "app_id string, interval_idx int, med double, half double")
    runs = [dep.simulate_copula(spark, copula, forecast, 20, 5, parts=n).orderBy("path_id", "day_idx").collect() for n in (2, 7)]
    assert runs[0] == runs[1] and len(runs[0]) == 100


def test_gaussian_tail():
    assert abs(dep.gaussian_tail(0.0) - 0.1) < 1e-3 and dep.gaussian_tail(1.0) == 1.0 and dep.gaussian_tail(0.8) > 0.4


def test_pit_edges(spark):
    q = F.array(F.lit(10.0), F.lit(20.0), F.lit(30.0))
    got = spark.createDataFrame([(v,) for v in (5.0, 10.0, 15.0, 30.0, 31.0, None)], "y double").select(eva.pit(F.col("y"), q, TAUS).alias("p")).collect()
    assert [r["p"] for r in got] == [0.0, 0.1, pytest.approx(0.3), 0.9, 1.0, None]


def test_origins():
    assert eva.origins(500, 3, 60, 60, 250) == [319, 379, 439]
    assert eva.origins(100, 3, 60, 60, 250) == []
    assert eva.ks_pvalue(0.01, 100) == 1.0 and eva.ks_pvalue(0.3, 100) < 1e-6


def test_file_source(spark, tmp_path):
    (tmp_path / "intervals_1.csv").write_text("TS,APP,lpar,mips\n2025-06-02 09:00:00, PAY ,P1,5.5\n2025-07-02 09:00:00,PAY,P1,6\n")
    (tmp_path / "lpar_totals.tsv").write_text("business_date\tlpar\tpeak_mips\n2025-06-02\tP1\t9\n")
    source = lake.get_source("files", spark=spark, folder=str(tmp_path), renamed={"APP": "app_id"})
    got = lake.extract(source, date(2025, 6, 1), date(2025, 6, 30))
    assert set(got) == {"intervals", "lpar_totals"}
    row = got["intervals"].collect()
    assert len(row) == 1 and (row[0]["app_id"], row[0]["environment"], row[0]["fiscal_year"], row[0]["is_anomaly"]) == ("PAY", "PROD", 2025, False)
    assert got["lpar_totals"].first()["peak_interval_idx"] == -1
    assert lake.probe(got["intervals"]).first()["n_rows"] == 1
    assert lake.write_lake(got, str(tmp_path / "lake")) == ["intervals", "lpar_totals"]
    assert lake.register_views(spark, str(tmp_path / "lake")) == ["intervals", "lpar_totals"]
    with pytest.raises(FileNotFoundError):
        lake.read_table(spark, str(tmp_path / "lake"), "events")
    with pytest.raises(ValueError):
        lake.normalised(got["lpar_totals"].drop("lpar"), "lpar_totals")


def test_windows_and_roles():
    assert lake.date_windows("intervals", date(2025, 1, 1), date(2025, 2, 9)) == [(date(2025, 1, 1), date(2025, 1, 31)), (date(2025, 1, 31), date(2025, 2, 10))]
    known = [lake.TableSpec("LOAD", "spine", "hour"), lake.TableSpec("OTHER", "spine", "day"), lake.TableSpec("TXN", "driver", "hour")]
    assert lake.validate_roles(known, {"intervals": "S.LOADV"}) == []
    assert "within the day" in lake.validate_roles(known, {"intervals": "OTHER"})[0]
    for bad in ({"intervals": "TXN"}, {"intervals": "LOAD", "more": "OTHER"}):
        with pytest.raises(ValueError):
            lake.validate_roles(known, bad)
    with pytest.raises(KeyError):
        lake.get_source("none")
