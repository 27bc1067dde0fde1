"""The stages end to end on the synthetic source."""

from datetime import date

import pytest

from crestline import stages
from crestline.cli import main
from crestline.registry import Registry
from crestline.sources.synthetic import Spec, SyntheticSource


def test_stages(spark, tmp_path, capsys):
    source = SyntheticSource(spark, Spec(start=date(2024, 1, 1), end=date(2024, 12, 31), apps=3))
    folder, runs = str(tmp_path / "lake"), Registry(tmp_path / "runs")
    assert stages.ingest(spark, source, date(2024, 1, 1), date(2024, 12, 31), folder) == ["intervals", "lpar_totals", "events", "submissions"]
    assert main(["tables", folder]) == 0 and "intervals: " in capsys.readouterr().out
    assert stages.diagnostics(spark, folder, runs) in ("PROCEED", "STOP AND RECONSIDER")
    shares = stages.train(spark, folder, runs)
    assert all(abs(v - t) < 0.08 for t, v in shares.items())
    found = runs.find("train").manifest["calibration"]
    assert found["held_days"] == 60 and found["error_after"] < 0.05
    run = stages.simulate(spark, folder, runs, years=1, paths=20, reducers=["annual_max", "annual_peak_r4ha"])
    assert runs.verify("simulate") == [] and run.manifest["record"]["pool_days"] >= 30 and run.manifest["record"]["calibrated"]
    assert "level: " in stages.backtest(spark, folder, runs, horizon=40, folds=1, paths=20)
    assert main(["pack", str(tmp_path / "pack"), "--runs", str(tmp_path / "runs")]) == 0
    assert "annual_peak_r4ha" in (tmp_path / "pack" / "overview.md").read_text()
    assert main(["runs", "simulate", "--runs", str(tmp_path / "runs"), "--verify"]) == 0 and "clean" in capsys.readouterr().out
    assert main(["probe", "files", "2024-01-01", "2024-01-02", "--folder", str(tmp_path / "none")]) == 2
    with pytest.raises(FileNotFoundError):
        stages.train(spark, str(tmp_path / "none"), runs)
