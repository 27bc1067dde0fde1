"""Settings and the command line."""

import pytest

from crestline.cli import main
from crestline.config import load_config


def test_config(tmp_path):
    base = load_config()
    changed = base.with_overrides({"simulation.paths": 7})
    assert (base.get("simulation.paths"), changed.get("simulation.paths"), base.get("no.such", 3)) == (10_000, 7, 3)
    assert base.section("model").get("backend") == "quantile_ridge"
    (tmp_path / "c.json").write_text('{"simulation.dependence": "none"}')
    with pytest.raises(ValueError):
        load_config(str(tmp_path / "c.json"))
    for bad in ({"calendar.interval_minutes": 7}, {"model.quantiles": [0.9, 0.5]}, {"simulation.chunk": 20_000}):
        with pytest.raises(ValueError):
            load_config(overrides=bad)


def test_cli(spark, tmp_path, capsys):
    assert main(["reducers"]) == 0 and "annual_max" in capsys.readouterr().out
    assert main(["check"]) == 0 and main(["run", "none", "x", "y"]) == 2
    assert main(["run", "fea_scales", "/root/testdata/sf0.001", str(tmp_path / "o")]) == 0
    assert spark.read.parquet(str(tmp_path / "o")).count() > 0
