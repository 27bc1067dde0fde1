"""Settings: a table of names with their defaults and rules. A configuration is the defaults with some values replaced."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from pathlib import Path
from types import MappingProxyType
from typing import Any

DEPENDENCE = ("bootstrap", "copula")
_LEVELS = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)

#: Every setting by its full name.
DEFAULTS: Mapping[str, Any] = MappingProxyType({
    "calendar.interval_minutes": 60, "calendar.fiscal_start_month": 11,
    "model.quantiles": _LEVELS, "model.backend": "quantile_ridge",
    "simulation.paths": 10_000, "simulation.chunk": 500, "simulation.dependence": "bootstrap", "simulation.block_days": 1, "simulation.seed": 20260101,
})


def _levels_ascend(q: Any) -> bool:
    return bool(q) and all(a < b for a, b in zip((0, *q), (*q, 1))) and 0.5 in q


#: What must hold: the settings a rule reads, the rule, and what to say if it doesn't hold.
RULES: list[tuple[tuple[str, ...], Callable[..., bool], str]] = [
    (("calendar.interval_minutes",), lambda m: m > 0 and 1440 % m == 0, "a day must be a whole number of intervals"),
    (("model.quantiles",), _levels_ascend, "levels must ascend between 0 and 1 and include the median"),
    (("simulation.chunk", "simulation.paths"), lambda chunk, paths: 0 < chunk <= paths, "a chunk is at most all paths"),
    (("simulation.dependence",), DEPENDENCE.__contains__, f"choose from {', '.join(DEPENDENCE)}"),
]


@dataclass(frozen=True)
class Config:
    """Values by full name, below a prefix."""

    values: Mapping[str, Any] = DEFAULTS
    prefix: str = ""

    def get(self, name: str, default: Any = None) -> Any:
        return self.values.get(self.prefix + name, default)

    def section(self, name: str) -> Config:
        inner = replace(self, prefix=f"{self.prefix}{name}.")
        if not any(k.startswith(inner.prefix) for k in self.values):
            raise KeyError(inner.prefix)
        return inner

    def with_overrides(self, changes: Mapping[str, Any]) -> Config:
        return replace(self, values=MappingProxyType({**self.values, **{self.prefix + k: v for k, v in changes.items()}}))

    def problems(self) -> list[str]:
        return [f"{' and '.join(names)}: {said}" for names, holds, said in RULES if not holds(*map(self.values.get, names))]


def load_config(path: str | None = None, overrides: Mapping[str, Any] | None = None) -> Config:
    """The defaults with a JSON file's values and then `overrides` in their place, both by full name."""
    given = json.loads(Path(path).read_bytes()) if path else {}
    config = Config().with_overrides({**given, **(overrides or {})})
    if found := config.problems():
        raise ValueError("\n".join(found))
    return config
