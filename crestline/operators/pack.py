"""A planning pack in Markdown: an overview and a page an app, from small frames."""

from __future__ import annotations

import math
from collections.abc import Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame

#: Parts of the names of columns that identify and are written without separators.
IDENTIFIERS = ("year", "idx", "index", "id")
#: Rows of a table in the pack; a larger frame isn't for print.
MOST_ROWS = 10_000


def _is_identifier(column: str) -> bool:
    return any(map(column.lower().__contains__, IDENTIFIERS))


#: How values are printed: the first row whose test holds for (value, column) gives the format.
FORMATS = [
    (lambda v, c: v is None or v != v or v in (math.inf, -math.inf), lambda v: "-"),
    (lambda v, c: not isinstance(v, (int, float)), "{}".format),
    (lambda v, c: isinstance(v, bool), lambda v: ("no", "yes")[v]),
    (lambda v, c: v == int(v) and _is_identifier(c), "{:.0f}".format),
    (lambda v, c: v == int(v) or abs(v) >= 1000, "{:,.0f}".format),
    (lambda v, c: True, "{:,.3f}".format),
]


def text_of(value: Any, column: str = "") -> str:
    """A value for print, by FORMATS."""
    return next(form for holds, form in FORMATS if holds(value, column))(value)


def table(names: Sequence[str], rows: Sequence[Sequence[Any]]) -> str:
    if not rows:
        return "_none_"
    lines = [" | ".join(names), " | ".join(["---"] * len(names)), *[" | ".join(text_of(v, n) for n, v in zip(names, r)) for r in rows]]
    return "\n".join(f"| {x} |" for x in lines)


def _rows(df: DataFrame, *order: str) -> list:
    got = df.orderBy(*order).limit(MOST_ROWS + 1).collect()
    if len(got) > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} rows are not for print")
    return got


def write(folder: str | Path, fy_summary: DataFrame, app_peaks: DataFrame, growth: DataFrame, verdict: str = "", families: dict[str, list[str]] | None = None) -> list[Path]:
    """overview.md and apps/<app>.md; the frames are those of serving and of growth."""
    folder = Path(folder)
    (folder / "apps").mkdir(parents=True, exist_ok=True)
    of = {n: k for k, names in (families or {}).items() for n in names}
    years = [(r["fiscal_year"], r["reducer"], of.get(r["reducer"], ""), r["level"], r["value"], r["mean"]) for r in _rows(fy_summary, "fiscal_year", "reducer", "level")]
    peaks, rates = _rows(app_peaks, "app_id", "level"), {r["app_id"]: r["growth"] for r in _rows(growth, "app_id")}
    overview = folder / "overview.md"
    said = f"{verdict}\n\n" if verdict else ""
    apps = sorted({r["app_id"] for r in peaks})
    listed = table(["app_id", "growth_pct", "p50"], [(a, 100.0 * rates[a] if rates.get(a) is not None else None, next((r["value"] for r in peaks if r["app_id"] == a and r["level"] == 0.5), None)) for a in apps])
    overview.write_text(
        f"# Peak-load forecast\n\n{said}## By fiscal year\n\n{table(['fiscal_year', 'reducer', 'for', 'level', 'value', 'mean'], years)}\n\n"
        f"## Apps\n\nPeaks of apps do not add up: they fall at different times.\n\n{listed}\n"
    )
    out = [overview]
    for a in apps:
        page = folder / "apps" / f"{''.join(c if c.isalnum() or c in '-_' else '_' for c in a)}.md"
        own = [(r["level"], r["value"], r["mean"]) for r in peaks if r["app_id"] == a]
        page.write_text(f"# {a}\n\nGrowth a year: {text_of(100.0 * rates[a] if rates.get(a) is not None else None)} %\n\n{table(['level', 'peak', 'mean'], own)}\n")
        out.append(page)
    return out
