"""Sources by name, the table catalogue, conforming of frames, and the lake of Parquet tables."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, timedelta
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from crestline.functions.calendar import Grid, fiscal_year

#: Tables of the lake, the columns each needs, and what columns that are absent are filled with.
REQUIRED = {
    "intervals": ["ts", "app_id", "lpar"],
    "lpar_totals": ["business_date", "lpar", "peak_mips"],
    "events": ["event_type", "start_ts", "end_ts"],
    "submissions": ["app_id", "fiscal_year", "submitted_peak_mips"],
}
DEFAULTS = {
    "intervals": {"environment": ("string", "PROD"), "is_anomaly": ("boolean", False), "event_label": ("string", None)},
    "lpar_totals": {"peak_interval_idx": ("int", -1), "mean_mips": ("double", None)},
    "events": {"event_id": ("string", None), "lpar": ("string", "*"), "app_id": ("string", "*"), "note": ("string", None)},
    "submissions": {"submitted_on": ("date", None), "basis": ("string", None)},
}
_TIMES, _DAYS, _TRIMMED = ("ts", "start_ts", "end_ts"), ("business_date", "submitted_on"), ("app_id", "lpar", "environment", "event_type")
#: Tables read whole; the others are read by date windows.
REFERENCE = ("events", "submissions")


class Source(Protocol):
    def fetch(self, table: str, start: date, end: date) -> DataFrame | None:
        """The rows of a table within the dates, inclusive; None where the source has no such table."""


_SOURCES: dict[str, type] = {}


def register_source(name: str):
    def add(kind: type) -> type:
        _SOURCES[name] = kind
        return kind

    return add


def available_sources() -> list[str]:
    return sorted(_SOURCES)


def get_source(name: str, **options) -> Source:
    if name not in _SOURCES:
        raise KeyError(f"unknown source {name!r}; there are {available_sources()}")
    return _SOURCES[name](**options)


def require_columns(df: DataFrame, table: str) -> None:
    if missing := sorted(set(REQUIRED.get(table, [])) - set(df.columns)):
        raise ValueError(f"{table}: missing columns {missing}")


def normalised(df: DataFrame, table: str, renamed: dict[str, str] | None = None) -> DataFrame:
    """Lower-case names, renamed by the map, dates and times typed, identifiers trimmed; required columns must be there."""
    df = df.toDF(*[c.lower() for c in df.columns]).withColumnsRenamed({k.lower(): v for k, v in (renamed or {}).items()})
    require_columns(df, table)
    typed = {c: F.col(c).cast("timestamp_ntz") for c in _TIMES if c in df.columns}
    typed |= {c: F.to_date(c) for c in _DAYS if c in df.columns} | {c: F.trim(F.col(c).cast("string")) for c in _TRIMMED if c in df.columns}
    return df.withColumns(typed) if typed else df


def clipped(df: DataFrame, table: str, start: date, end: date) -> DataFrame:
    """Rows dated within start and end, inclusive; reference tables are left whole."""
    if table in REFERENCE:
        return df
    if "ts" in df.columns:
        # A range on the column itself reaches the scan, a function of it does not.
        return df.where((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end + timedelta(days=1)).cast("timestamp_ntz")))
    return df.where(F.col("business_date").between(F.lit(start), F.lit(end))) if "business_date" in df.columns else df


def conform(df: DataFrame, table: str, grid: Grid = Grid()) -> DataFrame:
    """`df` with business_date and fiscal_year derived and optional columns filled, where they are absent."""
    if "ts" in df.columns and "business_date" not in df.columns:
        df = df.withColumn("business_date", F.to_date("ts"))
    if "business_date" in df.columns and "fiscal_year" not in df.columns:
        df = df.withColumn("fiscal_year", fiscal_year(F.col("business_date"), grid))
    new = {c: F.lit(v).cast(kind) for c, (kind, v) in DEFAULTS.get(table, {}).items() if c not in df.columns}
    return df.withColumns(new) if new else df


def date_windows(table: str, start: date, end: date, days: int = 30) -> list[tuple[date, date]]:
    """Half-open windows that cover start to end, inclusive; one for reference tables."""
    span = (end - start).days + 1
    step = span if table in REFERENCE else days
    edges = [start + timedelta(days=d) for d in (*range(0, span, max(1, step)), span)]
    return list(zip(edges, edges[1:]))


@register_source("jdbc")
@dataclass
class JdbcSource:
    """Tables of a database: one partition, and so one connection, a window of dates.

    `queries` has a relation per table, and `dated` the column its windows go by. Dates are typed
    values, never text from outside. Credentials come in `properties`, and from there go to the driver only.
    """

    spark: SparkSession
    url: str
    queries: dict[str, str]
    dated: dict[str, str]
    properties: dict[str, str] = field(default_factory=dict, repr=False)
    renamed: dict[str, str] = field(default_factory=dict)
    days: int = 30

    def predicates(self, table: str, start: date, end: date) -> list[str]:
        c = self.dated[table]
        if not re.fullmatch(r"\w+", c):
            raise ValueError(f"not a column name: {c!r}")
        return [f"{c} >= DATE '{a.isoformat()}' AND {c} < DATE '{b.isoformat()}'" for a, b in date_windows(table, start, end, self.days)]

    def fetch(self, table: str, start: date, end: date) -> DataFrame | None:
        if table not in self.queries:
            return None
        options = {"fetchsize": "50000", "isolationLevel": "READ_UNCOMMITTED"} | self.properties
        got = self.spark.read.jdbc(self.url, f"({self.queries[table]}) q", predicates=self.predicates(table, start, end), properties=options)
        return normalised(got, table, self.renamed)


@register_source("files")
@dataclass
class FileSource:
    """Files `{table}*` in a folder: Parquet, CSV (also gzipped) and TSV; read by Spark, so the folder may be in any store."""

    spark: SparkSession
    folder: str
    renamed: dict[str, str] = field(default_factory=dict)

    def fetch(self, table: str, start: date, end: date) -> DataFrame | None:
        parts = []
        for glob, kind, options in ((f"{table}*.parquet", "parquet", {}), (f"{table}*.csv", "csv", {}), (f"{table}*.csv.gz", "csv", {}), (f"{table}*.tsv", "csv", {"sep": "\t"})):
            if kind == "csv":
                options = {"header": True, "inferSchema": True} | options
            try:
                parts.append(normalised(self.spark.read.format(kind).options(**options).load(f"{self.folder}/{glob}"), table, self.renamed))
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return clipped(out, table, start, end)


def probe(rows: DataFrame, most: int = 500) -> DataFrame:
    """One row over a sample: the most frequent step of ts within an app in minutes, counts, range, nulls. The limit is the feature."""
    df = rows.limit(most)
    step = (F.unix_timestamp("ts") - F.unix_timestamp(F.lag("ts").over(Window.partitionBy("app_id").orderBy("ts")))) / 60
    df = df.withColumn("step", step)
    return df.agg(
        F.count("*").alias("n_rows"), F.mode(F.when(F.col("step") > 0, F.col("step"))).alias("interval_minutes"), F.count_distinct("app_id").alias("n_apps"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count_if(F.col("app_id").isNull()).alias("n_null_apps"),
    )


def extract(source: Source, start: date, end: date, grid: Grid = Grid(), tables: Iterable[str] = tuple(REQUIRED)) -> dict[str, DataFrame]:
    """The conformed tables that the source has; intervals must be among them."""
    got = {t: conform(df, t, grid) for t in tables if (df := source.fetch(t, start, end)) is not None}
    if "intervals" not in got:
        raise RuntimeError("the source has no intervals")
    return got


def write_lake(tables: dict[str, DataFrame], folder: str) -> list[str]:
    """Writes known tables over those in the folder; others are left out."""
    known = [t for t in REQUIRED if tables.get(t) is not None]
    for t in known:
        tables[t].write.mode("overwrite").parquet(f"{folder}/{t}.parquet")
    return known


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    try:
        return spark.read.parquet(f"{folder}/{table}.parquet")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        raise FileNotFoundError(f"{folder}/{table}.parquet") from None


def register_views(spark: SparkSession, folder: str) -> list[str]:
    """Temporary views of the tables there are."""
    found = []
    for t in REQUIRED:
        try:
            read_table(spark, folder, t).createOrReplaceTempView(t)
        except FileNotFoundError:
            continue
        found.append(t)
    return found


@dataclass(frozen=True)
class TableSpec:
    """What a source table may contribute: role is spine, driver, attribution or validation."""

    name: str
    role: str
    grain: str


def _matches(catalogue: Iterable[TableSpec], used: dict[str, str]) -> list[tuple[str, str, TableSpec | None]]:
    """(lake table, source table, its entry): names are compared without case, schema and a view's final V; the longest shared start wins."""
    plain = lambda name: re.sub(r"^.*\.", "", name.strip()).upper()
    out = []
    for table, source in used.items():
        name = plain(source)
        # Exact names rank above those of which one is the start of the other.
        ranked = [(k == name, len(k), s) for s in catalogue for k in [plain(s.name)] if name.startswith(k) or k.startswith(re.sub(r"(?<=.)V$", "", name))]
        out.append((table, source, max(ranked, key=lambda r: r[:2])[2] if ranked else None))
    return out


def find_spec(catalogue: Iterable[TableSpec], name: str) -> TableSpec | None:
    """A table's entry by its name."""
    return _matches(list(catalogue), {"": name})[0][2]


#: What is wrong with a set of matches: whether it is an error, what to say, and the matches it says it of.
ROLE_CHECKS = [
    (True, "not a spine, so as intervals it would count the same load twice", lambda ms: [m for m in ms if m[0] == "intervals" and m[2] and m[2].role != "spine"]),
    (True, "one of several spines, which would count the same load twice", lambda ms: [m for m in ms if m[2] and m[2].role == "spine"] if len({m[2].name for m in ms if m[2] and m[2].role == "spine"}) > 1 else []),
    (False, "not in the catalogue", lambda ms: [m for m in ms if m[2] is None]),
    (False, "without times within the day", lambda ms: [m for m in ms if m[0] == "intervals" and m[2] and m[2].grain not in ("interval", "hour")]),
    (False, "no spine among them", lambda ms: [] if any(m[2] and m[2].role == "spine" for m in ms) else ms[:1]),
]


def validate_roles(catalogue: Iterable[TableSpec], used: dict[str, str]) -> list[str]:
    """Warnings on a map of lake tables to source tables, by ROLE_CHECKS; an error if it would count the same load twice."""
    matches = _matches(list(catalogue), used)
    found = [(fatal, f"{source}: {said}") for fatal, said, check in ROLE_CHECKS for _, source, _ in check(matches)]
    if fatal := [said for is_fatal, said in found if is_fatal]:
        raise ValueError("; ".join(fatal))
    return [said for _, said in found]
