"""Command line: list what there is, run one query and write its result, or run a stage over a lake."""

from __future__ import annotations

import argparse
import sys

from datetime import date

from crestline import catalog, stages
from crestline.config import load_config
from crestline.operators.model import REDUCERS
from crestline.operators.quantile import BACKENDS
from crestline.registry import Registry
from crestline.sources.lake import available_sources, get_source, probe


STAGES = ("diagnostics", "coincidence", "train", "simulate", "evaluate", "backtest")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="crestline")
    verbs = out.add_subparsers(dest="verb", required=True)
    for name in ("sources", "reducers", "backends", "queries"):
        verbs.add_parser(name)
    verbs.add_parser("check").add_argument("--config")
    run = verbs.add_parser("run")
    run.add_argument("query")
    run.add_argument("tables", help="folder of the tables")
    run.add_argument("out", help="folder for the result")
    for name in ("ingest", "probe"):
        verb = verbs.add_parser(name)
        verb.add_argument("source", help="a name that `sources` lists")
        verb.add_argument("start", type=date.fromisoformat)
        verb.add_argument("end", type=date.fromisoformat)
        verb.add_argument("--folder", help="where the files source reads")
        if name == "ingest":
            verb.add_argument("lake", help="folder of the lake")
    verbs.add_parser("tables").add_argument("lake")
    for name in STAGES:
        verb = verbs.add_parser(name)
        verb.add_argument("lake")
        verb.add_argument("--runs", default="runs")
        if name in ("simulate", "backtest"):
            verb.add_argument("--paths", type=int, default=1000)
    verb = verbs.add_parser("pack")
    verb.add_argument("out")
    verb.add_argument("--runs", default="runs")
    verb = verbs.add_parser("runs")
    verb.add_argument("kind")
    verb.add_argument("--runs", default="runs")
    verb.add_argument("--verify", action="store_true")
    return out


def session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def staged(given: argparse.Namespace) -> str:
    """What a stage has to say."""
    if given.verb == "runs":
        runs = Registry(given.runs)
        return "\n".join(runs.verify(given.kind) or ["clean"] if given.verify else runs.runs(given.kind))
    spark = session()
    if given.verb in ("ingest", "probe"):
        source = get_source(given.source, spark=spark, **({"folder": given.folder} if given.folder else {}))
        if given.verb == "ingest":
            return "\n".join(stages.ingest(spark, source, given.start, given.end, given.lake))
        rows = source.fetch("intervals", given.start, given.end)
        if rows is None:
            raise ValueError("the source has no intervals")
        return "\n".join(f"{k}: {v}" for k, v in probe(rows).first().asDict().items())
    if given.verb == "tables":
        return "\n".join(f"{k}: {n}" for k, n in stages.tables(spark, given.lake).items())
    runs = Registry(given.runs)
    if given.verb == "pack":
        return "\n".join(map(str, stages.pack(spark, runs, given.out)))
    more = {"paths": given.paths} if "paths" in given else {}
    said = getattr(stages, given.verb)(spark, given.lake, runs, **more)
    return str(said.folder) if given.verb == "simulate" else str(said)


def main(args: list[str] | None = None) -> int:
    """0, or 2 with a hint where something expected went wrong."""
    given = parser().parse_args(args)
    listed = {"sources": available_sources, "reducers": lambda: sorted(REDUCERS), "backends": lambda: sorted(BACKENDS), "queries": lambda: sorted(catalog.queries())}
    try:
        if given.verb in listed:
            print("\n".join(listed[given.verb]()))
        elif given.verb == "check":
            load_config(given.config)
            print("the configuration is valid")
        elif given.verb != "run":
            print(staged(given))
        else:
            if given.query not in catalog.queries():
                raise KeyError(f"unknown query {given.query!r}; `queries` lists them")
            catalog.queries()[given.query](session(), given.tables).write.mode("overwrite").parquet(given.out)
    except (KeyError, ValueError, RuntimeError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
