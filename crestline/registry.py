"""Runs as logs: each run is a folder with a log of records, and everything known of a run is read from its log.

A log is a file of JSON lines, each a record of one kind: `begin`, `fact` (a value of a part), `file` (an artefact with
size and hash) and `end`. Nothing is rewritten; a later record of the same thing stands. The latest run of a kind is
the one whose `end` came last, so there is no pointer that could be wrong.
"""

from __future__ import annotations

import json
import time
from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from hashlib import sha256
from pathlib import Path
from typing import Any

LOG = "records.jsonl"


def _seal(path: Path) -> dict[str, Any]:
    """Size and hash of a file, read in blocks."""
    h, size = sha256(), 0
    with path.open("rb") as f:
        while block := f.read(4 << 20):
            h.update(block)
            size += len(block)
    return {"bytes": size, "sha256": h.hexdigest()}


@dataclass
class Run:
    folder: Path

    def tell(self, kind: str, **values: Any) -> None:
        """Appends a record."""
        with (self.folder / LOG).open("a") as f:
            f.write(json.dumps({"kind": kind, "time": time.time(), **values}, default=str) + "\n")

    def records(self, kind: str | None = None) -> Iterator[dict[str, Any]]:
        for line in (self.folder / LOG).read_text().splitlines():
            record = json.loads(line)
            if kind in (None, record["kind"]):
                yield record

    def note(self, part: str, values: Mapping[str, Any]) -> None:
        """States values of a part, such as 'metrics', 'inputs' or 'record'."""
        for name, value in values.items():
            self.tell("fact", part=part, name=name, value=value)

    def add(self, name: str, role: str) -> None:
        """States a file of the run, or each file of a folder such as Spark writes."""
        for path in sorted(p for p in [self.folder / name, *(self.folder / name).rglob("*")] if p.is_file()):
            self.tell("file", role=role, path=str(path.relative_to(self.folder)), **_seal(path))

    def write_json(self, name: str, value: Any, role: str = "") -> Path:
        path = self.folder.joinpath(name)
        path.parent.mkdir(exist_ok=True, parents=True)
        with path.open("w") as f:
            json.dump(value, f, default=str)
        self.add(name, role or name)
        return path

    def finish(self, status: str = "ok", note: str = "") -> None:
        self.tell("end", status=status, note=note)

    @property
    def manifest(self) -> dict[str, Any]:
        """What the log comes to: the facts of each part by name, the files by path, and how the run began and ended."""
        parts: dict[str, Any] = defaultdict(dict)
        for r in self.records():
            if r["kind"] == "fact":
                parts[r["part"]][r["name"]] = r["value"]
            elif r["kind"] == "file":
                parts["files"][r["path"]] = r
            else:
                parts[r["kind"]] = r
        return dict(parts)

    def faults(self) -> list[str]:
        """Files that are missing or not as they were stated."""
        files = self.manifest.get("files", {})
        state = {p: _seal(self.folder / p) if (self.folder / p).is_file() else None for p in files}
        return [f"{'missing' if now is None else 'changed'}: {p}" for p, now in state.items() if now is None or now["sha256"] != files[p]["sha256"]]


class Registry:
    """Runs by kind below a folder that driver and executors share."""

    def __init__(self, root: str | Path = "runs"):
        self.root = Path(root)

    def _all(self, kind: str) -> dict[str, Run]:
        return {log.parent.name: Run(log.parent) for log in sorted(self.root.joinpath(kind).glob(f"*/{LOG}"))}

    def start(self, kind: str, run_id: str = "", config: Any = None, tags: Iterable[str] = ()) -> Run:
        name = run_id or time.strftime("%Y%m%d-%H%M%S", time.gmtime()) + f"-{time.time_ns() % 10**9:09d}"
        run = Run(self.root / kind / name)
        run.folder.mkdir(parents=True, exist_ok=True)
        run.tell("begin", run=name, of=kind, tags=[*tags], config=config)
        return run

    def runs(self, kind: str) -> list[str]:
        return list(self._all(kind))

    def find(self, kind: str, run_id: str = "latest") -> Run:
        """A run by its name; 'latest' is the run that ended last."""
        known = self._all(kind)
        if run_id != "latest":
            ended = {run_id: 0.0} if run_id in known else {}
        else:
            ended = {name: r["time"] for name, run in known.items() for r in run.records("end")}
        if not ended:
            raise FileNotFoundError(f"{self.root / kind} has no run {run_id!r}")
        return known[max(ended, key=lambda name: ended[name])]

    def verify(self, kind: str, run_id: str = "latest") -> list[str]:
        return self.find(kind, run_id).faults()
