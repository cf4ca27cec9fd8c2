"""Landing runs and the manifests that commit them."""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from sluice.control.errors import IngestError, ManifestCommitError

NAME = "_manifest.json"
#: Requests to a store at a time.
READERS = 32
VERSION = 1
_RUN_ID, _DAY = re.compile(r"[A-Za-z0-9_-]+"), re.compile(r"\d{4}-\d\d-\d\d")


def run_folder(root: str, source_key: str, table: str, ingest_date: str, run_id: str) -> str:
    """Where a run lands. Values that end up in a path are checked."""
    if not _RUN_ID.fullmatch(run_id):
        raise IngestError(f"unusable run id {run_id!r}")
    if not _DAY.fullmatch(ingest_date):
        raise IngestError(f"unusable ingest date {ingest_date!r}")
    for part in (source_key, table):
        if not part or "/" in part or part in (".", ".."):
            raise IngestError(f"unusable name {part!r}")
    return f"{root.rstrip('/')}/{source_key}/{table}/ingest_date={ingest_date}/run_id={run_id}"


@dataclass(frozen=True)
class Manifest:
    """What one run landed. ``schema`` is None where no row or no single schema landed."""

    run_id: str
    source_system: str
    source: dict
    primary_key: list[str]
    checkpoint: dict
    load_type: str
    started_at: str
    completed_at: str
    row_count: int
    file_count: int
    files: list[str]
    schema: list[dict] | None
    schema_drift: bool = False
    status: str = "SUCCESS"
    version: int = VERSION

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=1, sort_keys=True)

    @classmethod
    def from_json(cls, text: str, where: str = "manifest") -> Manifest:
        try:
            data = json.loads(text)
            return cls(**{k: v for k, v in data.items() if k in cls.__dataclass_fields__})
        except (ValueError, TypeError, AttributeError) as e:
            raise IngestError(f"{where} is no manifest: {e}") from None


def commit(files, folder: str, manifest: Manifest) -> None:
    """Seals a run: written once, after all its parts."""
    if not files.create(f"{folder}/{NAME}", manifest.to_json()):
        raise ManifestCommitError(f"{folder} is sealed already")


@dataclass(frozen=True)
class CommittedRun:
    ingest_date: str
    run_id: str
    folder: str
    manifest: Manifest = field(repr=False)


def committed_runs(files, root: str, source_key: str, table: str) -> list[CommittedRun]:
    """All sealed successful runs of a table, by (ingest date, run id). Folders without manifest aren't committed;
    a manifest that can't be read is an error, not a run to skip. Days and manifests are read READERS at a time, as a store's answers
    take longer than its bytes."""
    top = f"{root.rstrip('/')}/{source_key}/{table}"
    days = [d for d in files.names(top) if d.startswith("ingest_date=")]
    runs = []
    with ThreadPoolExecutor(READERS) as pool:
        listed = pool.map(lambda d: [f"{d}/{r}" for r in files.names(f"{top}/{d}") if r.startswith("run_id=")], days)
        at = [r for some in listed for r in some]
        for place, text in zip(at, pool.map(lambda r: files.read(f"{top}/{r}/{NAME}"), at)):
            if text is None:
                continue
            m = Manifest.from_json(text, f"{top}/{place}")
            if m.status == "SUCCESS":
                day, run = place.split("/")
                runs.append(CommittedRun(day.removeprefix("ingest_date="), run.removeprefix("run_id="), f"{top}/{place}", m))
    return sorted(runs, key=lambda r: (r.ingest_date, r.run_id))


def sweep_empty(files, root: str, delete: bool = False) -> list[str]:
    """Run folders that hold one manifest with no rows and no files, and nothing else; deleted only if asked to.

    Reads the listing in path order, so no more than one run is held at a time."""
    empty: list[str] = []

    def close(folder: str | None, names: list[str]) -> None:
        if folder is None or names != [NAME]:
            return
        m = Manifest.from_json(files.read(f"{folder}/{NAME}") or "", folder)
        if m.row_count == 0 and m.file_count == 0:
            empty.append(folder)

    at, names = None, []
    for info in files.walk(root):
        found = re.match(r"(.*/run_id=[^/]+)/(.+)$", info.path)
        if not found:
            continue
        if found[1] != at:
            close(at, names)
            at, names = found[1], []
        names.append(found[2])
    close(at, names)
    if delete:
        for folder in empty:
            files.delete(f"{folder}/{NAME}")
    return empty
