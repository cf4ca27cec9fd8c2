"""The consumer-facing catalog: what columns a table is said to have, with declared types over the table's own.

An entry is a numbered file created exclusively, so a writer who didn't see the last version loses. Only the columns' types are
ever replaced; location and metadata pointer stay.
"""

from __future__ import annotations

import json
import logging
from dataclasses import asdict, dataclass

from sluice.control.errors import CheckpointConflictError, IngestError

log = logging.getLogger("sluice")


@dataclass(frozen=True)
class Entry:
    name: str
    columns: tuple[tuple[str, str], ...]
    partition_columns: tuple[tuple[str, str], ...] = ()
    metadata_location: str | None = None
    version_id: int = 0


class FileCatalog:
    def __init__(self, files, root: str) -> None:
        self.files, self.root = files, root.rstrip("/")

    def get(self, name: str) -> Entry | None:
        """The latest entry, names in lower case; None where there is no such table."""
        versions = [int(n[1:-5]) for n in self.files.names(f"{self.root}/{name.lower()}") if n.startswith("v") and n.endswith(".json")]
        if not versions:
            return None
        d = json.loads(self.files.read(f"{self.root}/{name.lower()}/v{max(versions)}.json"))
        pairs = lambda k: tuple((n.lower(), t) for n, t in d[k])
        return Entry(d["name"], pairs("columns"), pairs("partition_columns"), d["metadata_location"], max(versions))

    def columns(self, name: str) -> dict[str, str] | None:
        e = self.get(name)
        return None if e is None else dict(e.columns + e.partition_columns)

    def put(self, entry: Entry) -> Entry:
        """Stores an entry over the version it was made from."""
        done = Entry(**asdict(entry) | {"columns": entry.columns, "partition_columns": entry.partition_columns, "version_id": entry.version_id + 1})
        if not self.files.create(f"{self.root}/{entry.name.lower()}/v{done.version_id}.json", json.dumps(asdict(done))):
            raise CheckpointConflictError(f"the catalog entry of {entry.name} isn't at version {entry.version_id} any more")
        return done

    def check_metadata(self, name: str) -> None:
        """Refuses an entry whose metadata file is gone; a table without entry, or an entry without pointer, is none of its business."""
        e = self.get(name)
        if e and e.metadata_location and not self.files.exists(e.metadata_location):
            raise IngestError(f"{name}: the catalog points to {e.metadata_location}, which is gone")

    def override(self, name: str, types: dict[str, str]) -> bool:
        """Declares types of columns; True if that changed anything. Columns that the table lacks are warned of and left out."""
        e = self.get(name)
        if e is None or not types:
            return False
        have = dict(e.columns)
        low = {k.lower(): v for k, v in types.items()}
        for unknown in sorted(set(low) - set(have)):
            log.warning("%s has no column %s to declare a type for", name, unknown)
        columns = tuple((n, low.get(n, t)) for n, t in e.columns)
        if columns == e.columns:
            return False
        self.put(Entry(e.name, columns, e.partition_columns, e.metadata_location, e.version_id))
        return True
