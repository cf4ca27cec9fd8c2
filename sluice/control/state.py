"""Checkpoints with optimistic versions, and the ledger of merged runs."""

from __future__ import annotations

import json
from abc import ABC, abstractmethod
from dataclasses import dataclass

from sluice.control.errors import CheckpointConflictError, ConfigurationError


@dataclass(frozen=True)
class WatermarkCheckpoint:
    """How far a table has been read: one monotonic column, its value as lossless text. lookback_minutes is for the record;
    the configuration decides."""

    column: str
    value: str | None = None
    value_type: str | None = None
    lookback_minutes: int = 0
    type: str = "watermark"

    def to_dict(self) -> dict:
        return {"type": self.type, "column": self.column, "value": self.value, "value_type": self.value_type, "lookback_minutes": self.lookback_minutes}

    @classmethod
    def from_dict(cls, data: dict) -> WatermarkCheckpoint:
        return cls(data["column"], data.get("value"), data.get("value_type"), int(data.get("lookback_minutes") or 0))


CHECKPOINTS: dict[str, type] = {"watermark": WatermarkCheckpoint}


def checkpoint_class(kind: str) -> type:
    try:
        return CHECKPOINTS[kind]
    except KeyError:
        raise ConfigurationError(f"unknown checkpoint type {kind!r}; known: {', '.join(sorted(CHECKPOINTS))}") from None


@dataclass(frozen=True)
class StateRecord:
    checkpoint: WatermarkCheckpoint | None = None
    version: int = 0
    run_id: str | None = None
    landing_folder: str | None = None
    row_count: int | None = None
    file_count: int | None = None
    updated_at: str | None = None


class CheckpointStore(ABC):
    @abstractmethod
    def get(self, source_key: str, table: str) -> StateRecord: ...

    @abstractmethod
    def commit(self, source_key: str, table: str, expected: int, record: StateRecord) -> StateRecord:
        """Stores ``record`` as version expected + 1, or raises CheckpointConflictError."""

    @abstractmethod
    def all(self, source_key: str) -> dict[str, StateRecord]: ...


class FileCheckpointStore(CheckpointStore):
    """``<root>/<source key>/<table>/v<N>.json``, each created exclusively, so of two writers one loses. A record without a
    version (``legacy.json``) counts as version 0 and can be taken over once."""

    def __init__(self, files, root: str) -> None:
        self.files, self.root = files, root.rstrip("/")

    def _folder(self, source_key: str, table: str) -> str:
        return f"{self.root}/{source_key}/{table}"

    def get(self, source_key: str, table: str) -> StateRecord:
        folder = self._folder(source_key, table)
        versions = [int(n[1:-5]) for n in self.files.names(folder) if n.startswith("v") and n.endswith(".json") and n[1:-5].isdigit()]
        text = self.files.read(f"{folder}/v{max(versions)}.json" if versions else f"{folder}/legacy.json")
        if text is None:
            return StateRecord()
        data = json.loads(text)
        c = data.get("checkpoint")
        return StateRecord(**data | {"checkpoint": c and checkpoint_class(c["type"]).from_dict(c), "version": int(data.get("version") or 0)})

    def commit(self, source_key: str, table: str, expected: int, record: StateRecord) -> StateRecord:
        done = StateRecord(**vars(record) | {"version": expected + 1})
        text = json.dumps(vars(done) | {"checkpoint": done.checkpoint and done.checkpoint.to_dict()}, indent=1)
        if self.get(source_key, table).version != expected or not self.files.create(f"{self._folder(source_key, table)}/v{expected + 1}.json", text):
            raise CheckpointConflictError(f"{source_key}/{table} isn't at version {expected} any more")
        return done

    def all(self, source_key: str) -> dict[str, StateRecord]:
        return {t: self.get(source_key, t) for t in self.files.names(f"{self.root}/{source_key}")}


class RunLedger(ABC):
    """Which runs are merged. It only saves work: merging a run again adds nothing."""

    @abstractmethod
    def processed(self, table_key: str) -> set[str]: ...

    @abstractmethod
    def mark(self, table_key: str, run_id: str, **facts) -> None: ...


class NullLedger(RunLedger):
    def processed(self, table_key: str) -> set[str]:
        return set()

    def mark(self, table_key: str, run_id: str, **facts) -> None:
        pass


class FileLedger(RunLedger):
    def __init__(self, files, root: str) -> None:
        self.files, self.root = files, root.rstrip("/")

    def processed(self, table_key: str) -> set[str]:
        return {n.removesuffix(".json") for n in self.files.names(f"{self.root}/{table_key.replace(':', '/')}")}

    def mark(self, table_key: str, run_id: str, **facts) -> None:
        self.files.create(f"{self.root}/{table_key.replace(':', '/')}/{run_id}.json", json.dumps({"table_key": table_key, "run_id": run_id, "bronze_status": "SUCCESS"} | facts))
