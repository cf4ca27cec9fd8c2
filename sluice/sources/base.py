"""What a source is, and how one is found by its type."""

from __future__ import annotations

import importlib
from abc import ABC, abstractmethod
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.control.errors import ConfigurationError
from sluice.control.state import WatermarkCheckpoint

#: Module of each source type; it has build(spark, config, table, credentials, clock) -> Source.
MODULES = {"warehouse": "sluice.sources.relational", "snowflake": "sluice.sources.relational", "parquet": "sluice.sources.relational", "jdbc": "sluice.sources.relational", "json_files": "sluice.sources.json_files", "s3_json": "sluice.sources.json_files"}


class Source(ABC):
    """One table of a source system. The bound is taken before anything is extracted, and is what gets committed."""

    @abstractmethod
    def current_checkpoint(self, previous: WatermarkCheckpoint | None) -> WatermarkCheckpoint | None:
        """How far this run will read; None where there is nothing."""

    def caught_up(self, checkpoint: WatermarkCheckpoint) -> bool:
        """Whether that bound was the source's own, not a cap's. Must not look at the clock again."""
        return True

    @abstractmethod
    def extract(self, previous: WatermarkCheckpoint | None, current: WatermarkCheckpoint) -> DataFrame:
        """The window's rows, lazily."""

    def schema(self) -> T.StructType | None:
        """The declared schema, if the source has one."""
        return None

    @abstractmethod
    def metadata(self) -> dict: ...

    #: Whether a window without rows still moves the checkpoint.
    commits_empty = False

    def close(self) -> None:
        pass


def register(kind: str, module: str) -> None:
    MODULES[kind] = module


def factory(kind: str) -> Callable[..., Source]:
    """The builder of a source type; imported only when needed."""
    if kind not in MODULES:
        raise ConfigurationError(f"unknown source type {kind!r}; known: {', '.join(sorted(MODULES))}")
    module = importlib.import_module(MODULES[kind])
    build = getattr(module, "build", None)
    if build is None:
        raise ConfigurationError(f"source type {kind!r}: its module has no build()")
    return build
