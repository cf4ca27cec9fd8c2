"""Landing: a run's rows as an immutable Parquet folder, sealed by a manifest."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.control.config import LINEAGE
from sluice.control.errors import LandingError
from sluice.control.manifest import NAME
from sluice.operators.drift import held
from sluice.session import stored

RECORDED = {"bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8", "double": "double", "float": "float", "boolean": "bool", "string": "string", "binary": "binary", "date": "date32[day]"}


def recorded_type(kind: T.DataType) -> str:
    """The name under which a manifest records a type."""
    if isinstance(kind, T.DecimalType):
        return f"decimal128({kind.precision}, {kind.scale})"
    if isinstance(kind, T.TimestampNTZType):
        return "timestamp[us]"
    if isinstance(kind, T.TimestampType):
        return "timestamp[us, tz=UTC]"
    return RECORDED.get(kind.simpleString(), "string")


def recorded_schema(schema: T.StructType) -> list[dict]:
    return [{"name": f.name, "type": recorded_type(f.dataType)} for f in schema]


def with_lineage(df: DataFrame, run_id: str, ingested_at: str, source_system: str, database: str | None = None, schema: str | None = None, table: str | None = None) -> DataFrame:
    """The rows with the six lineage columns behind their own. A column of such a name, in any case, is refused."""
    taken = {c.lower() for c in df.columns} & set(LINEAGE)
    if taken:
        raise LandingError(f"the source has lineage columns already: {', '.join(sorted(taken))}")
    values = (run_id, ingested_at, source_system, database, schema, table)
    return df.select("*", *[F.lit(v).cast("string").alias(k) for k, v in zip(LINEAGE, values)])


def exact_cast(value: Column, to: T.DataType, kind: T.DataType = T.StringType()) -> Column:
    """A value of type ``kind`` in another type; null where that type can't hold exactly it (digits lost count as not held)."""
    if isinstance(to, T.StringType):
        return value.try_cast(to)
    if isinstance(kind, T.StringType):
        return held(value, to.simpleString()).cast(to)
    got = value.try_cast(to)
    return F.when(got.try_cast(kind) == value, got)


def pinned(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, Column]:
    """The frame in a run's pinned schema, and a condition that is true for rows the schema can't hold without loss.

    Missing columns are null; columns that the schema lacks count as loss where they have a value. Numbers go into decimals by
    their decimal digits, not a number is null.
    """
    have = {c.lower(): c for c in df.columns}
    cells, lost = [], F.lit(False)
    for f in schema:
        if f.name.lower() not in have:
            cells.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        column = F.col(f"`{have[f.name.lower()]}`")
        kind = df.schema[have[f.name.lower()]].dataType
        if kind == f.dataType:
            cells.append(column.alias(f.name))
            continue
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column)
        cell = exact_cast(column, f.dataType, kind)
        cells.append(cell.alias(f.name))
        lost = lost | (column.isNotNull() & cell.isNull())
    for extra in set(have) - {f.name.lower() for f in schema}:
        lost = lost | F.col(f"`{have[extra]}`").isNotNull()
    return df.select(*cells), lost


class LandingRun:
    """One run's folder. ``write`` may be called for several frames; each adds parts. Nothing counts before the manifest."""

    def __init__(self, files, folder: str, run_id: str, lineage: tuple[str, str | None, str | None, str | None], started_at: datetime, rows_per_file: int | None = None) -> None:
        self.files, self.folder, self.run_id, self.lineage, self.started_at, self.rows_per_file = files, folder, run_id, lineage, started_at, rows_per_file
        self.row_count, self.schema, self.drift, self.writes = 0, None, False, 0

    def write(self, df: DataFrame, schema: T.StructType | None = None) -> int:
        """Lands a frame; rows are counted while they are written.

        The first frame (or its declared schema) pins the run's schema, null-typed columns as text. A later frame that the
        schema can't hold lands as it is and marks the run as drifted; nothing is truncated. A frame of other types than the schema's is
        stored before it is held against it, so what is checked is what lands, and the source is read once in any case.
        """
        if any(isinstance(f.dataType, T.NullType) for f in df.schema):
            df = df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else F.col(f"`{f.name}`") for f in df.schema])
        if self.schema is None:
            self.schema = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType) for f in schema or df.schema])
        rows, lost = pinned(df, self.schema)
        if rows.schema.simpleString() != df.schema.simpleString():
            df = stored(df, "landing")
            rows, lost = pinned(df, self.schema)
            if df.where(lost).limit(1).count():
                self.drift, rows = True, df
        seen = Observation()
        landed = with_lineage(rows, self.run_id, self.started_at.isoformat(timespec="seconds"), *self.lineage).observe(seen, F.count(F.lit(1)).alias("n"))
        writer = landed.write.mode("append" if self.writes else "errorifexists").option("compression", "snappy")
        if self.rows_per_file:
            writer = writer.option("maxRecordsPerFile", self.rows_per_file)
        writer.parquet(self.folder)
        self.writes += 1
        n = seen.get["n"]
        self.row_count += n
        return n

    def parts(self) -> list[str]:
        """The run's data files by name; an empty run has none (Spark leaves a part without rows, which is removed)."""
        names = [n for n in self.files.names(self.folder) if n.endswith(".parquet")]
        if self.row_count == 0:
            for n in names:
                self.files.delete(f"{self.folder}/{n}")
            return []
        return names

    def recorded_schema(self) -> list[dict] | None:
        if self.row_count == 0 or self.drift or self.schema is None:
            return None
        return recorded_schema(self.schema) + [{"name": c, "type": "string"} for c in LINEAGE]

    @property
    def manifest_path(self) -> str:
        return f"{self.folder}/{NAME}"
