"""Relational tables: catalog tables, parquet folders, or JDBC where the session has a driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluice.control.config import Config, Table
from sluice.control.errors import ConfigurationError
from sluice.control.state import WatermarkCheckpoint
from sluice.functions.watermarks import codec, high_watermark, window
from sluice.sources.base import Source


def quoted(*parts: str | None, mark: str = "`") -> str:
    """A name of several parts, each quoted; ``mark`` is the session's backtick, or the double quote of standard SQL."""
    return ".".join(mark + p.replace(mark, mark * 2) + mark for p in parts if p)


class RelationalSource(Source):
    """Windows over one watermark column. The frame is lazy; filters and columns reach its scan."""

    def __init__(self, df: DataFrame, table: Table) -> None:
        self.df, self.table = df, table
        if table.watermark not in df.columns:
            raise ConfigurationError(f"{table.name} has no column {table.watermark}")
        self.codec = codec(df.schema[table.watermark].dataType, table.watermark)
        if table.lookback_minutes and not self.codec.has_lookback:
            raise ConfigurationError(f"{table.name}: no lookback over {self.codec.value_type}")

    def current_checkpoint(self, previous: WatermarkCheckpoint | None) -> WatermarkCheckpoint | None:
        high = high_watermark(self.df, self.table.watermark).first()["value_text"]
        return None if high is None else WatermarkCheckpoint(self.table.watermark, high, self.codec.value_type, self.table.lookback_minutes)

    def extract(self, previous: WatermarkCheckpoint | None, current: WatermarkCheckpoint) -> DataFrame:
        low = previous.value if previous else None
        return window(self.df, self.table.watermark, low, current.value, self.table.lookback_minutes if low is not None else 0)

    def schema(self) -> T.StructType:
        return self.df.schema

    def metadata(self) -> dict:
        return {"database": self.table.database, "schema": self.table.schema, "table": self.table.object}


def build(spark: SparkSession, config: Config, table: Table, credentials: dict, clock) -> RelationalSource:
    kind = config.type
    if kind == "jdbc" or credentials.get("url"):
        # A time without zone is one here, too. Windows are pushed down; credentials may name partitionColumn and its bounds for parallel reads.
        options = {"preferTimestampNTZ": "true", "fetchsize": str(config.fetch_size)} | {k: str(v) for k, v in credentials.items()} | {"dbtable": quoted(table.database, table.schema, table.object, mark='"')}
        return RelationalSource(spark.read.format("jdbc").options(**options).load(), table)
    if "/" in table.object:
        return RelationalSource(spark.read.parquet(table.object), table)
    return RelationalSource(spark.table(quoted(table.database, table.schema, table.object)), table)
