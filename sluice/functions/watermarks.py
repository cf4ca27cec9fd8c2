"""Watermarks as lossless text, and the windows they bound."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.control.errors import ConfigurationError

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSSSSS"


@dataclass(frozen=True)
class Codec:
    """How a watermark column's type goes to text and back."""

    value_type: str
    spark_type: T.DataType
    has_lookback: bool = False
    ordered: str = "no"  # how texts compare: as "text", as "number", or not at all

    def to_text(self, column: Column) -> Column:
        if self.value_type == "TIMESTAMP_NTZ":
            return F.date_format(column, STAMP)
        if self.value_type == "TIMESTAMP_TZ":
            return F.date_format(column, STAMP + " XXX")
        return column.cast("string")

    def literal(self, text: str) -> Column:
        if self.value_type == "TIMESTAMP_NTZ":
            return F.to_timestamp_ntz(F.lit(text), F.lit(STAMP)) if "." in text else F.lit(text).cast(T.TimestampNTZType())
        if self.value_type == "TIMESTAMP_TZ":
            return F.to_timestamp(F.lit(text), STAMP + " XXX")
        return F.lit(text).cast(self.spark_type)


def codec(kind: T.DataType, column: str = "watermark") -> Codec:
    """The codec of a column type; types whose text isn't lossless are refused."""
    if isinstance(kind, T.TimestampNTZType):
        return Codec("TIMESTAMP_NTZ", kind, True, "text")
    if isinstance(kind, T.TimestampType):
        return Codec("TIMESTAMP_TZ", kind, True, "text")
    if isinstance(kind, T.DateType):
        return Codec("DATE", kind, False, "text")
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return Codec("NUMBER", kind, False, "number")
    if isinstance(kind, T.StringType):
        return Codec("TEXT", kind)
    if kind.typeName().startswith("time"):
        return Codec("TIME", kind, False, "text")
    raise ConfigurationError(f"{column} of type {kind.simpleString()} can't be a watermark")


def high_watermark(df: DataFrame, column: str) -> DataFrame:
    """One row: ``value_text``, the highest value as text; null where there is none."""
    return df.agg(codec(df.schema[column].dataType, column).to_text(F.max(F.col(column))).alias("value_text"))


def window(df: DataFrame, column: str, low: str | None, high: str, lookback_minutes: int = 0) -> DataFrame:
    """Rows of (low - lookback, high]; without low, all rows up to high. Rows with null watermark are in no window.

    Bounds are literals of the column's own type, so the predicate reaches the scan.
    """
    c = codec(df.schema[column].dataType, column)
    at = F.col(column)
    inside = at <= c.literal(high)
    if low is not None:
        bound = c.literal(low)
        if lookback_minutes:
            if not c.has_lookback:
                raise ConfigurationError(f"no lookback over {column} of type {c.value_type}")
            bound = bound - F.make_dt_interval(mins=F.lit(lookback_minutes))
        inside = (at > bound) & inside
    return df.where(inside)


def regressed(value_type: str, previous: str | None, current: str | None) -> bool:
    """Whether a high watermark lies before the committed one. Types without order never do."""
    if previous is None or current is None:
        return False
    if value_type in ("NUMBER", "FIXED", "REAL"):
        try:
            return Decimal(current) < Decimal(previous)
        except InvalidOperation:
            return False
    if value_type.startswith("TIMESTAMP") or value_type in ("DATE", "TIME"):
        return current < previous
    return False
