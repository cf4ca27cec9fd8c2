"""Reading history: latest versions, current state, JSON fields and line items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first in order. A key may have any number of rows: each partition sends on one row of it only,
    as the optimizer sees that the others can't be first (WindowGroupLimit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def latest_version(df: DataFrame, business_id: Column, version: Column, *ties: str) -> DataFrame:
    """The highest version of each business id, ties by the given columns, highest first. Versions compare as whole numbers of
    up to 38 digits; rows without id or version don't count."""
    x = df.withColumn("__id", business_id).withColumn("__version", version.try_cast("decimal(38,0)")).where(F.col("__id").isNotNull() & F.col("__version").isNotNull())
    return first_by(x, ["__id"], [F.col("__version").desc(), *[F.col(t).desc() for t in ties]]).drop("__id", "__version")


def current_state(df: DataFrame, primary_key: list[str], watermark: str, *ties: str) -> DataFrame:
    """The newest row of each primary key."""
    return first_by(df, primary_key, [F.col(watermark).desc(), *[F.col(t).desc() for t in ties]])


def scalar(json: Column, path: str, kind: str = "string") -> Column:
    """A scalar at a path; null for objects and arrays, and for what the type can't hold. Decimals keep their digits."""
    return F.try_variant_get(F.try_parse_json(json), path, kind)


def explode_items(df: DataFrame, json: str, items: str) -> DataFrame:
    """A row for each item of a JSON array column, its fields as columns. Rows with null or empty arrays have none."""
    rest = [c for c in df.columns if c != json]
    return df.select(*rest, F.inline(F.from_json(json, items)))


def id_suffix(envelope_id: Column) -> Column:
    """The part of an envelope id behind its first colon."""
    return F.split_part(envelope_id, F.lit(":"), F.lit(2))
