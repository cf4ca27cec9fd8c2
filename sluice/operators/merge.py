"""Merging a run into history: rows whose key isn't there yet are added, nothing is changed.

The key is the primary key and the watermark, so each version of a row is kept once. Rows that repeat inside a run are all
added if their key is new; a null in the key matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.control.config import partition_transform
from sluice.control.errors import IngestError


def unmatched(run: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a run without a match in the target: a left anti join on the keys.

    Of the target only keys are read. Which side is small is left to the optimizer: only the target may be broadcast in an
    anti join, and the bronze table keeps that side near the size of the run.
    """
    if not keys:
        raise IngestError("a merge needs a key")
    for side, df in (("run", run), ("target", target)):
        missing = [k for k in keys if k.lower() not in {c.lower() for c in df.columns}]
        if missing:
            raise IngestError(f"the {side} lacks the key columns {', '.join(missing)}")
    return run.join(target.select(*keys), keys, "left_anti").select(*run.columns)


def insert_unmatched(target: DataFrame, run: DataFrame, keys: list[str]) -> DataFrame:
    """The target after the merge. Columns that only one side has are null in the other's rows; types must agree."""
    ours = {f.name.lower(): f.dataType for f in target.schema}
    for f in run.schema:
        if f.name.lower() in ours and ours[f.name.lower()] != f.dataType:
            raise IngestError(f"column {f.name} is {ours[f.name.lower()].simpleString()} in the target and {f.dataType.simpleString()} in the run")
    return target.unionByName(unmatched(run, target, keys), allowMissingColumns=True)


def partition_value(spec: str, watermark: str, types: dict[str, str] | None = None) -> tuple[str, Column]:
    """(hidden column's name, its value) of a partition transform. Months, years and hours count from 1970; numbers are
    truncated to multiples, text to a length. types: the columns' types, needed for truncate."""
    name, width, column = partition_transform(spec, watermark)
    c = F.col(f"`{column}`")
    value = {
        "identity": lambda: c, "year": lambda: (F.year(c) - 1970).cast("int"), "month": lambda: ((F.year(c) - 1970) * 12 + F.month(c) - 1).cast("int"), "day": lambda: F.to_date(c),
        "hour": lambda: ((F.unix_micros(c.cast("timestamp")) - F.pmod(F.unix_micros(c.cast("timestamp")), F.lit(3_600_000_000))) / F.lit(3_600_000_000)).cast("int"),
        "bucket": lambda: F.pmod(F.hash(c), F.lit(width)), "truncate": lambda: F.substring(c, 1, width) if (types or {}).get(column.lower(), "string") == "string" else truncate_number(c, width),
    }[name]()
    return f"__p_{name}_{column.lower()}", value


def truncate_number(c: Column, width: int) -> Column:
    """The largest multiple of ``width`` that isn't above the number."""
    return c - F.pmod(c, F.lit(width))
