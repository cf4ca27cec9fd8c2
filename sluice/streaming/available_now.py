"""Structured Streaming at the edges: new files as one transaction each trigger, and late-event corrections."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import lateness


def drain(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Runs ``each`` on every micro-batch that is there now, then stops. A batch that failed comes again under its number, so
    ``each`` must be idempotent by it."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class VersionedTotals:
    """Keyed, versioned state of corrected totals: each batch reads the version before it and writes its own.

    A batch adds its events to their periods and emits the change log: old totals negatively, new ones positively. Only open periods,
    those that events arriving from now on can still change, are written anew with each version, so the state is as large as
    the cut-off is long. A period that closes is written once to the closed ones. Should an arrival time go back behind
    that of an earlier batch, its period is taken from there, and its new total counts over the old. Events beyond the cut-off are
    left out. Null keys are keys like any, null measures count as 0.
    """

    def __init__(self, spark: SparkSession, root: str, keys: str, event: str, arrival: str, measures: dict[str, str], period_s: int = 3600, cutoff_s: int = 48 * 3600) -> None:
        self.spark, self.root, self.keys, self.event, self.arrival, self.measures, self.period_s, self.cutoff_s = spark, root.rstrip("/"), [k for k in keys.split(",") if k], event, arrival, measures, period_s, cutoff_s
        self.on = [*self.keys, "period_start"]
        self.schema = ", ".join([*(f"{k} string" for k in self.keys), "period_start timestamp", *(f"{m} bigint" for m in measures)])

    def _read(self, part: str, version: int, schema: str) -> DataFrame:
        """A part's rows of one version; of closed periods those up to it, with ``__version``."""
        if version < 0:
            return self.spark.createDataFrame([], schema)
        if part != "closed":
            return self.spark.read.schema(schema).parquet(f"{self.root}/{part}/__version={version}")
        return self.spark.read.schema(schema).parquet(f"{self.root}/{part}").where(F.col("__version") <= version)

    def _closed(self, version: int) -> DataFrame:
        rows = self._read("closed", version, f"{self.schema}, __version int")
        return rows.groupBy(*self.on).agg(F.max_by(F.struct(*self.measures), "__version").alias("__m")).select(*self.on, "__m.*")

    def _horizon(self, version: int) -> int | None:
        """The latest arrival seen, in microseconds."""
        row = self._read("horizon", version, "us bigint").first()
        return row and row["us"]

    def open_periods(self, version: int) -> DataFrame:
        return self._read("open", version, self.schema)

    def state(self, version: int) -> DataFrame:
        """All totals as of a version."""
        return self.open_periods(version).unionByName(self._closed(version))

    def _matched(self, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return left.join(right, reduce(lambda x, y: x & y, [F.col(f"old_{k}").eqNullSafe(F.col(f"d_{k}")) for k in self.on]), how)

    def batch(self, df: DataFrame, number: int) -> None:
        x = lateness.classify(df, self.event, self.arrival, self.period_s, 0, self.cutoff_s)
        kept = x.where(F.col("arrival_class").isin("reported", "correction"))
        delta = kept.groupBy(*[F.col(k).cast("string").alias(k) for k in self.keys], "period_start").agg(*[F.coalesce(F.sum(F.expr(e)), F.lit(0)).cast("bigint").alias(m) for m, e in self.measures.items()], F.max(F.unix_micros(self.arrival)).alias("__at")).cache()
        try:
            before = self._horizon(number - 1)
            first, at = delta.agg(F.min(F.unix_micros("period_start")), F.max("__at")).first()
            after = max((h for h in (before, at) if h is not None), default=None)
            span = (self.cutoff_s + self.period_s) * 1_000_000
            d = delta.select(*[F.col(k).alias(f"d_{k}") for k in (*self.on, *self.measures)], F.lit(True).alias("hit"))
            prefixed = lambda t: t.select(*[F.col(k).alias(f"old_{k}") for k in (*self.on, *self.measures)], F.lit(True).alias("had"))
            old = prefixed(self.open_periods(number - 1))
            if before is not None and first is not None and first < before - span:
                old = old.unionByName(self._matched(prefixed(self._closed(number - 1).where(F.unix_micros("period_start") >= first)), d, "left_semi"))
            both = self._matched(old, d, "full").select("*", *[F.when(F.col("had"), F.col(f"old_{k}")).otherwise(F.col(f"d_{k}")).alias(k) for k in self.on])
            both = both.withColumns({m: (F.coalesce(f"old_{m}", F.lit(0)) + F.coalesce(f"d_{m}", F.lit(0))).cast("bigint") for m in self.measures})
            is_open = F.lit(True) if after is None else F.unix_micros("period_start") >= after - span
            # Overwriting makes a repeated batch harmless.
            write = lambda t, part: t.write.mode("overwrite").parquet(f"{self.root}/{part}/__version={number}")
            write(both.where(is_open).select(*self.on, *self.measures), "open")
            write(both.where(~is_open).select(*self.on, *self.measures), "closed")
            row = lambda sign, of: F.struct(F.lit(sign).alias("sign"), *[F.col(f"{of}{m}").alias(m) for m in self.measures])
            write(both.where("hit").select(*self.on, F.inline(F.when(F.col("had"), F.array(row(-1, "old_"), row(1, ""))).otherwise(F.array(row(1, ""))))), "changes")
            write(self.spark.createDataFrame([(after,)], "us bigint"), "horizon")
        finally:
            delta.unpersist()
