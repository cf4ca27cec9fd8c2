"""Late and out-of-order events: aggregates by event-time period, corrected by retraction until a cut-off.

Every accepted event is a differential update of its period. Updates of one period that arrive in the same version (a
tick of arrival time) are added up before any shuffle of state; a version that changes a reported aggregate emits the old
aggregate negatively and the new one positively. Downstream sums of these deltas are right after every version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3600


def classify(df: DataFrame, event: str, arrival: str, period_s: int = HOUR, grace_s: int = 900, cutoff_s: int = 48 * HOUR) -> DataFrame:
    """``df`` with ``period_start`` (timestamp) and ``arrival_class``.

    With the period [H, H+period): ``reported`` rows arrive not after its end plus grace (they are in the first report),
    ``correction`` rows later, but not after its end plus cutoff, ``too_late`` rows after that, and ``untimed`` rows have no
    event or arrival time. Rows are neither dropped nor added; columns of these two names are replaced.
    """
    us, came = F.unix_micros(F.col(event)), F.unix_micros(F.col(arrival))
    start = us - F.pmod(us, F.lit(period_s * 1_000_000))
    end = start + period_s * 1_000_000
    kind = (F.when(us.isNull() | came.isNull(), "untimed").when(came <= end + grace_s * 1_000_000, "reported")
            .when(came <= end + cutoff_s * 1_000_000, "correction").otherwise("too_late"))
    return df.withColumns({"period_start": F.timestamp_micros(start), "arrival_class": kind})


def versioned(classified: DataFrame, arrival: str, period_s: int = HOUR, grace_s: int = 900, tick_s: int = HOUR) -> DataFrame:
    """The rows that count, with ``version``: 0 for those in the first report, then the tick of arrival time in which they correct it.

    Rows that are too late or untimed are left out here; ``classify`` names them. A column ``version`` is replaced.
    """
    late = F.unix_micros(F.col(arrival)) - F.unix_micros(F.col("period_start")) - (period_s + grace_s) * 1_000_000
    tick = F.call_function("div", late + (tick_s * 1_000_000 - 1), F.lit(tick_s * 1_000_000))  # corrections are late by a microsecond at least
    version = F.when(F.col("arrival_class") == "reported", 0).otherwise(tick).cast("bigint")
    return classified.where(F.col("arrival_class").isin("reported", "correction")).withColumn("version", version)


def differential(updates: DataFrame, measures: dict[str, Column], keys: list[str] = []) -> DataFrame:
    """One row for each (keys, period, version) that has updates: the measures' sums.

    updates: what ``versioned`` gives. Sums are taken by partial aggregation, so a hot period costs each task one row a version. Null
    measures count as 0.
    """
    return updates.groupBy(*keys, "period_start", "version").agg(*[F.sum(F.coalesce(m, F.lit(0))).alias(k) for k, m in measures.items()])


def retractions(deltas: DataFrame, measures: list[str], keys: list[str] = []) -> DataFrame:
    """The change log: for each version of a period a row with ``sign`` 1 (new aggregate) and, if there was one before or the version isn't
    the first report, a row with ``sign`` -1 and the old aggregate (zeros where the first report was empty).

    The window runs over at most one row a version, and versions end with the cut-off, so no group grows with the data.
    """
    w = Window.partitionBy(*keys, "period_start").orderBy("version")
    state = deltas.select(*keys, "period_start", "version", *[F.sum(m).over(w).alias(m) for m in measures], F.row_number().over(w).alias("__n"),
                          *[F.col(m).alias(f"__d_{m}") for m in measures])
    new = F.struct(F.lit(1).alias("sign"), *[F.col(m).alias(m) for m in measures])
    old = F.struct(F.lit(-1).alias("sign"), *[(F.col(m) - F.col(f"__d_{m}")).cast(dict(state.dtypes)[m]).alias(m) for m in measures])
    return state.select(*keys, "period_start", "version", F.inline(F.when((F.col("__n") == 1) & (F.col("version") == 0), F.array(new)).otherwise(F.array(old, new))))


def corrections(updates: DataFrame, changes: DataFrame, keys: list[str] = []) -> DataFrame:
    """The updates that the change log retracts a reported aggregate for: those of its versions with a negative row.

    The log has two rows a version of a period at most, so it is small beside the updates; a period with any share of the updates
    is one key that AQE splits or meets with a broadcast of the log's measured size.
    """
    on = [*keys, "period_start", "version"]
    retracted = changes.where("sign = -1").select(*[F.col(c).alias(f"__r_{c}") for c in on])
    return updates.join(retracted, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on], "left_semi")


def current(changes: DataFrame, measures: list[str], keys: list[str] = []) -> DataFrame:
    """The corrected aggregates: signed sums of a change log, for any downstream grouping of its periods."""
    return changes.groupBy(*keys, "period_start").agg(*[F.sum(F.col(m) * F.col("sign")).alias(m) for m in measures])
