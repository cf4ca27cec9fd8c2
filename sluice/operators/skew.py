"""Joins that one hot key can't hold up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it has more than one row in so many, so there are never more hot keys than this.
HOT = 200
#: Pieces into which the rows of a hot key are cut.
PIECES = 64
#: Rows of a table that may be broadcast whole, once they are counted.
SMALL = 10_000


def lookup(left: DataFrame, right: DataFrame, keys: list[str], spread: str, base: DataFrame | None = None, rows: int | None = None, small: int = SMALL) -> DataFrame:
    """``left`` with the columns of ``right``, which has one row a key; null where it has none. A left join.

    If ``right`` turns out to have ``small`` rows at most, which are counted here, it is broadcast and nothing is shuffled. Otherwise, or with small=0 at
    once, both sides are shuffled: rows of a hot key are cut into PIECES by a hash of the column ``spread``, and its row of ``right`` is repeated for each piece, so a key may have any
    share of all rows. Rows with a null in a key match nothing and are spread evenly. Hot keys, HOT at most by their definition, are
    broadcast. base: a frame with the same keys as ``left`` that is cheaper to count, rows: its number of
    rows, where known. Columns other than the keys must differ between the sides.
    """
    rest = [c for c in right.columns if c not in keys]
    if small and right.limit(small + 1).count() <= small:
        few = F.broadcast(right.select(*[F.col(f"`{k}`").alias(f"__r_{i}") for i, k in enumerate(keys)], *[F.col(f"`{c}`") for c in rest]))
        return left.join(few, [F.col(f"`{k}`") == F.col(f"__r_{i}") for i, k in enumerate(keys)], "left").select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"`{c}`") for c in rest])
    base = left if base is None else base
    rows = base.count() if rows is None else rows
    known = [F.col(f"`{k}`").isNotNull() for k in keys]
    counts = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") * HOT > rows)
    for k in known:
        counts = counts.where(k)
    hot = F.broadcast(counts.select(*[F.col(f"`{k}`").alias(f"__h_{i}") for i, k in enumerate(keys)], F.lit(True).alias("__hot")))
    same = [F.col(f"`{k}`") == F.col(f"__h_{i}") for i, k in enumerate(keys)]
    piece = F.pmod(F.xxhash64(F.col(f"`{spread}`")), F.lit(PIECES)).cast("int")
    missing = ~known[0]
    for k in known[1:]:
        missing = missing | ~k
    salted = left.join(hot, same, "left").select(*[F.col(f"`{c}`") for c in left.columns], F.when(missing, -1 - F.pmod(F.xxhash64(F.col(f"`{spread}`")), F.lit(1 << 20)).cast("int")).when(F.col("__hot"), piece).otherwise(0).alias("__piece"))
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(PIECES - 1))).otherwise(F.array(F.lit(0)))
    spread_out = right.join(hot, same, "left").select(*[F.col(f"`{k}`").alias(f"__r_{i}") for i, k in enumerate(keys)], *[F.col(f"`{c}`") for c in rest], F.explode(copies).alias("__r_piece"))
    on = [F.col(f"`{k}`") == F.col(f"__r_{i}") for i, k in enumerate(keys)] + [F.col("__piece") == F.col("__r_piece")]
    return salted.join(spread_out, on, "left").select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"`{c}`") for c in rest])
