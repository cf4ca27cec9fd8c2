"""Exactly one copy of each message: exact quotient hash tables.

Identifiers are packed to fixed width (zero-padded bytes and their length), permuted by an invertible mixing of the first
word with a hash of the rest, and split into a quotient (the leading bits, which choose the shard and the slot order) and
the complete remainder (all other bits and all other words). Because the permutation is invertible and remainders are
stored whole, equal entries are equal identifiers: there are no false matches.

Plan: one narrow scan; each input partition, sorted by order, inserts its rows into a local table, so that of any message
at most one row a partition still has to find its global place; those rows are shuffled by shard and inserted into the
shard's table. Rows already known to be copies travel with no identifier and spread evenly, or stay behind where only first copies are
asked for. One identifier may hold any share of all rows: no task gets more than one row of it from each input partition.

A task goes through its shards one after the other and holds one table at a time. With 2^20 shards a table has a millionth
of all identifiers, some 80 bytes each, however many shuffle partitions there are; a local table is bounded by an input partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARD_BITS = 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """An invertible mixing of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def pack(identifiers: pa.Array) -> np.ndarray:
    """Binary identifiers as rows of 64-bit words: the length, then the bytes padded with zeros to the batch's width."""
    arr = identifiers.cast(pa.large_binary())
    n = len(arr)
    ends = np.frombuffer(arr.buffers()[1], np.int64, n + 1, arr.offset * 8)
    data = np.frombuffer(arr.buffers()[2] or b"", np.uint8)
    size = np.diff(ends)
    words = max(1, -(-int(size.max(initial=0)) // 8))
    out = np.zeros((n, words * 8), np.uint8)
    row = np.repeat(np.arange(n), size)
    out[row, np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)] = data[ends[0] : ends[-1]]
    return np.concatenate([size.astype(np.uint64)[:, None], out.view(np.uint64)], axis=1)


def permute(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word permuted, the other words). Trailing zero words don't matter, so batches of any width agree."""
    rest = words[:, [0, *range(2, words.shape[1])]]
    h = np.zeros(len(words), np.uint64)
    for k in range(rest.shape[1] - 1, -1, -1):
        w = rest[:, k]
        h = np.where((h == 0) & (w == 0), h, _mix((h ^ w) * _M2 + np.uint64(k + 1)))
    return _mix(words[:, 1] ^ h), rest


class QuotientTable:
    """Runs of entries in quotient order, merged when a run is no longer than the one after it."""

    def __init__(self) -> None:
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    @staticmethod
    def _fit(a: np.ndarray, width: int) -> np.ndarray:
        return a if a.shape[1] >= width else np.concatenate([a, np.zeros((len(a), width - a.shape[1]), np.uint64)], axis=1)

    @classmethod
    def _inside(cls, run: tuple[np.ndarray, np.ndarray], p: np.ndarray, rest: np.ndarray) -> np.ndarray:
        keys, remainders = run
        width = max(remainders.shape[1], rest.shape[1])
        remainders, rest = cls._fit(remainders, width), cls._fit(rest, width)
        found = np.zeros(len(p), bool)
        at = np.searchsorted(keys, p)
        left = np.flatnonzero((at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == p))
        while len(left):
            same = (remainders[at[left]] == rest[left]).all(axis=1)
            found[left[same]] = True
            left = left[~same]
            at[left] += 1
            left = left[at[left] < len(keys)]
            left = left[keys[at[left]] == p[left]]
        return found

    def insert(self, p: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """For each entry, in order: whether it is new. Each identifier is inserted once."""
        if not len(p):
            return np.zeros(0, bool)
        order = np.lexsort((np.arange(len(p)), *rest.T[::-1], p))
        sp, sr = p[order], rest[order]
        lead = np.ones(len(p), bool)
        lead[1:] = (sp[1:] != sp[:-1]) | (sr[1:] != sr[:-1]).any(axis=1)
        lead_at = np.flatnonzero(lead)
        fresh = np.ones(len(lead_at), bool)
        for run in self.runs:
            ask = np.flatnonzero(fresh)
            fresh[ask[self._inside(run, sp[lead_at[ask]], sr[lead_at[ask]])]] = False
        take = lead_at[fresh]
        if len(take):
            self.runs.append((sp[take], sr[take]))
            while len(self.runs) > 1 and len(self.runs[-2][0]) <= 2 * len(self.runs[-1][0]):
                (ap, ar), (bp, br) = self.runs[-2:]
                width = max(ar.shape[1], br.shape[1])
                keys = np.concatenate([ap, bp])
                by = np.argsort(keys, kind="stable")
                self.runs[-2:] = [(keys[by], np.concatenate([self._fit(ar, width), self._fit(br, width)])[by])]
        new = np.zeros(len(p), bool)
        new[order[take]] = True
        return new


def _first_pass(keep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the shard; rows that copy an earlier row of this partition lose their identifier, or are left out unless ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, salt = QuotientTable(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            p, rest = permute(pack(batch.column("__id")))
            new = table.insert(p, rest)
            shard = np.where(new, (p >> np.uint64(64 - SHARD_BITS)).astype(np.int64), (np.arange(len(p)) * 31 + salt) % (1 << SHARD_BITS))
            salt += len(p) * 31
            ids = pa.compute.if_else(pa.array(new), batch.column("__id"), pa.scalar(None, batch.column("__id").type))
            cols = [ids if f.name == "__id" else c for f, c in zip(batch.schema, batch.columns)]
            done = pa.RecordBatch.from_arrays([*cols, pa.array(shard.astype(np.int32))], [*batch.schema.names, "__shard"])
            yield done if keep else done.filter(pa.array(new))

    return run


def _second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces identifier and shard with whether the row is a copy. Rows come shard by shard, by order in each."""
    table, at = QuotientTable(), None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, shards = batch.column("__id"), batch.column("__shard").to_numpy(zero_copy_only=False)
        open_ = np.asarray(ids.is_valid())
        copy = np.ones(batch.num_rows, bool)
        last, entries = shards[-1], None
        if open_.any():
            entries = permute(pack(ids.filter(pa.array(open_))))
            copy[np.flatnonzero(open_)] = ~table.insert(*entries)
        if last != at:  # the shards before are done with; only the last one's entries go on
            table, at = QuotientTable(), last
            if entries:
                mine = shards[open_] == last
                table.insert(entries[0][mine], entries[1][mine])
        names = [n for n in batch.schema.names if n not in ("__id", "__shard")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(copy)], [*names, "__copy"])


def _find(df: DataFrame, identifier: list[Column], order: str, keep: bool) -> tuple[DataFrame, list[str]]:
    """The rows (all, or without those that a partition knows to be copies) as columns c0, c1, ... with ``__copy``; their names."""
    own = df.columns
    # Each part with its length in front, so that no two lists of parts give the same text.
    piece = [F.when(i.isNull(), "-").otherwise(F.concat(F.length(i.cast("string")).cast("string"), F.lit(":"), i.cast("string"))) for i in identifier]
    x = df.select("*", F.concat(*piece).cast("binary").alias("__id"), F.col(f"`{order}`").alias("__order")).toDF(*[f"c{i}" for i in range(len(own))], "__id", "__order")
    fields = [T.StructField(f.name, f.dataType) for f in x.schema]  # all may be null: copies lose their identifier
    first = T.StructType([*fields, T.StructField("__shard", T.IntegerType())])
    last = T.StructType([*(f for f in fields if f.name != "__id"), T.StructField("__copy", T.BooleanType())])
    local = x.sortWithinPartitions("__order").mapInArrow(_first_pass(keep), first)
    return local.repartition("__shard").sortWithinPartitions("__shard", "__order").mapInArrow(_second_pass, last), own


def mark_copies(df: DataFrame, identifier: list[Column], order: str, is_copy: str = "is_copy") -> DataFrame:
    """``df`` with a boolean column that is false for exactly one row of each identifier, the first by ``order``.

    identifier: columns that name a message together, compared exactly as text; null is a value of its own, other than
    ''. order: a column without ties inside an identifier; a null order counts as smallest, and among rows with equal order
    (repeated rows) one arbitrary row is the first. All rows are kept; other columns pass through whatever their names,
    except that a column named ``is_copy`` is replaced. An empty table gives an empty table.
    """
    done, own = _find(df.drop(is_copy), identifier, order, True)
    return done.select(*[F.col(f"c{i}").alias(k) for i, k in enumerate(own)], F.col("__copy").alias(is_copy))


def message_name(source: str = "event_source", event_id: str = "event_id", record_id: str = "_source_record_id") -> list[Column]:
    """What names a landed message: its source and event id, letter case of the id aside; without event id, its record id."""
    has = F.col(event_id).isNotNull()
    return [F.when(has, F.lit("event")).otherwise("record"), F.when(has, F.col(source)), F.when(has, F.lower(event_id)).otherwise(F.col(record_id))]


def first_copies(df: DataFrame, identifier: list[Column], order: str) -> DataFrame:
    """Exactly one row of each identifier, the first by ``order``; see mark_copies for the cases. Copies that stand in one input
    partition with their first aren't shuffled."""
    done, own = _find(df, identifier, order, False)
    return done.where(~F.col("__copy")).select(*[F.col(f"c{i}").alias(k) for i, k in enumerate(own)])
