import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators.quotient import QuotientTable, first_copies, mark_copies, message_name, pack, permute


def test_permutation_is_invertible_and_width_free():
    ids = [b"", b"a", b"a\0", b"\0", b"abcdefgh", b"abcdefgh\0", b"x" * 300] + [random.Random(i).randbytes(i % 40) for i in range(2000)]
    ids = list(dict.fromkeys(ids))
    p, rest = permute(pack(pa.array(ids, pa.binary())))
    assert len({(int(a), r.tobytes()) for a, r in zip(p, rest)}) == len(ids)
    for k in (1, 5, len(ids) // 2):  # alone, in narrower batches: the same words
        q, _ = permute(pack(pa.array(ids[k : k + 1], pa.binary())))
        assert q[0] == p[k]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=12), max_size=30), max_size=8))
def test_table_against_a_set(batches):
    table, seen = QuotientTable(), set()
    for batch in batches:
        got = table.insert(*permute(pack(pa.array(batch, pa.binary())))) if batch else np.zeros(0, bool)
        want = []
        for x in batch:
            want.append(x not in seen)
            seen.add(x)
        assert got.tolist() == want


def test_equal_quotient_words_are_told_apart_by_their_remainders():
    table = QuotientTable()
    p = np.array([7, 7, 7], np.uint64)
    assert table.insert(p, np.array([[1], [2], [1]], np.uint64)).tolist() == [True, True, False]
    assert table.insert(p, np.array([[3], [2], [1]], np.uint64)).tolist() == [True, False, False]


def rows(n, rng):
    return [(k, rng.choice(["s1", "s2", None]), rng.choice(["A", "a", "b", "", None, f"id{k % 7}"]), f"r{rng.randrange(9)}") for k in rng.sample(range(10 * n), n)]


def test_against_brute_force(spark):
    data = rows(500, random.Random(3))
    seen, want = set(), set()
    for no, s, e, r in sorted(data):
        key = ("r", r) if e is None else ("e", s, e.lower())
        if key in seen:
            want.add(no)
        seen.add(key)
    df = spark.createDataFrame(data, "landed_no bigint, event_source string, event_id string, _source_record_id string").repartition(7)
    out = mark_copies(df, message_name(), "landed_no")
    assert {r["landed_no"] for r in out.where("is_copy").collect()} == want
    assert out.count() == 500
    assert first_copies(df, message_name(), "landed_no").count() == 500 - len(want)


def test_one_identifier_in_all_rows_and_repeated_rows(spark):
    df = spark.range(20_000).select(F.lit("k").alias("id"), "id").toDF("k", "no").repartition(8)
    out = mark_copies(df, [F.col("k")], "no")
    assert out.where("not is_copy").collect()[0]["no"] == 0 and out.where("is_copy").count() == 19_999
    twice = spark.createDataFrame([("k", 1), ("k", 1)], "k string, no int")
    assert mark_copies(twice, [F.col("k")], "no").where("not is_copy").count() == 1


def test_nulls_parts_clashes_and_empty(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a", "bc"), (4, "ab", "c"), (5, None, "x")], "no int, `__id` string, is_copy string")
    out = mark_copies(df, [F.col("__id")], "no")
    assert {r["no"] for r in out.where("is_copy").collect()} == {5}
    two = df.withColumnRenamed("is_copy", "c1")
    assert {r["no"] for r in mark_copies(two, [F.col("__id"), F.col("c1")], "no").where("is_copy").collect()} == {5}
    assert mark_copies(df.limit(0), [F.col("__id")], "no").count() == 0
    long = spark.createDataFrame([(1, "x" * 50_000), (2, "x" * 50_000), (3, "x" * 49_999)], "no int, k string")
    assert {r["no"] for r in mark_copies(long, [F.col("k")], "no").where("is_copy").collect()} == {2}


def test_shards_one_after_the_other(monkeypatch, spark):
    from sluice.operators import quotient

    rng = random.Random(9)
    data = [(k, f"id{rng.randrange(900)}") for k in range(3000)]
    first = {}
    for k, i in data:
        first.setdefault(i, k)
    df = spark.createDataFrame(data, "no int, id string").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")  # shards end inside batches, and go on over some
    try:
        for bits in (1, 4, 20):
            monkeypatch.setattr(quotient, "SHARD_BITS", bits)
            assert {r["no"] for r in first_copies(df, [F.col("id")], "no").collect()} == set(first.values())
            assert mark_copies(df, [F.col("id")], "no").where("not is_copy").count() == len(first)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
