import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sluice.operators import lateness

H = datetime(2026, 1, 1, 10)


def at(minutes):
    return H + timedelta(minutes=minutes)


def test_classes_at_the_edges(spark):
    rows = [(1, at(0), at(75), "reported"), (2, at(59), at(75) + timedelta(microseconds=1), "correction"), (3, at(0), at(49 * 60), "correction"), (4, at(0), at(49 * 60) + timedelta(microseconds=1), "too_late"), (5, at(60), at(75), "reported"),
            (6, None, at(1), "untimed"), (7, at(0), None, "untimed"), (8, at(30), at(-500), "reported")]
    df = spark.createDataFrame([r[:3] for r in rows], "i int, e timestamp, a timestamp")
    assert {r["i"]: r["arrival_class"] for r in lateness.classify(df, "e", "a").collect()} == {r[0]: r[3] for r in rows}


def test_change_log_against_recount(spark):
    rng = random.Random(1)
    rows = [(k, at(rng.randrange(600)), at(rng.randrange(4000)), rng.choice([1, 5, None])) for k in range(800)] + [(1000 + k, at(5), at(rng.randrange(2000)), 2) for k in range(400)]
    df = spark.createDataFrame(rows, "i int, e timestamp, a timestamp, v bigint").repartition(5)
    x = lateness.classify(df, "e", "a")
    log = lateness.retractions(lateness.differential(lateness.versioned(x, "a"), {"n": F.lit(1).cast("bigint"), "v": F.col("v")}), ["n", "v"])
    want = {(r["period_start"], r["n"], r["v"]) for r in x.where("arrival_class in ('reported', 'correction')").groupBy("period_start").agg(F.count("*").alias("n"), F.sum(F.coalesce("v", F.lit(0))).alias("v")).collect()}
    assert {(r["period_start"], r["n"], r["v"]) for r in lateness.current(log, ["n", "v"]).collect()} == want
    by = {}
    for r in sorted(log.collect(), key=lambda r: (r["period_start"], r["version"], r["sign"])):
        if r["sign"] < 0:  # what is taken back is what stood there
            assert by.pop(r["period_start"], (0, 0)) == (r["n"], r["v"])
        else:
            assert r["period_start"] not in by
            by[r["period_start"]] = (r["n"], r["v"])


def test_corrections_are_the_updates_that_the_log_retracts_for(spark):
    rng = random.Random(4)
    rows = [(k, "s" if k % 3 else None, at(rng.randrange(900)), at(rng.randrange(4500))) for k in range(500)]
    x = lateness.classify(spark.createDataFrame(rows, "i int, s string, e timestamp, a timestamp").repartition(4), "e", "a")
    changed = lateness.versioned(x, "a")
    log = lateness.retractions(lateness.differential(changed, {"n": F.lit(1).cast("bigint")}, ["s"]), ["n"], ["s"])
    got = {r["i"] for r in lateness.corrections(changed, log, ["s"]).collect()}
    assert got == {r["i"] for r in x.where("arrival_class = 'correction'").collect()} and got


def test_empty(spark):
    df = spark.createDataFrame([], "e timestamp, a timestamp")
    assert lateness.retractions(lateness.differential(lateness.versioned(lateness.classify(df, "e", "a"), "a"), {"n": F.lit(1)}), ["n"]).count() == 0


def test_streamed_batches_agree_with_one(spark, tmp_path):
    from sluice.streaming.available_now import VersionedTotals, drain

    rng = random.Random(7)
    rows = [(k, "s" if k % 4 else None, at(rng.randrange(300)), at(rng.randrange(3500)), 1 + k % 4) for k in range(300)]
    df = spark.createDataFrame(rows, "i int, s string, e timestamp, a timestamp, v bigint")
    src = str(tmp_path / "src")
    for k in range(3):
        df.where(F.col("i") % 3 == k).coalesce(1).write.mode("append").parquet(src)
    totals = VersionedTotals(spark, str(tmp_path / "t"), "s", "e", "a", {"n": "1", "v": "v"})
    last = [-1]

    def each(batch, number):
        totals.batch(batch, number)
        totals.batch(batch, number)  # a batch that comes again changes nothing
        last[0] = max(last[0], number)

    drain(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src), each, str(tmp_path / "cp"))
    assert last[0] == 2
    kept = lateness.classify(df, "e", "a", grace_s=0).where("arrival_class in ('reported', 'correction')")
    want = {(r[0], r[1], r[2], r[3]) for r in kept.groupBy("s", "period_start").agg(F.count("*"), F.sum("v")).collect()}
    got = {(r["s"], r["period_start"], r["n"], r["v"]) for r in totals.state(2).collect()}
    assert got == want
    log = spark.read.parquet(str(tmp_path / "t" / "changes"))
    summed = log.groupBy("s", "period_start").agg(F.sum(F.col("n") * F.col("sign")).alias("n"), F.sum(F.col("v") * F.col("sign")).alias("v"))
    assert {(r["s"], r["period_start"], r["n"], r["v"]) for r in summed.collect()} == want


def test_streamed_state_closes_periods_and_takes_old_arrivals(spark, tmp_path):
    from sluice.streaming.available_now import VersionedTotals

    schema = "s string, e timestamp, a timestamp, v bigint"
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    totals = VersionedTotals(spark, str(tmp_path / "t"), "s", "e", "a", {"n": "1", "v": "v"})
    totals.batch(frame(("x", at(0), at(1), 5), (None, at(0), at(1), None)), 0)
    totals.batch(frame(("x", at(6000), at(6001), 1)), 1)  # everything before is closed now
    assert [r["period_start"] for r in totals.open_periods(1).collect()] == [at(6000)]
    totals.batch(frame(("x", at(10), at(20), 7), (None, at(0), at(2), None)), 2)  # arrival times went back
    totals.batch(frame(("x", at(0), at(9000), 1)), 3)  # too late
    assert sorted(((r["s"] or "", r["period_start"], r["n"], r["v"]) for r in totals.state(3).collect())) == [("", at(0), 2, 0), ("x", at(0), 2, 12), ("x", at(6000), 1, 1)]
    log = spark.read.parquet(str(tmp_path / "t" / "changes"))
    assert sorted(tuple(r) for r in log.where("__version = 2 and s = 'x'").select("sign", "n", "v").collect()) == [(-1, 1, 5), (1, 2, 12)]
    assert sorted(tuple(r) for r in log.where("__version = 2 and s is null").select("sign", "n", "v").collect()) == [(-1, 1, 0), (1, 2, 0)]
    assert log.where("__version = 3").count() == 0
