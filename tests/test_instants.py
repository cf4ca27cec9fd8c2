import random
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from sluice.functions.instants import days_from_civil, normalise


def us(*a, offset=0):
    return int((datetime(*a, tzinfo=UTC) - timedelta(minutes=offset) - datetime(1970, 1, 1, tzinfo=UTC)) / timedelta(microseconds=1))


CASES = [
    ("2025-09-27T08:40:44Z", None, None, "ok", us(2025, 9, 27, 8, 40, 44)),
    ("  2025-09-27t08:40:44z ", None, None, "ok", us(2025, 9, 27, 8, 40, 44)),
    ("2025-09-27 08:40", "Europe/Berlin", None, "ok", us(2025, 9, 27, 6, 40)),
    ("2025-09-27 08:40", None, None, "no_zone", None),
    ("2025-09-27 08:40", "Mars/Olympus", None, "no_zone", None),
    ("2025-09-27T08:40:44.123456789-04:00", None, None, "ok", us(2025, 9, 27, 8, 40, 44, 123456, offset=-240)),
    ("2025-09-27 08:40:44+0530", None, None, "ok", us(2025, 9, 27, 8, 40, 44, offset=330)),
    ("2025-09-27 08:40:44+01", None, None, "ok", us(2025, 9, 27, 8, 40, 44, offset=60)),
    ("2025-09-27T08:40:44+10:30[Australia/Lord_Howe]", None, None, "ok", us(2025, 9, 27, 8, 40, 44, offset=630)),
    ("2025-09-27T08:40:44[europe/berlin]", None, None, "ok", us(2025, 9, 27, 6, 40, 44)),
    ("2025-11-02 01:50:40 EST", "America/New_York", None, "ok", us(2025, 11, 2, 6, 50, 40)),
    ("2025-11-02 01:50:40", "America/New_York", None, "overlap", None),
    ("2026-03-08 02:30:00", "America/New_York", None, "gap", None),
    ("2025-10-05 02:15:00", "Australia/Lord_Howe", None, "gap", None),
    ("2026-04-05 01:45:00", "Australia/Lord_Howe", None, "overlap", None),
    ("2026-04-05 02:01:00", "Australia/Lord_Howe", None, "ok", us(2026, 4, 5, 2, 1, offset=630)),
    ("09/10/2025 12:24:58 AM", "UTC", True, "ok", us(2025, 9, 10, 0, 24, 58)),
    ("09/10/2025 12:24:58 PM", "UTC", True, "ok", us(2025, 9, 10, 12, 24, 58)),
    ("09/10/2025 12:24:58", "UTC", False, "ok", us(2025, 10, 9, 12, 24, 58)),
    ("09/10/2025 12:24:58", "UTC", None, "day_or_month", None),
    ("29/10/2025 12:24:58", "UTC", None, "ok", us(2025, 10, 29, 12, 24, 58)),
    ("29.10.2025 12:24:58", "UTC", True, "ok", us(2025, 10, 29, 12, 24, 58)),
    ("2025/10/29 12:24:58", "Asia/Tokyo", None, "ok", us(2025, 10, 29, 3, 24, 58)),
    ("Mon, 29 Sep 2025 10:29:25 GMT", None, None, "ok", us(2025, 9, 29, 10, 29, 25)),
    ("20250928T155507Z", None, None, "ok", us(2025, 9, 28, 15, 55, 7)),
    ("1759106041", None, None, "ok", 1759106041_000_000),
    ("1759268760882", None, None, "ok", 1759268760882_000),
    ("1759178013023953", None, None, "ok", 1759178013023953),
    ("1759178013023953123", None, None, "ok", 1759178013023953),
    ("20250102030405", "UTC", None, "ok", us(2025, 1, 2, 3, 4, 5)),
    ("20250102 030405", "Europe/Berlin", None, "ok", us(2025, 1, 2, 2, 4, 5)),
    ("20251302030405", "UTC", None, "invalid", None),
    ("02 Jan 2025 3:04 PM", "UTC", None, "ok", us(2025, 1, 2, 15, 4)),
    ("2nd January 2025 3:04 p.m. EST", None, None, "ok", us(2025, 1, 2, 20, 4)),
    ("Jan 2, 2025 3:04 PM", "UTC", None, "ok", us(2025, 1, 2, 15, 4)),
    ("Thursday, January 2nd, 2025 at 12:04 AM", "UTC", None, "ok", us(2025, 1, 2, 0, 4)),
    ("Thu Jan  2 03:04:05 UTC 2025", None, None, "ok", us(2025, 1, 2, 3, 4, 5)),
    ("Thu Jan  2 03:04:05 2025", None, None, "no_zone", None),
    ("2 Okt 2025 08:00", "UTC", None, "ok", us(2025, 10, 2, 8)), ("2. März 2025 08:00", "UTC", None, "ok", us(2025, 3, 2, 8)), ("14 juin 2025 08:00", "UTC", None, "ok", us(2025, 6, 14, 8)),
    ("14 juil. 2025 08:00", "UTC", None, "ok", us(2025, 7, 14, 8)), ("1 AOÛT 2025 08:00", "UTC", None, "ok", us(2025, 8, 1, 8)), ("3 de enero de 2025 08:00", "UTC", None, "ok", us(2025, 1, 3, 8)),
    ("2 Foo 2025 08:00", "UTC", None, "invalid", None), ("2025-01-02 13:04 PM", "UTC", None, "invalid", None), ("2025-01-02 03:04 PM", "UTC", None, "ok", us(2025, 1, 2, 15, 4)),
    ("17591060411", "UTC", None, "unreadable", None),
    ("0001-01-01T00:00:00Z", None, None, "ok", us(1, 1, 1)), ("9999-12-31T23:59:59Z", None, None, "ok", us(9999, 12, 31, 23, 59, 59)),
    ("2026-13-02T07:00:00+01:00", None, None, "invalid", None),
    ("2025-02-29 07:00:00", "UTC", None, "invalid", None),
    ("2024-02-29 07:00:00", "UTC", None, "ok", us(2024, 2, 29, 7)),
    ("2025-02-28 24:00:00", "UTC", None, "invalid", None),
    ("2025-02-28 23:60:00", "UTC", None, "invalid", None),
    ("0000-00-00T00:00:00Z", None, None, "invalid", None),
    ("25:61:00", "UTC", None, "unreadable", None), ("2026-01-17T", "UTC", None, "unreadable", None), ("", "UTC", None, "unreadable", None), ("pending", "UTC", None, "unreadable", None),
    ("x" * 100_000, "UTC", None, "unreadable", None),
    (None, "UTC", None, "null", None),
]


def test_forms(spark):
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(CASES)], "i int, v string, z string, mf boolean")
    got = {r["i"]: r for r in normalise(df, "v", F.col("z"), F.col("mf")).select("i", "t_status", F.unix_micros("t_instant").alias("us")).collect()}
    for i, (v, z, mf, status, micros) in enumerate(CASES):
        assert (got[i]["t_status"], got[i]["us"]) == (status, micros), (str(v)[:80], z, mf)


def test_nanos(spark):
    r = normalise(spark.createDataFrame([("2025-09-27T08:40:44.123456789Z",), ("1759178013023953123",)], "v string"), "v").collect()
    assert [x["t_nanos"] for x in r] == [789, 123]


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin", "Australia/Lord_Howe", "Asia/Kolkata", "America/Phoenix", "Africa/Casablanca", "Pacific/Apia"])
def test_local_times_against_brute_force(spark, zone):
    """Every local minute that two years of instants show, once, twice or never."""
    rng, z = random.Random(1), ZoneInfo(zone)
    base = datetime(2025, 1, 1)
    local = [base + timedelta(minutes=15 * rng.randrange(2 * 365 * 96)) for _ in range(300)] + [base + timedelta(minutes=15 * k) for d in (66, 67, 88, 89, 94, 95, 277, 278, 298, 299, 305, 306) for k in range(d * 96, d * 96 + 20)]

    def truth(t):
        # Candidates a day around in quarter hours would be slow; offsets around the time are enough.
        offs = {(t.replace(tzinfo=UTC) + timedelta(hours=h)).astimezone(z).utcoffset() for h in range(-30, 31)}
        hits = [u for o in offs if (u := t.replace(tzinfo=UTC) - o).astimezone(z).replace(tzinfo=None) == t]
        return ("ok", hits[0]) if len(hits) == 1 else ("overlap" if hits else "gap", None)

    df = spark.createDataFrame([(i, t.strftime("%Y-%m-%d %H:%M")) for i, t in enumerate(local)], "i int, v string")
    for r in normalise(df, "v", F.lit(zone)).select("i", "t_status", F.unix_micros("t_instant").alias("us")).collect():
        status, at = truth(local[r["i"]])
        assert r["t_status"] == status, local[r["i"]]
        assert at is None or r["us"] == int(at.timestamp()) * 1_000_000


def test_days(spark):
    days = [(y, m, d) for y in (1, 1600, 1899, 1900, 1970, 2000, 2024, 2100, 9999) for m in (1, 2, 3, 12) for d in (1, 28)]
    df = spark.createDataFrame(days, "y int, m int, d int")
    for r in df.select("*", days_from_civil(F.col("y"), F.col("m"), F.col("d")).alias("n")).collect():
        assert r["n"] == (datetime(r["y"], r["m"], r["d"]) - datetime(1970, 1, 1)).days


def test_clashing_names_empty_and_repeats(spark):
    df = spark.createDataFrame([("2025-01-01T00:00:00Z", "a", 1, None), ("2025-01-01T00:00:00Z", "a", 1, None)], "v string, `__v` string, t_status int, `c0` string")
    out = normalise(df, "v")
    assert out.columns == ["v", "__v", "c0", "t_instant", "t_nanos", "t_status"]
    assert [r["t_status"] for r in out.collect()] == ["ok", "ok"]
    assert normalise(df.limit(0), "v").count() == 0


def test_the_zone_table_costs_no_shuffle(spark):
    df = spark.range(100).select(F.lit("2025-01-02 03:04").alias("v"), F.lit("UTC").alias("z"))
    plan = normalise(df, "v", F.col("z"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
