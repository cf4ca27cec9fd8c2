from pyspark.sql import functions as F

from sluice.operators import drift

SCHEMA = "status string, run_id string, source_system string, source map<string,string>, completed_at string, schema array<struct<name:string,type:string>>"


def manifests(spark, runs):
    return spark.createDataFrame([(s, r, "acme", {"b": "2", "a": t}, at, c and [{"name": n, "type": k} for n, k in c]) for s, r, t, at, c in runs], SCHEMA)


def test_types(spark):
    pairs = {"int64": "bigint", "Int64": "bigint", "BIGINT": "bigint", "int32": "int", "decimal128(38, 3)": "decimal(38,3)", "DECIMAL(38,3)": "decimal(38,3)", "decimal128(5)": "decimal(5,0)", "timestamp[us, tz=UTC]": "timestamp", "time64[ns]": "string",
             "large_string": "string", "date32[day]": "date", "bool": "boolean", "list<item: string>": "string", "": "string"}
    df = spark.createDataFrame([(k,) for k in pairs], "k string")
    assert {r["k"]: r["t"] for r in df.select("k", drift.catalog_type(F.col("k")).alias("t")).collect()} == pairs


def test_changes(spark):
    m = manifests(spark, [
        ("SUCCESS", "r1", "t", "2026-01-01T01:00:00+00:00", [("A", "int64"), ("b", "string"), ("c", "decimal128(5, 2)")]),
        ("SUCCESS", "r2", "t", "2026-01-01T03:00:00+02:00", [("c", "DECIMAL(5,2)"), ("a", "BigInt"), ("B", "large_string")]),  # the same, other spelling; r1's instant, so by id
        ("FAILED", "r3", "t", "2026-01-02T01:00:00+00:00", [("z", "int64")]), ("SUCCESS", "r4", "t", "2026-01-02T02:00:00+00:00", None), ("SUCCESS", "r4b", "t", "2026-01-02T02:00:00+00:00", []),
        ("SUCCESS", "r5", "t", "2026-01-04T02:00:00+00:00", [("a", "string"), ("b2", "string"), ("c", "decimal128(5, 2)")]),
        ("SUCCESS", "r5", "t", "2026-01-04T02:00:00+00:00", [("a", "string"), ("b2", "string"), ("c", "decimal128(5, 2)")]),
        ("SUCCESS", "x1", "other", "2026-01-03T02:00:00+00:00", [("q", "string")]), ("SUCCESS", "x2", "other", None, [("w", "string")]),
    ])
    got = {(r["run_id"], r["column_name"], r["change"]) for r in drift.changes(drift.enforce(drift.run_schemas(m))).collect()}
    assert got == {("r5", "a", "retyped"), ("r5", "b", "removed"), ("r5", "b2", "added")}
    assert drift.changes(drift.enforce(drift.run_schemas(m.limit(0)))).count() == 0


def test_changes_against_brute_force(spark):
    import random

    rng, runs = random.Random(8), []
    for k in range(120):
        cols = [(n, rng.choice(["int64", "string"])) for n in rng.sample("abcdef", 4)]
        runs.append(("SUCCESS", f"r{k:03}", rng.choice("xy"), f"2026-01-{rng.randrange(1, 9):02}T{rng.randrange(24):02}:00:00+00:00", cols))
    want = set()
    for t in "xy":
        own = sorted((r for r in runs if r[2] == t), key=lambda r: (r[3], r[1]))
        for a, b in zip(own, own[1:]):
            old, new = dict(a[4]), dict(b[4])
            want |= {(b[1], c) for c in old.keys() | new.keys() if old.get(c) != new.get(c)}
    assert {(r["run_id"], r["column_name"]) for r in drift.changes(drift.enforce(drift.run_schemas(manifests(spark, runs)))).collect()} == want


RECORDS = [(1, '{"ID": 7, "amount": 12.345, "note": "x", "NEW": [1, {"a": 2.50}]}'), (2, '{"id": "abc", "amount": 1e2, "when": "2026-01-02 03:04:05"}'), (3, "broken"), (4, None), (5, "{}"), (6, '{"id": 9223372036854775808, "amount": 99999999999.99}')]


def test_rescue_promote_replay(spark):
    import json

    df = spark.createDataFrame(RECORDS, "n int, rec string")
    target = {"id": "bigint", "amount": "decimal(10,3)", "note": "string"}
    got = {r["n"]: r for r in drift.ingest(df, "rec", target).collect()}
    assert (got[1]["id"], str(got[1]["amount"]), got[1]["note"]) == (7, "12.345", "x") and json.loads(got[1]["_rescued"]) == {"NEW": [1, {"a": 2.5}]}
    assert got[2]["id"] is None and json.loads(got[2]["_rescued"]) == {"id": "abc", "when": "2026-01-02 03:04:05"} and int(got[2]["amount"]) == 100
    assert json.loads(got[3]["_rescued"]) == {"_record": "broken"} and got[4]["_rescued"] is None and got[5]["_rescued"] is None
    assert json.loads(got[6]["_rescued"]) == {"id": 9223372036854775808, "amount": 99999999999.99}
    wider = drift.promote(target, {"WHEN": "timestamp_ntz", "new": "string", "ID": "decimal(38,0)"})
    again = {r["n"]: r for r in drift.replay(drift.ingest(df, "rec", target), wider).collect()}
    assert str(again[2]["WHEN"]) == "2026-01-02 03:04:05" and json.loads(again[2]["_rescued"]) == {"id": "abc"} and int(again[6]["id"]) == 9223372036854775808 and json.loads(again[1]["new"]) == [1, {"a": 2.5}]
    assert drift.ingest(df.limit(0), "rec", target).count() == 0


def test_names_twice_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, '{"A": 1, "a": 2}', "old")], "n int, rec string, a string")
    r = drift.ingest(df, "rec", {"a": "bigint"}).collect()[0]
    assert r["a"] == 2 and r["_rescued"] == '{"A":1}'
    odd = spark.createDataFrame([(1, '{"A": 1, "A": 2}', "old")], "n int, rec string, _RESCUED string")
    assert drift.ingest(odd, "rec", {"a": "bigint"}).collect()[0].asDict() == {"n": 1, "a": None, "_rescued": '{"_record":"{\\"A\\": 1, \\"A\\": 2}"}'}


HELD = [
    ("1.1234567890123456789", "decimal(38,19)", "1.1234567890123456789"), ("1.120000000000000000004", "decimal(10,2)", None), ("1.12345678901234567890", "decimal(38,18)", None), ("1.1200", "decimal(10,2)", "1.12"),
    ("123456789012345678901234567890", "decimal(38,0)", "123456789012345678901234567890"), ("1" + "0" * 38, "decimal(38,0)", None), ("9" * 38, "decimal(38,0)", "9" * 38), ("-0.5", "decimal(3,1)", "-0.5"), ("-0.00", "decimal(3,1)", "0.0"),
    ("12.5e1", "decimal(3,0)", "125"), ("1e-2", "decimal(4,2)", "0.01"), ("1e5000", "decimal(38,0)", None), ("100", "decimal(2,0)", None), ("007", "decimal(3,2)", "7.00"), ("abc", "decimal(3,2)", None), ("", "decimal(3,2)", None), (".5", "decimal(3,2)", None),
    ("5.0", "int", None), ("2147483648", "int", None), ("-7", "tinyint", "-7"), ("128", "tinyint", None), ("1e400", "double", None), ("NaN", "double", None), ("1e39", "float", None), ("2.5", "double", "2.5"),
    ("2026-01-02", "date", "2026-01-02"), ("2026-01-02 03:04", "date", None), ("2026-02-30", "date", None), ("2026-01-02 03:04:05.123456", "timestamp_ntz", "2026-01-02 03:04:05.123456"), ("2026-01-02 03:04:05.1234567", "timestamp_ntz", None),
    ("2026-01-02T03:04:05Z", "timestamp_ntz", None), ("2026-01-02T03:04:05Z", "timestamp", "2026-01-02T03:04:05Z"), ("TRUE", "boolean", "true"), ("1", "boolean", None), (" x ", "string", " x "), ("x", "struct<>", None), (None, "string", None),
]


def test_what_a_type_holds(spark):
    df = spark.createDataFrame([(i, v, k) for i, (v, k, _) in enumerate(HELD)], "i int, v string, k string")
    got = {r["i"]: r["h"] for r in df.select("i", drift.held(F.col("v"), F.col("k")).alias("h")).collect()}
    assert [got[i] for i in range(len(HELD))] == [h for _, _, h in HELD]


def test_decimals_against_python(spark):
    import random
    from decimal import Decimal

    rng = random.Random(3)
    rows = []
    for i in range(600):
        text = rng.choice(["", "-"]) + str(rng.randrange(10 ** rng.randrange(1, 30))) + rng.choice(["", "." + "".join(rng.choice("0012345") for _ in range(rng.randrange(1, 22)))]) + rng.choice(["", "", f"e{rng.randrange(-9, 10)}"])
        p = rng.randrange(1, 39)
        rows.append((i, text, p, rng.randrange(0, p + 1)))
    got = {r["i"]: r["h"] for r in spark.createDataFrame(rows, "i int, v string, p int, s int").select("i", drift.held(F.col("v"), F.concat(F.lit("decimal("), "p", F.lit(","), "s", F.lit(")"))).alias("h")).collect()}
    for i, text, p, s in rows:
        sign, digits, exponent = Decimal(text).as_tuple()
        core = "".join(map(str, digits)).lstrip("0").rstrip("0")
        scale = -exponent - (len("".join(map(str, digits))) - len("".join(map(str, digits)).rstrip("0"))) if core else 0
        fits = scale <= s and len(core) - scale <= p - s
        assert (got[i] is not None) == fits, (text, p, s, got[i])
        assert not fits or (Decimal(got[i]) == Decimal(text) and len(got[i].partition(".")[2]) == s)


def test_numbers_beyond_all_types_keep_their_digits(spark):
    import json

    long, far = "1." + "1234567890" * 5, "1.23456789012345678901e5"
    df = spark.createDataFrame([(1, f'{{"a": {long}, "b": 1.50, "c": [{long}]}}'), (2, f'{{"a": {far}}}'), (3, f'{{"A": "1", "q": {long}, "a": {far}}}')], "n int, rec string")
    got = {r["n"]: r for r in drift.ingest(df, "rec", {"a": "decimal(38,19)", "b": "decimal(4,2)"}).collect()}
    assert got[1]["a"] is None and str(got[1]["b"]) == "1.50" and long in json.loads(got[1]["_rescued"])["_record"]
    assert got[2]["a"] is None and far in json.loads(got[2]["_rescued"])["_record"]
    assert long in got[3]["_rescued"] and json.loads(got[3]["_rescued"])["A"] == "1"


def test_replay_under_a_narrower_type_loses_nothing(spark):
    import json

    df = spark.createDataFrame([(1, '{"id": 5000000000, "x": 1.25}'), (2, '{"id": 7, "x": 1.5}')], "n int, rec string")
    old = drift.ingest(df, "rec", {"id": "bigint", "x": "decimal(5,2)"})
    got = {r["n"]: r for r in drift.replay(old, {"id": "int", "x": "decimal(5,1)"}).collect()}
    assert (got[2]["id"], str(got[2]["x"]), got[2]["_rescued"]) == (7, "1.5", None)
    assert got[1]["id"] is None and got[1]["x"] is None and json.loads(got[1]["_rescued"]) == {"id": 5000000000, "x": 1.25}
    back = {r["n"]: r for r in drift.replay(drift.replay(old, {"id": "int", "x": "decimal(5,1)"}), {"id": "bigint", "x": "decimal(5,2)"}).collect()}
    assert back[1]["id"] == 5000000000 and str(back[1]["x"]) == "1.25" and back[1]["_rescued"] is None


def test_ingesting_runs(spark):
    m = manifests(spark, [
        ("SUCCESS", "r1", "t", "2026-01-01T01:00:00+00:00", [("id", "int32"), ("n", "string")]), ("SUCCESS", "r2", "t", "2026-01-02T01:00:00+00:00", [("id", "int64"), ("extra", "decimal128(5, 2)")]),
    ])
    rows = [("r1", 1, '{"ID": 1, "n": "x"}'), ("r2", 1, '{"id": 3000000000, "extra": 1.25, "N": null}'), ("r2", 2, '{"id": "q", "Id": 4, "extra": 1.255}'), ("r2", 3, "broken"), ("gone", 1, '{"id": 1}'), ("r1", 2, None), ("r1", 3, "{}")]
    got = drift.ingest_runs(spark.createDataFrame(rows, "run_id string, row_no int, record_json string"), drift.enforce(drift.run_schemas(m))).collect()
    assert {(r["run_id"], r["row_no"], r["column_name"], r["outcome"], r["value"], r["rescued"]) for r in got} == {
        ("r1", 1, "id", "typed", "1", None), ("r1", 1, "n", "unknown", None, '{"n":"x"}'), ("r2", 1, "id", "replayed", "3000000000", None), ("r2", 1, "extra", "replayed", "1.25", None),
        ("r2", 2, "id", "uncastable", None, '{"id":"q"}'), ("r2", 2, "id", "repeated", None, '{"Id":4}'), ("r2", 2, "extra", "uncastable", None, '{"extra":1.255}'), ("r2", 3, "_record", "unknown", None, '{"_record":"broken"}'), ("gone", 1, "id", "unknown", None, '{"id":1}'),
    }
