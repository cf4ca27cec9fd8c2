"""The transaction, its failures, bronze, and a property: windows in any order of replay give the same history."""

import gzip
import json
import os
from base64 import b64encode
from datetime import UTC, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.control.config import Bronze, Config, Discovery, Document, Payload, Table, partition_transform
from sluice.control.errors import CheckpointConflictError, ConfigurationError, IngestError, LandingError, SchemaChangeError, SourceError, WatermarkRegressionError
from sluice.control.files import LocalFiles
from sluice.control.manifest import committed_runs, run_folder, sweep_empty
from sluice.control.state import FileCheckpointStore, FileLedger, NullLedger, StateRecord, WatermarkCheckpoint
from sluice.functions.watermarks import codec, regressed, window
from sluice.operators import bronze, diagnostics, landing, merge, silver
from sluice.plans import jobs
from sluice.sources.base import factory, register
from sluice.sources.json_files import JsonFilesSource, hour_folders, stamp
from sluice.sources.relational import RelationalSource

FILES = LocalFiles()
T = Table("orders", "orders", ("id",), "at")


def frame(spark, rows):
    return spark.createDataFrame([(i, datetime.fromisoformat(a) if a else None, n) for i, a, n in rows], "id bigint, at timestamp_ntz, note string")


ROWS = [(1, "2026-01-01T00:00:00.000001", "a"), (2, "2026-01-02T00:00:00", "b"), (3, "2026-01-03T00:00:00", None), (4, None, "no time")]


def land(spark, tmp, rows, table=T, **kw):
    return jobs.run_table(RelationalSource(frame(spark, rows), table), table, "acme_x", f"{tmp}/landing", FileCheckpointStore(FILES, f"{tmp}/state"), **kw)


def config(tmp, table=T, **kw):
    return Config("acme", "x", (table,), f"{tmp}/landing", f"{tmp}/state", bronze=Bronze("b", f"{tmp}/bronze", f"{tmp}/ledger", **kw))


def merged(spark, tmp, table=T):
    return bronze.BronzeTable(spark, FILES, f"{tmp}/bronze", bronze.bronze_name("acme_x", table.name), table.watermark).read()


def test_full_then_incremental_then_nothing(spark, tmp_path):
    r = land(spark, tmp_path, ROWS)
    assert (r.status, r.rows) == ("SUCCESS", 3)
    assert land(spark, tmp_path, ROWS).status == "SKIPPED"
    assert land(spark, tmp_path, [*ROWS, (5, "2026-01-04T00:00:00", "e"), (6, "2026-01-03T00:00:00", "a tie that came late")]).rows == 1
    runs = committed_runs(FILES, f"{tmp_path}/landing", "acme_x", "orders")
    assert sorted(x.manifest.load_type for x in runs) == ["full", "incremental"]
    assert all(len(x.manifest.files) == x.manifest.file_count and all(map(os.path.exists, x.manifest.files)) for x in runs)
    state = FileCheckpointStore(FILES, f"{tmp_path}/state").get("acme_x", "orders")
    assert (state.version, state.checkpoint.value) == (2, "2026-01-04 00:00:00.000000000")


def test_lookback_lands_again_and_merges_once(spark, tmp_path):
    t = Table("orders", "orders", ("id",), "at", 60 * 48)
    for _ in range(3):
        land(spark, tmp_path, ROWS, t)
    for _ in range(2):
        jobs.load_table_runs(spark, config(tmp_path, t), t, f"{tmp_path}/landing", NullLedger())
    assert merged(spark, tmp_path, t).count() == 3


def test_regression_and_empty(spark, tmp_path):
    land(spark, tmp_path, ROWS)
    with pytest.raises(WatermarkRegressionError):
        land(spark, tmp_path, ROWS[:1])
    assert land(spark, tmp_path / "other", [(1, None, "x")]).status == "SKIPPED"
    assert regressed("NUMBER", "9", "10") is False and regressed("NUMBER", "10", "9") and not regressed("TEXT", "b", "a")


@pytest.mark.parametrize("point", ["write", "manifest", "checkpoint"])
def test_a_failure_moves_nothing(spark, tmp_path, monkeypatch, point):
    def boom(*a, **k):
        raise OSError("gone")

    land(spark, tmp_path, ROWS[:1])
    with monkeypatch.context() as m:
        if point == "write":
            m.setattr(landing.LandingRun, "write", boom)
        elif point == "manifest":
            m.setattr(jobs, "commit", boom)
        else:
            m.setattr(FileCheckpointStore, "commit", boom)
        with pytest.raises(OSError):
            land(spark, tmp_path, ROWS)
    assert FileCheckpointStore(FILES, f"{tmp_path}/state").get("acme_x", "orders").version == 1
    assert land(spark, tmp_path, ROWS).rows == 2
    jobs.load_table_runs(spark, config(tmp_path), T, f"{tmp_path}/landing", FileLedger(FILES, f"{tmp_path}/ledger"))
    assert sorted(r["id"] for r in merged(spark, tmp_path).collect()) == [1, 2, 3]


def test_checkpoints_conflict(tmp_path):
    s = FileCheckpointStore(FILES, str(tmp_path))
    c = WatermarkCheckpoint("at", "1", "NUMBER")
    s.commit("k", "t", 0, StateRecord(c))
    with pytest.raises(CheckpointConflictError):
        s.commit("k", "t", 0, StateRecord(c))
    assert s.commit("k", "t", 1, StateRecord(c)).version == 2 and set(s.all("k")) == {"t"} and s.all("none") == {}
    (tmp_path / "k" / "old").mkdir()
    (tmp_path / "k" / "old" / "legacy.json").write_text(json.dumps({"checkpoint": c.to_dict()}))
    assert s.get("k", "old").version == 0 and s.get("k", "old").checkpoint.value == "1"


def test_sweep_and_discovery(spark, tmp_path):
    land(spark, tmp_path, ROWS)
    root = f"{tmp_path}/landing"
    run = committed_runs(FILES, root, "acme_x", "orders")[0]
    empty = run_folder(root, "acme_x", "orders", "2026-01-01", "empty")
    from dataclasses import replace

    from sluice.control.manifest import commit

    commit(FILES, empty, replace(run.manifest, run_id="empty", row_count=0, file_count=0, files=[], schema=None))
    os.makedirs(run_folder(root, "acme_x", "orders", "2026-01-01", "unsealed"))
    assert len(committed_runs(FILES, root, "acme_x", "orders")) == 2
    assert sweep_empty(FILES, root) == [empty] and os.path.exists(empty)
    assert sweep_empty(FILES, root, delete=True) == [empty] and not os.path.exists(empty)
    os.makedirs(f"{run.folder}/../run_id=bad")
    open(f"{run.folder}/../run_id=bad/_manifest.json", "w").write("{")
    with pytest.raises(IngestError):
        committed_runs(FILES, root, "acme_x", "orders")
    for bad in ("a/b", "", ".."):
        with pytest.raises(IngestError):
            run_folder(root, "k", "t", "2026-01-01", bad)


def test_bronze_union_types_and_failures(spark, tmp_path):
    lands = iter(["r1", "r2", "r3"])
    land(spark, tmp_path, ROWS[:1], new_id=lambda: next(lands))
    wider = frame(spark, ROWS).withColumn("extra", F.lit(1))
    store = FileCheckpointStore(FILES, f"{tmp_path}/state")
    jobs.run_table(RelationalSource(wider.drop("note"), T), T, "acme_x", f"{tmp_path}/landing", store, new_id=lambda: next(lands))
    ledger = FileLedger(FILES, f"{tmp_path}/ledger")
    assert [r.status for r in jobs.load_table_runs(spark, config(tmp_path), T, f"{tmp_path}/landing", ledger)] == ["MERGED", "MERGED"]
    rows = {r["id"]: r for r in merged(spark, tmp_path).collect()}
    assert rows[1]["extra"] is None and rows[1]["note"] == "a" and rows[2]["note"] is None and rows[2]["extra"] == 1
    assert [r.status for r in jobs.load_table_runs(spark, config(tmp_path), T, f"{tmp_path}/landing", ledger)] == ["SKIPPED_ALREADY_PROCESSED"] * 2
    later = frame(spark, [(9, "2026-02-01T00:00:00", "z")]).withColumn("extra", F.lit("text now"))
    jobs.run_table(RelationalSource(later, T), T, "acme_x", f"{tmp_path}/landing", store, new_id=lambda: next(lands))
    with pytest.raises(SchemaChangeError):
        jobs.load_table_runs(spark, config(tmp_path), T, f"{tmp_path}/landing", ledger)
    with pytest.raises(IngestError, match="1 failed"):
        jobs.run_bronze_job(spark, config(tmp_path))
    with pytest.raises(IngestError, match="strand"):
        bronze.check_not_stranded(FILES, f"{tmp_path}/bronze", "acme_x", "orders", "none")


def test_recreated_table_ignores_its_ledger(spark, tmp_path):
    land(spark, tmp_path, ROWS)
    ledger = FileLedger(FILES, f"{tmp_path}/ledger")
    jobs.load_table_runs(spark, config(tmp_path), T, f"{tmp_path}/landing", ledger)
    import shutil

    shutil.rmtree(f"{tmp_path}/bronze")
    assert [r.status for r in jobs.load_table_runs(spark, config(tmp_path), T, f"{tmp_path}/landing", ledger)] == ["MERGED"]
    shutil.rmtree(f"{tmp_path}/bronze/acme_x_orders/snapshots")
    with pytest.raises(IngestError, match="without a snapshot"):
        merged(spark, tmp_path)


def test_lineage_pinning_and_drift(spark, tmp_path):
    with pytest.raises(LandingError):
        landing.with_lineage(spark.range(1).withColumn("_INGESTED_AT", F.lit(1)), "r", "t", "s")
    run = landing.LandingRun(FILES, str(tmp_path / "run"), "r", ("s", None, None, "t"), datetime(2026, 1, 1, tzinfo=UTC))
    assert run.write(spark.createDataFrame([(1, 1.5)], "a int, b double")) == 1
    assert run.write(spark.createDataFrame([("2", 7)], "a string, b int")) == 1 and not run.drift
    assert run.write(spark.createDataFrame([("x", 7)], "a string, b int")) == 1 and run.drift and run.recorded_schema() is None
    assert run.row_count == 3 and len(run.parts()) >= 3


def test_exact_cast(spark):
    from pyspark.sql import types as ty

    df = spark.createDataFrame([("1.23",), ("1.234",), ("x",), (None,)], "s string")
    assert [r[0] and str(r[0]) for r in df.select(landing.exact_cast(F.col("s"), ty.DecimalType(10, 2))).collect()] == ["1.23", None, None, None]


def test_exact_casts_between_types(spark):
    from pyspark.sql import types as ty

    cases = [
        ("cast('1.1230000000000000001' as decimal(38,19))", "decimal(38,18)", None), ("cast('1.1230000000000000000' as decimal(38,19))", "decimal(38,3)", "1.123"), ("cast('123456789012345678901234567890' as decimal(38,0))", "decimal(38,3)", "123456789012345678901234567890.000"),
        ("cast(9007199254740993 as bigint)", "double", None), ("cast(7 as bigint)", "double", "7.0"), ("12345.678D", "decimal(38,3)", "12345.678"), ("0.30000000000000004D", "decimal(10,2)", None), ("99999", "tinyint", None),
        ("timestamp_ntz '2026-01-01 05:00:00'", "date", None), ("timestamp_ntz '2026-01-01'", "date", "2026-01-01"), ("'1.2'", "decimal(10,2)", "1.20"), ("'2026-01-01 05:00:00'", "timestamp_ntz", "2026-01-01 05:00:00"), ("'x'", "int", None),
    ]
    for sql, to, want in cases:
        df = spark.range(1).selectExpr(f"{sql} as v")
        got = df.select(landing.exact_cast(F.col("v"), ty._parse_datatype_string(to) if hasattr(ty, "_parse_datatype_string") else to, df.schema["v"].dataType).cast("string")).first()[0]
        assert got == want, (sql, to, got)


def test_merge_keys(spark):
    a = spark.createDataFrame([(1, "x"), (None, "n")], "k int, v string")
    out = merge.insert_unmatched(a, spark.createDataFrame([(1, "y"), (2, "z"), (2, "z"), (None, "n")], "k int, v string"), ["k"])
    assert sorted((r["k"] or 0, r["v"]) for r in out.collect()) == [(0, "n"), (0, "n"), (1, "x"), (2, "z"), (2, "z")]
    for keys in ([], ["nope"]):
        with pytest.raises(IngestError):
            merge.unmatched(a, a, keys)
    assert merge.insert_unmatched(a.limit(0), a, ["k"]).count() == 2


def test_a_database_over_jdbc(spark, tmp_path):
    from sluice.sources.relational import build

    url = f"jdbc:derby:{tmp_path}/db;create=true"
    rows = frame(spark, ROWS).selectExpr("id as `Id`", "at as `AT`", "note as `odd \"name`")
    rows.write.format("jdbc").options(url=url, dbtable='"orders"', driver="org.apache.derby.jdbc.EmbeddedDriver").save()
    t = Table("orders", "orders", ("Id",), "AT")
    source = build(spark, Config("acme", "jdbc", (t,)), t, {"url": url, "driver": "org.apache.derby.jdbc.EmbeddedDriver"}, None)
    assert dict(source.df.dtypes)["AT"] == "timestamp_ntz"
    low, high = WatermarkCheckpoint("AT", "2026-01-01 00:00:00.000001000", "TIMESTAMP_NTZ"), source.current_checkpoint(None)
    got = source.extract(low, high)
    assert high.value == "2026-01-03 00:00:00.000000000" and sorted(r["Id"] for r in got.collect()) == [2, 3]
    assert "PushedFilters: [*IsNotNull(AT)" in got._jdf.queryExecution().executedPlan().toString()


def test_windows_refuse(spark):
    df = spark.range(3)
    with pytest.raises(ConfigurationError):
        window(df, "id", "0", "2", 5)
    with pytest.raises(ConfigurationError):
        codec(spark.createDataFrame([], "d double").schema["d"].dataType)
    assert window(df, "id", "0", "2").count() == 2


def test_pushdown(spark, tmp_path):
    frame(spark, ROWS).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = window(df, "at", "2026-01-01 00:00:00.000000000", "2026-01-02 00:00:00.000000000")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(at" in plan and "LessThanOrEqual(at" in plan


@pytest.mark.parametrize("seed", range(3))
def test_any_replay_gives_the_same_history(spark, tmp_path, seed):
    import random

    rng = random.Random(seed)
    rows = [(k, (datetime(2026, 1, 1) + timedelta(hours=k)).isoformat(), f"n{k}") for k in range(60)]
    t = Table("orders", "orders", ("id",), "at", rng.choice([0, 60, 600]))
    at = 0
    while at < 60:
        at = min(60, at + rng.randrange(5, 30))
        land(spark, tmp_path, rows[:at], t)
        if rng.random() < 0.5:
            jobs.load_table_runs(spark, config(tmp_path, t), t, f"{tmp_path}/landing", rng.choice([NullLedger(), FileLedger(FILES, f"{tmp_path}/ledger")]))
    jobs.load_table_runs(spark, config(tmp_path, t), t, f"{tmp_path}/landing", NullLedger())
    assert sorted(r["id"] for r in merged(spark, tmp_path, t).collect()) == list(range(60))


# --- document feed ---------------------------------------------------------------------------------------------------

AMOUNT = "1234567890.1234567890123456789"
DOCUMENT = Document("cloudevents", "gzip", "auto", Payload("data_base64", "base64", "auto"))


def envelope(i):
    payload = f'{{"order": {{"id": "{i}"}}, "amount": {AMOUNT}}}'
    return {"type": "order", "specversion": "1.0", "source": "till", "id": f"g:{i}", "time": "t", "groupid": "ü", "data_base64": b64encode(gzip.compress(payload.encode())).decode()}


def put(root, path, records, modified):
    p = f"{root}/{path}"
    os.makedirs(os.path.dirname(p), exist_ok=True)
    open(p, "wb").write(records if isinstance(records, bytes) else gzip.compress(json.dumps(records).encode()))
    os.utime(p, (modified.timestamp(), modified.timestamp()))


def feed(spark, root, clock, **discovery):
    t = Table("orders", "", ("_source_record_id",), "_s3_last_modified", 15, prefix="orders", start_at=datetime(2026, 1, 1, tzinfo=UTC), envelope_fields=(("group_id", "groupid"),))
    return t, JsonFilesSource(spark, "b", str(root), t, Discovery(**discovery), DOCUMENT, clock=lambda: clock)


def test_feed_end_to_end(spark, tmp_path):
    root, h = tmp_path / "src", datetime(2026, 1, 1, 5, 30, tzinfo=UTC)
    put(root, "orders/2026/01/01/05/1.json.gz", [envelope(1), envelope(2)], h)
    put(root, "orders/2026/01/01/05/ignored.txt", [envelope(3)], h)
    put(root, "orders/2026/01/01/06/2.json.gz", [envelope(4)], h + timedelta(hours=1))
    store = FileCheckpointStore(FILES, f"{tmp_path}/state")
    t, s = feed(spark, root, h + timedelta(minutes=10))
    r = jobs.run_table(s, t, "acme_s3_json", f"{tmp_path}/landing", store)
    assert (r.status, r.rows) == ("SUCCESS", 2)
    t, s = feed(spark, root, h + timedelta(minutes=20))
    assert jobs.run_table(s, t, "acme_s3_json", f"{tmp_path}/landing", store).rows == 0  # an empty window commits, too
    t, s = feed(spark, root, h + timedelta(hours=2))
    assert jobs.run_table(s, t, "acme_s3_json", f"{tmp_path}/landing", store).rows == 1
    assert store.get("acme_s3_json", "orders").version == 3
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/landing/acme_s3_json/orders").collect()
    one = next(r for r in rows if r["event_id"] == "g:1")
    assert one["payload_json"] == f'{{"order": {{"id": "1"}}, "amount": {AMOUNT}}}' and one["group_id"] == "ü" and one["_s3_key"] == "orders/2026/01/01/05/1.json.gz" and one["_s3_record_index"] == 0
    assert '"groupid":"\\u00fc"' in one["envelope_json"] and len({r["_source_record_id"] for r in rows}) == 3


def test_corrupt_object_names_itself_only(spark, tmp_path):
    h = datetime(2026, 1, 1, 5, 30, tzinfo=UTC)
    put(tmp_path, "orders/2026/01/01/05/bad.json.gz", gzip.compress(b'[{"id": "secret-content"'), h)
    t, s = feed(spark, tmp_path, h + timedelta(minutes=10))
    with pytest.raises(Exception) as e:
        s.extract(None, s.current_checkpoint(None)).collect()
    assert "bad.json.gz" in str(e.value) and "secret-content" not in str(e.value)
    t, s = feed(spark, tmp_path, h + timedelta(minutes=10))
    s.document = Document("cloudevents", "gzip", "auto", DOCUMENT.payload, max_object_bytes=3)
    with pytest.raises(SourceError):
        s.extract(None, s.current_checkpoint(None))


def test_an_object_that_changes_after_its_listing_is_refused(spark, tmp_path):
    h = datetime(2026, 1, 1, 5, 30, tzinfo=UTC)
    put(tmp_path, "orders/2026/01/01/05/a.json.gz", [envelope(1)], h)
    t, s = feed(spark, tmp_path, h + timedelta(minutes=10))
    rows = s.extract(None, s.current_checkpoint(None))
    assert rows.count() == 1
    put(tmp_path, "orders/2026/01/01/05/a.json.gz", [envelope(1), envelope(2)], h + timedelta(minutes=1))
    with pytest.raises(Exception, match="changed since"):
        rows.collect()


SPECS = [("truncate(3, region)",), ("day({checkpoint_column})",), ("truncate(10, id)",), ("bucket(4, id)", "month(at)"), ("note",), ("amount",), ()]


@pytest.mark.parametrize("spec", SPECS)
def test_merging_again_adds_nothing_under_any_spec(spark, tmp_path, spec):
    schema = "id decimal(38,0), at timestamp_ntz, region string, note string, amount double"
    day = lambda d: datetime(2026, 1, d)
    first = spark.createDataFrame([(Decimal(k * 1000), day(k), None if k == 2 else "abcd", "n", float("nan") if k == 3 else 1.0) for k in (2, 3, 10)], schema)
    second = spark.createDataFrame([(Decimal(2000), day(2), "other", "changed", 2.0), (Decimal(10_000), day(10), None, None, None), (Decimal(5000), day(5), None, "n", None)], schema)
    t = bronze.BronzeTable(spark, FILES, str(tmp_path), "t", "at")
    t.ensure([(f.name, "timestamp" if f.name == "at" else f.dataType.simpleString()) for f in first.schema], spec)
    assert t.merge(first, "r1", ["id"]) == 3
    assert (t.merge(second, "r2", ["id"]), t.merge(second, "r3", ["id"]), t.merge(first, "r4", ["id"]), t.merge(second.where("id = 5000"), "r5", ["id"])) == (1, 0, 0, 0)
    assert sorted(int(r["id"]) for r in t.read().collect()) == [2000, 3000, 5000, 10_000]
    nulls = spark.createDataFrame([(None, day(1), None, None, None)], schema)
    assert t.merge(nulls, "r6", ["id"]) == t.merge(nulls, "r7", ["id"]) == 1  # a null in the key matches nothing


def test_pruning_reads_only_runs_in_range(spark, tmp_path):
    t = bronze.BronzeTable(spark, FILES, str(tmp_path), "t", "at")
    t.ensure([("id", "bigint"), ("at", "timestamp"), ("note", "string")], ("day(at)",))
    for k in range(1, 4):
        assert t.merge(frame(spark, [(k, f"2026-01-0{k}T05:00:00", "x")]), f"r{k}", ["id"]) == 1
    ranges = [e["range"] for e in t.snapshot().entries]
    assert [bronze._meets(r, ["date", "2026-01-02", "2026-01-02"]) for r in ranges] == [False, True, False]
    assert bronze._meets(["number", "9", "10"], ["number", "10", "100"]) and not bronze._meets(["number", "5", "9"], ["number", "10", "100"]) and bronze._meets(None, ["text", "a", "b"])
    assert any("__p_day_at=" in f.path for f in FILES.walk(str(tmp_path)))


def test_snapshots_are_deltas(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "FULL", 4)
    t = bronze.BronzeTable(spark, FILES, str(tmp_path), "t", "at")
    t.ensure([("id", "bigint"), ("at", "timestamp"), ("note", "string")], ())
    for k in range(1, 8):
        t.merge(frame(spark, [(k, "2026-01-01T00:00:00", "x")]), f"r{k}", ["id"])
    s = t.snapshot()
    assert s.version == 8 and [e["run_id"] for e in s.entries] == [f"r{k}" for k in range(1, 8)] and t.read().count() == 7
    assert len(json.loads(FILES.read(t._file(8)))["added"]) == 1 and len(json.loads(FILES.read(t._file(5)))["entries"]) == 4
    t.ensure([("id", "bigint"), ("at", "timestamp"), ("note", "string"), ("more", "int")], ())
    assert t.snapshot().version == 9 and len(t.snapshot().entries) == 7 and "more" in t.read().columns


def test_compacting_keeps_the_rows(spark, tmp_path):
    t = bronze.BronzeTable(spark, FILES, str(tmp_path), "t", "at")
    t.ensure([("id", "bigint"), ("at", "timestamp"), ("note", "string")], ("day(at)",))
    for k in range(1, 6):
        t.merge(frame(spark, [(k, f"2026-01-0{k}T05:00:00", "x"), (10 + k, f"2026-01-0{k}T05:00:00", None)]), f"r{k}", ["id"])
    before, old = sorted(map(tuple, t.read().fillna("").collect())), t.snapshot()
    assert t.compact() == 5 and t.compact() == 0 and sorted(map(tuple, t.read().fillna("").collect())) == before
    assert [e["range"] for e in t.snapshot().entries] == [["date", "2026-01-01", "2026-01-05"]] and t.read(old).count() == 10
    assert t.merge(frame(spark, [(3, "2026-01-03T05:00:00", "again"), (99, "2026-01-09T00:00:00", "new")]), "r6", ["id"]) == 1 and t.read().count() == 11


def test_hadoop_files(spark, tmp_path):
    from sluice.control.files import HadoopFiles, files_for

    f, root = HadoopFiles(spark), f"file://{tmp_path}/h"
    assert f.read(f"{root}/a") is None and f.names(root) == [] and list(f.walk(root)) == []
    assert f.create(f"{root}/x/a.json", "ü") and not f.create(f"{root}/x/a.json", "other") and f.read(f"{root}/x/a.json") == "ü" and f.exists(f"{root}/x/a.json")
    assert f.create(f"{root}/b", "1") and f.names(root) == ["b", "x"] and [i.path.rsplit("/h/", 1)[1] for i in f.walk(root)] == ["b", "x/a.json"]
    f.delete(f"{root}/x/a.json")
    assert f.names(root) == ["b"]
    assert type(files_for(spark, "/a", None)) is LocalFiles and type(files_for(spark, "/a", "s3a://b/c")) is HadoopFiles


def test_jobs_over_addresses_keep_the_catalog(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        frame(spark, ROWS).write.parquet(f"{tmp_path}/orders")
        t = Table("orders", f"{tmp_path}/orders", ("id",), "at")
        at = f"file://{tmp_path}"
        c = Config("acme", "parquet", (t,), f"{at}/landing", f"{at}/state", bronze=Bronze("lake", f"{at}/bronze", f"{at}/ledger", ("day(at)",)))
        assert [r.status for r in jobs.run_job(spark, c)] == ["SUCCESS"]
        assert [r.status for r in jobs.run_bronze_job(spark, c)] == ["MERGED"] and spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
        assert spark.table("lake.acme_parquet_orders_landing").count() == 3
        from sluice.control.catalog import FileCatalog
        from sluice.control.files import HadoopFiles

        e = FileCatalog(HadoopFiles(spark), f"{at}/bronze/_catalog").get("acme_parquet_orders")
        assert dict(e.columns)["id"] == "bigint" and e.metadata_location.endswith("snapshots/v2.json")
        os.remove(e.metadata_location.removeprefix("file:"))
        with pytest.raises(IngestError, match="gone"):
            jobs.run_bronze_job(spark, c)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.sql("DROP DATABASE IF EXISTS lake CASCADE")


def test_windows_and_caps(spark, tmp_path):
    h = datetime(2026, 1, 1, 5, tzinfo=UTC)
    for k, m in enumerate((h, h + timedelta(minutes=1), h + timedelta(minutes=2))):
        put(tmp_path, f"orders/2026/01/01/05/{k}.json.gz", [envelope(k)], m)
    t, s = feed(spark, tmp_path, h)
    at = lambda m: WatermarkCheckpoint("_s3_last_modified", stamp(h + timedelta(minutes=m)))
    assert [os.path.basename(f["path"])[0] for f in s.objects(at(0), at(1)).collect()] == ["1"]
    assert s.objects(None, at(2)).count() == 3 and s.objects(at(2), at(1)).collect() == []
    t, s = feed(spark, tmp_path, datetime(2026, 1, 3, tzinfo=UTC), max_window_hours=24)
    c, seen = None, []
    while True:
        c = s.current_checkpoint(c)
        seen.append(c.value)
        if s.caught_up(c):
            break
    assert len(seen) == 2 and seen[0] == "2026-01-02 00:00:00.000000" and seen[1] == "2026-01-02 23:58:00.000000"
    t, s = feed(spark, tmp_path, h + timedelta(hours=1), type="full_prefix")
    put(tmp_path, "orders/top.json.gz", [envelope(9)], h)
    assert sorted(r["key"] for r in s.objects(None, at(5)).collect()) == [f"orders/2026/01/01/05/{k}.json.gz" for k in range(3)] + ["orders/top.json.gz"]


def test_hour_folders_over_daylight_saving():
    ny = Discovery(timezone="America/New_York", lookahead_hours=0)
    back = hour_folders(ny, datetime(2025, 11, 2, 4, tzinfo=UTC), datetime(2025, 11, 2, 8, tzinfo=UTC))
    assert back == ["2025/11/02/00", "2025/11/02/01", "2025/11/02/02", "2025/11/02/03"]
    ahead = hour_folders(ny, datetime(2026, 3, 8, 6, tzinfo=UTC), datetime(2026, 3, 8, 8, tzinfo=UTC))
    assert ahead == ["2026/03/08/01", "2026/03/08/03", "2026/03/08/04"]
    half = hour_folders(Discovery(timezone="Asia/Kolkata", lookahead_hours=0), datetime(2026, 1, 1, 0, 10, tzinfo=UTC), datetime(2026, 1, 1, 1, 40, tzinfo=UTC))
    assert half[-1] == "2026/01/01/07"


# --- small things ----------------------------------------------------------------------------------------------------


def test_registry_and_transforms():
    with pytest.raises(ConfigurationError):
        factory("nothing")
    register("odd", "json")
    with pytest.raises(ConfigurationError):
        factory("odd")
    assert partition_transform("bucket(16, id)") == ("bucket", 16, "id") and partition_transform("month({checkpoint_column})", "at") == ("month", None, "at")
    for bad in ("bucket(id)", "month()", "bucket(0, id)", "drop table", "month({other})"):
        with pytest.raises(ConfigurationError):
            partition_transform(bad)


def test_diagnostics(spark):
    assert [diagnostics.snake_case(n) for n in ("businessDate", "HTTPCode", "a-b", "9x", "")] == ["business_date", "h_t_t_p_code", "a_b", "f_9x", "f_"]
    import zlib

    df = spark.createDataFrame([(gzip.compress(b"x"),), (zlib.compress(b"x"),), (b"{}",), (b"",)], "b binary")
    assert [r[0] for r in df.select(diagnostics.sniff(F.col("b"))).collect()] == ["gzip", "zlib", "none", "none"]
    census = diagnostics.key_census(spark.createDataFrame([('{"groupId":"a","n":1}',), ('{"groupId":"b","o":{}}',), (None,)], "j string"), "j")
    assert diagnostics.feed_settings(census, 0.9) == {"group_id": "groupId"}


def test_silver(spark):
    df = spark.createDataFrame([("a", "9", 1), ("a", "10", 2), ("b", "x", 3), (None, "1", 4), ("c", "1", 5), ("c", "1", 6)], "k string, v string, t int")
    assert sorted((r["k"], r["t"]) for r in silver.latest_version(df, F.col("k"), F.col("v"), "t").collect()) == [("a", 2), ("c", 6)]
    j = spark.createDataFrame([('{"a":1234567890.1234567890123456789,"b":{"c":1}}',), ("bad",), (None,)], "j string")
    assert [str(r[0]) for r in j.select(silver.scalar(F.col("j"), "$.a", "decimal(38,19)")).collect()] == [AMOUNT, "None", "None"]


def test_timeout(spark):
    from sluice.control.errors import StatementError

    assert jobs.with_timeout(spark, 60, lambda: spark.range(5).count()) == 5
    slow = F.udf(lambda x: __import__("time").sleep(20) or x, "bigint")
    with pytest.raises(StatementError, match="more than"):
        jobs.with_timeout(spark, 1.5, lambda: spark.range(4).select(slow("id")).collect())


def test_catalog(tmp_path):
    from sluice.control.catalog import Entry, FileCatalog

    c = FileCatalog(FILES, str(tmp_path))
    assert c.get("t") is None and c.columns("t") is None and not c.override("t", {"a": "int"})
    e = c.put(Entry("T", (("A", "bigint"), ("b", "string")), (("day", "date"),), str(tmp_path / "gone")))
    assert c.columns("t") == {"a": "bigint", "b": "string", "day": "date"}
    assert c.override("t", {"A": "int", "none": "x"}) and not c.override("t", {"a": "int"}) and c.get("t").metadata_location == e.metadata_location
    with pytest.raises(CheckpointConflictError):
        c.put(e)
    with pytest.raises(IngestError):
        c.check_metadata("t")
    c.check_metadata("other")


def test_contract_and_census(spark, tmp_path):
    from sluice.plans import tools

    h = datetime(2026, 1, 1, 5, tzinfo=UTC)
    for k, m in enumerate((h + timedelta(minutes=5), h + timedelta(minutes=70), h + timedelta(hours=9))):
        put(tmp_path, f"2026/01/01/05/{k}.json.gz", [envelope(k)], m)
    objects = tools.folder_objects(spark, str(tmp_path), Discovery(), datetime(2026, 1, 1, tzinfo=UTC), datetime(2026, 1, 2, tzinfo=UTC))
    r = tools.contract(objects, int(h.timestamp()))
    assert (r["found"], r["missed"], r["holds"], r["early"]) == (2, 1, False, 0) and r["lateness"] == {"in-hour": 1, "<=15m late": 1, "<=24h late": 1}
    assert tools.contract(objects, int(h.timestamp()), lookback_s=r["lookback_minutes_needed"] * 60)["holds"]
    df = spark.createDataFrame([(json.dumps(envelope(1)), '{"order":{"id":"1"}}'), (json.dumps({"id": "g:2", "data": {}}), '{"order":{"id":3}}'), ("{}", None)], "e string, p string")
    got = {(r["measure"], r["value"]): r["records"] for r in diagnostics.census(df, "e", "p", ["$.order.id"], ["$.version"]).collect()}
    assert got == {("carrier", "data_base64"): 1, ("carrier", "data"): 1, ("carrier", "neither"): 1, ("codec", "gzip"): 1, ("type", "object"): 2, ("type", "none"): 1, ("wrapper", "$.order"): 2, ("key", "order"): 2, ("id_path", "$.order.id"): 2,
                   ("id_type", "$.order.id string"): 1, ("id_type", "$.order.id bigint"): 1, ("id_match", "$.order.id =="): 1, ("id_match", "$.order.id !="): 1}
    census = diagnostics.census(df.limit(1), "e", "p", ["$.order.id"], [])
    block, doubts = diagnostics.document_settings(census)
    assert block == {"preset": "cloudevents", "compression": "gzip", "records": "auto", "payload": {"path": "data_base64", "encoding": "base64", "compression": "gzip", "format": "json"}} and doubts == []
    assert len(diagnostics.document_settings(diagnostics.census(df, "e", "p", [], []))[1]) == 2
    objs = spark.createDataFrame([(k // 5, k) for k in range(20)], "folder int, m int")
    assert sorted(r["m"] for r in diagnostics.sample_newest(objs, "folder", "m", 2, 4).collect()) == [13, 14, 18, 19]


def test_public_api():
    import sluice

    assert sluice.run_table is jobs.run_table
    with pytest.raises(AttributeError):
        sluice.nothing


def test_landing_as_a_table(spark, tmp_path):
    ids = iter(["r1", "r2"])
    land(spark, tmp_path, ROWS[:1], new_id=lambda: next(ids))
    runs = committed_runs(FILES, f"{tmp_path}/landing", "acme_x", "orders")
    bronze.register_landing(spark, "landing_orders", f"{tmp_path}/landing/acme_x/orders", bronze.union_schemas(runs), runs)
    land(spark, tmp_path, ROWS, new_id=lambda: next(ids))
    assert spark.table("landing_orders").count() == 1  # only registered runs show
    runs = committed_runs(FILES, f"{tmp_path}/landing", "acme_x", "orders")
    for _ in range(2):
        bronze.register_landing(spark, "landing_orders", f"{tmp_path}/landing/acme_x/orders", [*bronze.union_schemas(runs), ("Extra", "int")], runs)
    got = spark.table("landing_orders")
    assert got.count() == 3 and {r["run_id"] for r in got.collect()} == {"r1", "r2"} and dict(got.dtypes)["ingest_date"] == "string" and "extra" in got.columns
    spark.sql("DROP TABLE landing_orders")


def test_first_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as t")
    plan = silver.first_by(df, ["k"], [F.col("t").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")
