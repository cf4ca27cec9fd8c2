"""Queries of the ingestion engine's own operators over the test tables, with their SQL."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.control.config import Bronze, Config, Discovery, Document, Payload, Table
from sluice.control.files import LocalFiles, files_for
from sluice.control.manifest import NAME, Manifest, committed_runs, run_folder, sweep_empty
from sluice.control.state import FileCheckpointStore, FileLedger
from sluice.functions import decode, watermarks
from sluice.operators import bronze, compaction, diagnostics, drift, landing, merge, silver
from sluice.plans import jobs, oracles, problems
from sluice.session import fresh, table
from sluice.sources.json_files import JsonFilesSource, decode_files, list_objects, record_ids, row_bytes, unstamp
from sluice.sources.relational import RelationalSource

D10, D20 = "2024-01-10 00:00:00.000000000", "2024-01-20 00:00:00.000000000"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def high(df: DataFrame, column: str) -> str:
    """The table's own high watermark."""
    return watermarks.high_watermark(df, column).first()[0]


def scratch(spark: SparkSession, label: str) -> tuple[str, LocalFiles]:
    """A private place in the shared folder, and the file operations for it."""
    path = fresh(spark, label).removeprefix("file://")
    return path, files_for(spark, path)


# --- windows ---------------------------------------------------------------------------------------------------------


@query("select * from orders where o_orderdate <= (select max(o_orderdate) from orders)")
def window_full(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "orders")
    return watermarks.window(df, "o_orderdate", None, high(df, "o_orderdate"))


@query("select * from events where ts > timestamp '2024-01-10' and ts <= timestamp '2024-01-20'")
def window_incremental(spark: SparkSession, d: str) -> DataFrame:
    return watermarks.window(events(spark, d), "ts", D10, D20)


@query("select * from events where ts > timestamp '2024-01-10' - interval 720 minute and ts <= timestamp '2024-01-20'")
def window_lookback(spark: SparkSession, d: str) -> DataFrame:
    return watermarks.window(events(spark, d), "ts", D10, D20, 720)


@query("select event_id, case when event_type <> 'error' then ts end as wm from events where case when event_type <> 'error' then ts end <= timestamp '2024-01-20'")
def window_null_watermark(spark: SparkSession, d: str) -> DataFrame:
    df = events(spark, d).select("event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("wm"))
    return watermarks.window(df, "wm", None, D20)


@query("select strftime(max(ts), '%Y-%m-%d %H:%M:%S.%n') as value_text from events")
def high_watermark_text(spark: SparkSession, d: str) -> DataFrame:
    return watermarks.high_watermark(events(spark, d), "ts")


@query("select strftime(max(ts), '%Y-%m-%d %H:%M:%S.%n') || ' Z' as value_text from events")
def high_watermark_zoned(spark: SparkSession, d: str) -> DataFrame:
    """The text of a zoned watermark, in a session whose zone is UTC as jobs have it."""
    return watermarks.high_watermark(events(spark, d).select(F.col("ts").cast("timestamp").alias("ts")), "ts")


@query("""select strftime(max(cast(o_orderdate as date)), '%Y-%m-%d') as date_text, cast(max(o_orderkey) as varchar) as number_text, max(o_orderstatus) as text_text,
  cast(max(cast(o_orderkey as decimal(38, 3))) as varchar) as decimal_text from orders""")
def watermark_codecs(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_orderkey").alias("number"), F.col("o_orderstatus").alias("text"), F.col("o_orderkey").cast("decimal(38,3)").alias("decimal"))
    return o.agg(*[watermarks.codec(o.schema[c].dataType).to_text(F.max(c)).alias(f"{c}_text") for c in o.columns])


@query("""with c as (select distinct run_id, checkpoint.previous as p, checkpoint.high as h, row_count as n, file_count as m from run_manifests),
  pairs as (select run_id, 'onward' as pair, 'TIMESTAMP_NTZ' as value_type, p as previous, h as current from c union all select run_id, 'back', 'TIMESTAMP_NTZ', h, p from c union all select run_id, 'number', 'NUMBER', cast(n as varchar), cast(m as varchar) from c
    union all select run_id, 'text', 'TEXT', h, p from c)
  select run_id, pair, case when previous is null or current is null or value_type = 'TEXT' then false when value_type = 'NUMBER' then cast(current as bigint) < cast(previous as bigint) else current < previous end as regressed from pairs""")
def regression_guard(spark: SparkSession, d: str) -> DataFrame:
    """The guard over every committed checkpoint, forwards and backwards, and over numbers and texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            none = lambda v: None if pd.isna(v) else str(v)
            rows = []
            for r in pdf.itertuples():
                p, h = none(r.p), none(r.h)
                for pair, kind, a, b in (("onward", "TIMESTAMP_NTZ", p, h), ("back", "TIMESTAMP_NTZ", h, p), ("number", "NUMBER", none(r.n), none(r.m)), ("text", "TEXT", h, p)):
                    rows.append((r.run_id, pair, watermarks.regressed(kind, a, b)))
            yield pd.DataFrame(rows, columns=["run_id", "pair", "regressed"])

    c = table(spark, d, "run_manifests").select("run_id", F.col("checkpoint.previous").alias("p"), F.col("checkpoint.high").alias("h"), F.col("row_count").cast("string").alias("n"), F.col("file_count").cast("string").alias("m")).distinct()
    return c.mapInPandas(run, "run_id string, pair string, regressed boolean")


@query("""with b as (select date_trunc('day', min(ts)) as lo, max(ts) as hi from events) select cast(n as bigint) as window_no, least(lo + to_days(cast(n as int)), hi) as high from b, range(1, 100000) t(n) where lo + to_days(cast(n as int) - 1) < hi""")
def capped_windows(spark: SparkSession, d: str) -> DataFrame:
    """The bounds at which a drain loop with a cap of 24 hours commits over the events' span, computed as the loop does."""
    low, last = events(spark, d).agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz"), F.max("ts")).first()
    t = Table("t", "", ("_source_record_id",), "_s3_last_modified", 15, prefix="", start_at=low.replace(tzinfo=UTC))
    source = JsonFilesSource(spark, "b", "/nowhere", t, Discovery(max_window_hours=24, safety_delay_seconds=1), Document(), clock=lambda: datetime.fromtimestamp(last.replace(tzinfo=UTC).timestamp() + 1, UTC).replace(microsecond=last.microsecond))
    rows, previous = [], None
    while True:
        previous = source.current_checkpoint(previous)
        rows.append((len(rows) + 1, unstamp(previous.value).replace(tzinfo=None)))
        if source.caught_up(previous):
            return spark.createDataFrame(rows, "window_no bigint, high timestamp_ntz")


# --- landing and merging ---------------------------------------------------------------------------------------------


@query("""select *, 'r1' as _ingest_run_id, '2026-01-01T00:00:00+00:00' as _ingested_at, 'acme_warehouse' as _source_system, 'DB' as _source_database, 'S' as _source_schema, 'EVENTS' as _source_table from events""")
def landing_lineage(spark: SparkSession, d: str) -> DataFrame:
    return landing.with_lineage(events(spark, d), "r1", "2026-01-01T00:00:00+00:00", "acme_warehouse", "DB", "S", "EVENTS")


def _overlap(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    df = events(spark, d)
    return watermarks.window(df, "ts", None, D10), watermarks.window(df, "ts", D10, high(df, "ts"), 1440)


_BOTH = "select * from events where ts is not null"


@query(_BOTH)
def merge_dedup_overlap(spark: SparkSession, d: str) -> DataFrame:
    first, second = _overlap(spark, d)
    return merge.insert_unmatched(first, second, ["event_id", "ts"])


@query(_BOTH)
def merge_idempotent(spark: SparkSession, d: str) -> DataFrame:
    run = watermarks.window(events(spark, d), "ts", None, high(events(spark, d), "ts"))
    return merge.insert_unmatched(run, run, ["event_id", "ts"])


@query("select event_id, ts, user_id, event_type, value, case when ts > timestamp '2024-01-10' then props end as props from events where ts is not null")
def merge_schema_union(spark: SparkSession, d: str) -> DataFrame:
    first, second = _overlap(spark, d)
    return merge.insert_unmatched(first.drop("props"), second, ["event_id", "ts"])


@query("""with r1 as (select * from lineitem where l_shipdate <= timestamp '1998-01-01'), r2 as (select * from lineitem where l_shipdate > timestamp '1998-01-01' - interval 86400 minute)
  select * from r1 union all select * from r2 where not exists (select 1 from r1 where r1.l_orderkey = r2.l_orderkey and r1.l_linenumber = r2.l_linenumber and r1.l_shipdate = r2.l_shipdate)""")
def merge_in_run_duplicates(spark: SparkSession, d: str) -> DataFrame:
    df, a = table(spark, d, "lineitem"), "1998-01-01 00:00:00.000000000"
    return merge.insert_unmatched(watermarks.window(df, "l_shipdate", None, a), watermarks.window(df, "l_shipdate", a, high(df, "l_shipdate"), 86_400), ["l_orderkey", "l_linenumber", "l_shipdate"])


@query("""with r as (select *, case when event_type <> 'error' then event_id end as k from events) select * from r union all select * from r where k is null""")
def merge_null_key(spark: SparkSession, d: str) -> DataFrame:
    run = events(spark, d).withColumn("k", F.when(F.col("event_type") != "error", F.col("event_id")))
    return merge.insert_unmatched(run, run, ["k", "ts"])


@query("""with r1 as (select * from orders where o_orderdate <= timestamp '1998-01-01'), r2 as (select * from orders where o_orderdate > timestamp '1998-01-01' - interval 43200 minute)
  select * from r1 union all select * from r2 where not exists (select 1 from r1 where r1.o_custkey = r2.o_custkey and r1.o_orderdate = r2.o_orderdate)""")
def merge_history(spark: SparkSession, d: str) -> DataFrame:
    df, a = table(spark, d, "orders"), "1998-01-01 00:00:00.000000000"
    return merge.insert_unmatched(watermarks.window(df, "o_orderdate", None, a), watermarks.window(df, "o_orderdate", a, high(df, "o_orderdate"), 43_200), ["o_custkey", "o_orderdate"])


@query(_BOTH)
def bronze_end_to_end(spark: SparkSession, d: str) -> DataFrame:
    """Three landing runs of events with a day's lookback, merged into a bronze table, then merged again."""
    root, files = scratch(spark, "bronze")
    t = Table("events", "events", ("event_id",), "ts", 1440)
    store = FileCheckpointStore(files, f"{root}/state")
    ids = iter(["run-1", "run-2", "run-3"])
    for bound in (D10, D20, high(events(spark, d), "ts")):
        source = RelationalSource(events(spark, d).where(F.col("ts") <= F.lit(bound).cast("timestamp_ntz")), t)
        jobs.run_table(source, t, "acme_parquet", f"{root}/landing", store, files, new_id=lambda: next(ids))
    config = Config("acme", "parquet", (t,), f"{root}/landing", f"{root}/state", bronze=Bronze("b", f"{root}/bronze", partition_by=("day({checkpoint_column})",)))
    for ledger in (FileLedger(files, f"{root}/ledger"), FileLedger(files, f"{root}/other-ledger")):  # the second forgets: all merges again
        jobs.load_table_runs(spark, config, t, f"{root}/landing", ledger, files)
    made = bronze.BronzeTable(spark, files, f"{root}/bronze", bronze.bronze_name("acme_parquet", "events"), "ts").read()
    return made.select(*events(spark, d).columns)


def _merged(spark: SparkSession, runs: list[DataFrame], key: str, spec: str) -> DataFrame:
    """A bronze table of the runs, each merged twice."""
    root, files = scratch(spark, "bronze")
    t = bronze.BronzeTable(spark, files, root, "t", "o_orderdate")
    t.ensure([(f.name, "timestamp" if f.dataType.typeName() == "timestamp_ntz" else f.dataType.simpleString()) for f in runs[0].schema], (spec,))
    for k, run in enumerate([*runs, *runs]):
        t.merge(run, f"r{k}", [key])
    return t.read()


_PRIORITY = "case when o_orderkey % 3 <> 0 then o_orderpriority end"


@query(f"select o_orderkey, o_orderdate, {_PRIORITY} as priority from orders")
def bronze_null_partition(spark: SparkSession, d: str) -> DataFrame:
    """A partition value that is null for a third of the rows and doesn't follow from the key."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.expr(_PRIORITY).alias("priority"))
    return _merged(spark, [o], "o_orderkey", "truncate(3, priority)")


@query("select o_orderkey, o_orderdate, o_orderpriority as priority from orders")
def bronze_changed_partition(spark: SparkSession, d: str) -> DataFrame:
    """The same keys come again with another partition value: they are there already."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.col("o_orderpriority").alias("priority"))
    return _merged(spark, [o, o.withColumn("priority", F.lit("elsewhere"))], "o_orderkey", "priority")


@query("select cast(o_orderkey * 1000 as varchar) as id, o_orderdate from orders")
def bronze_decimal_truncate(spark: SparkSession, d: str) -> DataFrame:
    """Decimal partition values of different lengths, with runs that overlap in keys."""
    o = table(spark, d, "orders").select((F.col("o_orderkey") * 1000).cast("decimal(38,0)").alias("id"), "o_orderdate")
    return _merged(spark, [o.where("id % 2000 = 0"), o, o.where("id < 500000")], "id", "truncate(10000000, id)").select(F.col("id").cast("string").alias("id"), "o_orderdate")


def landing_area(spark: SparkSession, d: str) -> tuple[str, LocalFiles, list[tuple[str, str]]]:
    """The manifests of run_manifests as files in their run folders (written by tasks), with an empty part beside those that name files;
    and the (source key, table) pairs there. Of repeated rows of a run, a successful one counts."""
    root, files = scratch(spark, "landing")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                folder = run_folder(root, r.source_key, r.table, r.day, r.run_id)
                m = Manifest(r.run_id, r.source_key, {"table": r.table}, [], {}, r.load_type or "", r.started_at or "", "", int(r.row_count), int(r.file_count), [], None, status=r.status or "")
                compaction.replace_file(f"{folder}/{NAME}", iter([m.to_json().encode()]))
                if r.n_files:
                    compaction.replace_file(f"{folder}/part-00000.parquet", iter([b""]))
                yield pd.DataFrame({"source_key": [r.source_key], "table": [r.table]})

    m = table(spark, d, "run_manifests")
    facts = F.struct((F.col("status") == "SUCCESS").alias("good"), "status", "load_type", "started_at", F.coalesce("row_count", F.lit(-1)).alias("row_count"), F.coalesce("file_count", F.lit(-1)).alias("file_count"), F.coalesce(F.array_size("files"), F.lit(0)).alias("n_files"))
    one = m.groupBy(F.col("source_system").alias("source_key"), F.lower(F.coalesce(F.col("source")["table"], F.lit("till_messages"))).alias("table"), "run_id").agg(F.max(facts).alias("f")).select("source_key", "table", "run_id", "f.*", F.substring("f.started_at", 1, 10).alias("day"))
    return root, files, [(r[0], r[1]) for r in one.mapInPandas(write, "source_key string, table string").distinct().orderBy("source_key", "table").collect()]


@query("""with committed as (select distinct run_id from run_manifests where status = 'SUCCESS') select run_id from committed where run_id not in (select run_id from processed_runs where upper(bronze_status) = 'SUCCESS' and run_id is not null)""")
def pending_runs(spark: SparkSession, d: str) -> DataFrame:
    """The committed runs that the ledger doesn't have, as the bronze job finds them: manifests listed, ledger read, table by table."""
    root, files, tables = landing_area(spark, d)
    ledger = FileLedger(files, f"{root}-ledger")
    for r in table(spark, d, "processed_runs").where(F.upper("bronze_status") == "SUCCESS").select("table_key", "run_id").distinct().toLocalIterator():
        ledger.mark(r["table_key"], r["run_id"])
    pending = []
    for key, name in tables:
        done = ledger.processed(f"{key}:{name}")
        pending += [(run.run_id,) for run in committed_runs(files, root, key, name) if run.run_id not in done]
    return spark.createDataFrame(pending, "run_id string")


@query("select distinct run_id from run_manifests where row_count = 0 and file_count = 0 and coalesce(len(files), 0) = 0")
def empty_runs(spark: SparkSession, d: str) -> DataFrame:
    """The run folders that the sweep would delete: a manifest of no rows and no files, and nothing else."""
    root, files, _ = landing_area(spark, d)
    return spark.createDataFrame([(folder.rsplit("run_id=", 1)[1],) for folder in sweep_empty(files, root)], "run_id string")


@query("""select distinct (year(o_orderdate) - 1970) as y, ((year(o_orderdate) - 1970) * 12 + month(o_orderdate) - 1) as m, strftime(o_orderdate, '%Y-%m-%d') as day, o_orderkey - o_orderkey % 1000 as t, substr(o_orderpriority, 1, 3) as p from orders""")
def partition_transforms(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    types = {k.lower(): v for k, v in o.dtypes}
    specs = {"y": "year(o_orderdate)", "m": "month({checkpoint_column})", "day": "day(o_orderdate)", "t": "truncate(1000, o_orderkey)", "p": "truncate(3, o_orderpriority)"}
    x = o.select(*[merge.partition_value(s, "o_orderdate", types)[1].alias(k) for k, s in specs.items()]).distinct()
    return x.select(F.col("y").cast("bigint").alias("y"), F.col("m").cast("bigint").alias("m"), F.col("day").cast("string").alias("day"), "t", "p")


@query("""with t as (select distinct unnest(schema).type as t from run_manifests) select t as recorded, case when lower(t) like 'decimal%' then replace(regexp_replace(lower(t), '^decimal(128)?', 'decimal'), ' ', '') when lower(t) like 'timestamp%' then 'timestamp'
  when lower(t) in ('int64', 'bigint') then 'bigint' when lower(t) in ('int32', 'int') then 'int' when lower(t) in ('bool', 'boolean') then 'boolean' when lower(t) in ('double', 'float') then lower(t) when lower(t) in ('date32[day]', 'date') then 'date' else 'string' end as catalog_type from t""")
def type_mapping(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "run_manifests").select(F.explode("schema").alias("c")).select(F.col("c.type").alias("recorded")).distinct()
    return t.withColumn("catalog_type", drift.catalog_type(F.col("recorded")))


@query(f"select run_id, column_name, case change when 'retyped' then 'changed' else change end as change from ({oracles.SQL['p4_changes']}) where change <> 'removed'")
def schema_diff(spark: SparkSession, d: str) -> DataFrame:
    """What a bronze table with the schema of the run before would have to add or refuse, run by run."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                added, changed = bronze.diff(dict(r.target), list(dict(r.columns).items()))
                rows = [(r.run_id, n, "added") for n, _ in added] + [(r.run_id, n, "changed") for n, _, _ in changed]
                yield pd.DataFrame(rows, columns=["run_id", "column_name", "change"])

    met = problems.enforced(spark, d).where(F.col("target").isNotNull()).select("run_id", "target", "columns")
    return met.mapInPandas(run, "run_id string, column_name string, change string")


# --- reading history -------------------------------------------------------------------------------------------------


@query("select * exclude (n) from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as n from orders) where n = 1")
def current_state(spark: SparkSession, d: str) -> DataFrame:
    return silver.current_state(table(spark, d, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey")


@query("select * exclude (n) from (select *, row_number() over (partition by user_id order by cast(json_extract_string(props, '$.k') as decimal(38, 0)) desc, ts desc, event_id desc) as n from events) where n = 1")
def silver_latest_version(spark: SparkSession, d: str) -> DataFrame:
    return silver.latest_version(events(spark, d), F.col("user_id"), silver.scalar(F.col("props"), "$.k"), "ts", "event_id")


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_scalar(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("event_id", silver.scalar(F.col("props"), "$.k", "bigint").alias("k"))


@query("select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem")
def json_explode_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines gathered into a JSON array an order, and opened again."""
    li = table(spark, d, "lineitem")
    orders = li.groupBy("l_orderkey").agg(F.to_json(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))).alias("lines"))
    return silver.explode_items(orders, "lines", "array<struct<l_linenumber:int,l_partkey:bigint,l_quantity:double>>")


@query("select count(*) as mismatches from events where split_part('g:' || event_id, ':', 2) <> cast(event_id as varchar)")
def id_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    return e.where(silver.id_suffix(F.concat(F.lit("g:"), F.col("event_id"))) != F.col("event_id").cast("string")).agg(F.count(F.lit(1)).alias("mismatches"))


# --- documents -------------------------------------------------------------------------------------------------------


@query("select event_id, user_id, event_type, value, cast(event_id as varchar) as envelope_id from events")
def cloudevents_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Events written as gzipped files of enveloped, gzipped, base64 payloads, then listed and decoded again."""
    root, _ = scratch(spark, "envelopes")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 500):
                part = pdf.iloc[lo : lo + 500]
                records = [{"type": "e", "specversion": "1.0", "source": "s", "id": str(i), "data_base64": base64.b64encode(gzip.compress(p.encode(), mtime=0)).decode()} for i, p in zip(part["event_id"], part["payload"])]
                data = gzip.compress(json.dumps(records).encode(), mtime=0)
                name = f"{hashlib.md5(data).hexdigest()}.json.gz"
                compaction.replace_file(f"{root}/{name}", iter([data]))
                yield pd.DataFrame({"file": [name]})

    rows = events(spark, d).select("event_id", F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("payload"))
    rows.mapInPandas(write, "file string").write.format("noop").mode("overwrite").save()
    document = Document("cloudevents", "gzip", "auto", Payload("data_base64", "base64", "auto"))
    objects = list_objects(spark, root, [("", False)], ".json.gz").repartition(spark.sparkContext.defaultParallelism)
    records = decode_files(objects, "b", Table("events", "", ("_source_record_id",), "_s3_last_modified", prefix=""), document)
    p = F.from_json("payload_json", "event_id bigint, user_id bigint, event_type string, value double")
    return records.select(p.alias("p"), F.col("event_id").alias("envelope_id")).select("p.*", "envelope_id")


@query("""select event_id, sha256('["b","k/' || event_id || '","\\"e\\"",' || (event_id % 7) || ']') as record_id from events""")
def record_identity(spark: SparkSession, d: str) -> DataFrame:
    key = F.concat(F.lit("k/"), F.col("event_id"))
    return events(spark, d).select("event_id", record_ids(F.lit("b"), key, F.lit('"e"'), F.col("event_id") % 7).alias("record_id"))


@query("""with m as (select landed_no, k, json_extract(envelope_json, '$."' || k || '"') as v from (select landed_no, envelope_json, unnest(json_keys(envelope_json)) as k from feed_landing) where k not in ('data', 'route'))
  select landed_no, k as member, v ->> '$' as value from m""")
def value_stringify(spark: SparkSession, d: str) -> DataFrame:
    """Every member of every envelope as a text column would hold it; structures are left to the round trip of their tests."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(n, k, decode.cell(v)) for n, text in zip(pdf["landed_no"], pdf["envelope_json"]) for k, v in decode.value_of(text, "an envelope").items() if not isinstance(v, (dict, list))]
            yield pd.DataFrame(rows, columns=["landed_no", "member", "value"])

    rows = table(spark, d, "feed_landing").where(F.col("envelope_json").isNotNull()).select("landed_no", "envelope_json")
    return rows.mapInPandas(run, "landed_no bigint, member string, value string")


@query("select doc_id, cast(strlen(text) + coalesce(strlen(lang), 0) + coalesce(strlen(source), 0) + coalesce(strlen(table_key), 0) as bigint) as row_bytes from documents")
def row_bytes_guard(spark: SparkSession, d: str) -> DataFrame:
    """The size of each row's text as the feed guards it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cells = (dict(zip(("text", "lang", "source", "table_key"), r)) for r in zip(pdf["text"], pdf["lang"], pdf["source"], pdf["table_key"]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "row_bytes": [row_bytes(c, f"document {i}") for i, c in zip(pdf["doc_id"], cells)]})

    return table(spark, d, "documents").select("doc_id", "text", "lang", "source", "table_key").mapInPandas(run, "doc_id bigint, row_bytes bigint")


# --- diagnostics -----------------------------------------------------------------------------------------------------


def _objects(spark: SparkSession, d: str) -> DataFrame:
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    folder = F.when(F.col("event_id") % 5 == 0, hour - F.expr("interval 1 hour")).otherwise(hour)
    return events(spark, d).select("event_id", F.col("ts").alias("modified"), folder.alias("folder_hour"))


_OBJECTS = "o as (select event_id, ts as modified, date_trunc('hour', ts) - case when event_id % 5 = 0 then interval 1 hour else interval 0 hour end as folder_hour from events)"
_LATE = f"{_OBJECTS}, l as (select *, (epoch_us(modified) - epoch_us(folder_hour)) / 1e6 - 3600 as late_seconds from o)"


@query(f"""with {_LATE} select case when late_seconds <= 0 then 'in-hour' when late_seconds <= 900 then '<=15m late' when late_seconds <= 1800 then '<=30m late' when late_seconds <= 3600 then '<=1h late' when late_seconds <= 86400 then '<=24h late' else '>24h late' end as lateness,
  count(*) as objects from l group by 1""")
def lateness_histogram(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.lateness_histogram(_objects(spark, d)).drop("percent")


@query("with h as (select date_trunc('hour', ts) as h, count(*) as n from events group by 1) select count(*) as hours, min(n) as min_objects, cast(sum(n) // count(*) as bigint) as mean_objects, max(n) as max_objects from h")
def folder_hour_stats(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.folder_stats(events(spark, d).select(F.date_trunc("hour", "ts").alias("folder_hour")))


@query(f"with {_LATE} select event_id, folder_hour from l order by late_seconds desc, event_id desc limit 25")
def late_top_n(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.worst(_objects(spark, d), 25, "event_id").select("event_id", "folder_hour")


@query(f"""with {_OBJECTS}, r as (select timestamp '2024-01-01' + to_minutes(cast(15 * k as int)) - to_seconds(120) as high, k from range(1, 3000) t(k)), w as (select high, k, case when k = 1 then timestamp '2024-01-01' else high - interval 15 minute end as low from r)
  select event_id from o join w on (case when k = 1 then modified >= low else modified > low end) and modified <= high where folder_hour <= high + interval 1 hour and folder_hour >= date_trunc('hour', low - case when k = 1 then interval 0 minute else interval 15 minute end)""")
def discovery_replay(spark: SparkSession, d: str) -> DataFrame:
    start = int(datetime(2024, 1, 1, tzinfo=UTC).timestamp())
    return diagnostics.replay(_objects(spark, d), start).where("found").select("event_id")


@query("select k as key, 'integer' as type, count(*) as records from (select unnest(json_keys(props)) as k from events) group by 1")
def shape_census(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.key_census(events(spark, d), "props")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def duplicate_objects(spark: SparkSession, d: str) -> DataFrame:
    return diagnostics.duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""with x as (select envelope_json as e, payload_json as p from feed_landing),
  m as (
    select 'codec' as measure, case when c like 'H4s%' then 'gzip' when left(c, 2) in ('eA', 'eF', 'eJ', 'eN') then 'zlib' else 'none' end as value from (select json_extract_string(e, '$.data_base64') as c from x) where c is not null
    union all select 'id_type', k || ' ' || case json_type(p, k) when 'VARCHAR' then 'string' when 'UBIGINT' then 'bigint' when 'BIGINT' then 'bigint' when 'OBJECT' then 'object' else lower(json_type(p, k)) end from x, (values ('$.order.id'), ('$.shift_id')) t(k) where json_extract_string(p, k) is not null
    union all select 'carrier' as measure, case when json_extract(e, '$.data_base64') is not null then 'data_base64' when json_extract(e, '$.data') is not null then 'data' else 'neither' end as value from x
    union all select 'type', case when p is null then 'none' else lower(json_type(p)) end from x
    union all select 'wrapper', case when json_extract_string(p, '$.order.id') is not null then '$.order' when json_extract_string(p, '$.shift_id') is not null then '$' else 'bare' end from x where json_type(p) = 'OBJECT'
    union all select 'id_path', '$.order.id' from x where json_extract_string(p, '$.order.id') is not null union all select 'id_path', '$.shift_id' from x where json_extract_string(p, '$.shift_id') is not null
    union all select 'id_match', '$.order.id ' || case when json_extract_string(p, '$.order.id') = split_part(json_extract_string(e, '$.id'), ':', -1) then '==' else '!=' end from x where json_extract_string(p, '$.order.id') is not null and json_extract_string(e, '$.id') like '%:%'
    union all select 'id_match', '$.shift_id ' || case when json_extract_string(p, '$.shift_id') = split_part(json_extract_string(e, '$.id'), ':', -1) then '==' else '!=' end from x where json_extract_string(p, '$.shift_id') is not null and json_extract_string(e, '$.id') like '%:%'
    union all select 'version_path', '$.version' from x where json_extract_string(p, '$.version') is not null
    union all select 'key', unnest(json_keys(p)) from x where json_type(p) = 'OBJECT')
  select measure, value, count(*) as records from m group by 1, 2""")
def feed_census(spark: SparkSession, d: str) -> DataFrame:
    """The frequency tables of the landed feed, whole."""
    return diagnostics.census(table(spark, d, "feed_landing"), "envelope_json", "payload_json", ["$.order.id", "$.shift_id"], ["$.version"])
