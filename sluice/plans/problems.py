"""The queries of the data-preparation problems over the test tables (core part)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.instants import normalise, utc_instant
from sluice.operators import compaction, drift, lateness, quotient, shredding
from sluice.plans import oracles
from sluice.session import fresh, stored, table
from sluice.streaming.available_now import VersionedTotals, drain

DOCUMENTS = {"payload": "payload_json", "envelope": "envelope_json"}
WITHOUT = {"envelope": ("data", "data_base64")}


# --- 1 nested records ------------------------------------------------------------------------------------------------


def routed(spark: SparkSession, d: str) -> shredding.Routed:
    """All records of feed_landing, each routed to its subtype's table."""
    records = shredding.shred(table(spark, d, "feed_landing"), ["landed_no"], DOCUMENTS, without=WITHOUT)
    return shredding.route(records, ["landed_no"], fresh(spark, "p1"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """One row for each child record, of all subtypes' tables."""
    return routed(spark, d).supertype().where(F.col("parent_no").isNotNull()).select("landed_no", F.col("record_path").alias("child_path"))


def p1_variants(spark: SparkSession, d: str) -> DataFrame:
    """The table of definitions: each structural variant and how many records have it."""
    return routed(spark, d).definitions()


def p1_shapes(spark: SparkSession, d: str) -> DataFrame:
    """The structural variants as far as SQL can tell them: how many records of a kind have which typed fields, nulls aside."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            shapes = (sorted((f, t) for f, t in shredding.variant_fields(x).items() if t != "void") for x in pdf["definition"])
            yield pd.DataFrame({"kind": pdf["kind"], "fields": [",".join(f"{f}:{t}" for f, t in s) for s in shapes], "records": pdf["records"]})

    shapes = routed(spark, d).definitions().mapInPandas(run, "kind string, fields string, records bigint")
    return shapes.groupBy("kind", "fields").agg(F.sum("records").alias("records"))


def p1_kinds(spark: SparkSession, d: str) -> DataFrame:
    """How many records each kind has, by the form in which their member holds them and by depth."""
    return routed(spark, d).supertype().groupBy("root", "kind", "carrier", "depth").agg(F.count(F.lit(1)).alias("records"))


def p1_lines(spark: SparkSession, d: str) -> DataFrame:
    """The typed table of order lines, of all variants, with types from their definitions."""
    lines = routed(spark, d).subtype("lines", wanted=["sku", "qty", "price"])
    return lines.select("landed_no", "record_path", "parent_path", "ordinal", "depth", "sku", F.col("qty").cast("bigint").alias("qty"), F.col("price").cast("double").alias("price"))


def p1_hops(spark: SparkSession, d: str) -> DataFrame:
    """The typed table of routing hops, with types from their definitions."""
    hops = routed(spark, d).subtype("hops", wanted=["relay", "lag"])
    return hops.select("landed_no", "record_path", "parent_path", "ordinal", "depth", "relay", F.col("lag").cast("bigint").alias("lag"))


# --- 2 times ---------------------------------------------------------------------------------------------------------


def feed_times(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """feed_landing's ``event_time`` as instants."""
    sources = table(spark, d, "feed_sources").select("event_source", F.col("time_zone").alias("__tz"), (F.col("locale_tag") == "en-US").alias("__mf"))
    rows = table(spark, d, "feed_landing").select("landed_no", "event_source", "event_time", *columns).join(sources, "event_source", "left")
    return normalise(rows, "event_time", F.col("__tz"), F.col("__mf"), "event").drop("__tz", "__mf")


def all_times(spark: SparkSession, d: str) -> DataFrame:
    """The times of feed_landing and object_listing as instants, in one plan: (table_name, row_no, t_instant, t_nanos, t_status)."""
    sources = table(spark, d, "feed_sources").select("event_source", F.col("time_zone").alias("zone"), (F.col("locale_tag") == "en-US").alias("month_first"))
    feed = table(spark, d, "feed_landing").select("landed_no", "event_source", "event_time").join(sources, "event_source", "left")
    feed = feed.select(F.lit("feed_landing").alias("table_name"), F.col("landed_no").alias("row_no"), F.col("event_time").alias("value"), "zone", "month_first")
    listing = table(spark, d, "object_listing").select(F.lit("object_listing").alias("table_name"), F.col("listing_no").alias("row_no"), F.col("_s3_last_modified").alias("value"), F.col("host_time_zone").alias("zone"), F.lit(None).cast("boolean").alias("month_first"))
    return normalise(feed.unionByName(listing), "value", F.col("zone"), F.col("month_first")).drop("value", "zone", "month_first")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Each non-null value that doesn't denote exactly one instant."""
    return all_times(spark, d).where(~F.col("t_status").isin("ok", "null")).select("table_name", "row_no")


def p2_instants(spark: SparkSession, d: str) -> DataFrame:
    """The instant of every readable value, in microseconds since 1970."""
    return all_times(spark, d).where(F.col("t_status") == "ok").select("table_name", "row_no", F.unix_micros("t_instant").alias("micros"))


# --- 3 small files ---------------------------------------------------------------------------------------------------


def compaction_plan(spark: SparkSession, d: str) -> DataFrame:
    return compaction.plan(compaction.committed_files(table(spark, d, "run_manifests"), table(spark, d, "landing_files")))


def compacted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, str]:
    """(plan, report, folder): the compaction, carried out as far as there are bytes here.

    Of the files in landing_files only the feed's have their rows at hand, in feed_landing. They are written as line files, one for
    each small committed file, and joined byte by byte into the outputs of the plan; other tables' files are planned only.
    The report names each input; its files, bytes and records are held against the plan's.
    """
    base = fresh(spark, "p3")
    place = base.removeprefix("file://")  # other addresses are used as they are
    p = stored(compaction_plan(spark, d), "p3-plan")
    rows = table(spark, d, "feed_landing").select("landed_no", F.to_json(F.struct("landed_no", "payload_json")).alias("line"))
    # Files hold ranges of landed rows: each range is opened into its numbers, which makes the match an equi-join.
    numbers = F.when(F.col("last_landed_no") >= F.col("first_landed_no"), F.sequence("first_landed_no", "last_landed_no"))
    held = p.select("file_uri", "source_system", "table_name", "output_no", "position", F.explode(numbers).alias("landed_no")).join(rows, "landed_no")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        path = f"{place}/in/{hashlib.sha256(first['file_uri'].encode()).hexdigest()}"
        data = "\n".join(pdf.sort_values("landed_no")["line"]).encode()
        compaction.replace_file(path, iter([data]))
        output = f"{first['source_system']}.{first['table_name']}.{first['output_no']:06d}"
        return pd.DataFrame([[first["file_uri"], output, path, len(data), first["position"], len(pdf)]], columns=["file_uri", "output", "path", "size_bytes", "position", "rows"])

    written = stored(held.groupBy("file_uri").applyInPandas(write, "file_uri string, output string, path string, size_bytes bigint, position bigint, rows bigint"), "p3-inputs")
    report = stored(compaction.join_files(written, f"{place}/out"), "p3-report")
    both = written.join(report, written["path"] == report["input"], "full")
    wrong = both.where(F.col("input").isNull() | written["path"].isNull() | ~F.col("size_bytes").eqNullSafe(F.col("bytes")) | ~F.col("rows").eqNullSafe(F.col("lines"))).select("file_uri", "input").head(1)
    if wrong:
        raise ValueError(f"what was joined isn't what was planned: {wrong[0]}")
    return p, report.join(written.select(F.col("path").alias("input"), "file_uri"), "input"), f"{base}/out"


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The small committed files: those that were joined, as the report of the joining names them, and those planned only."""
    p, report, _ = compacted(spark, d)
    joined = report.select("file_uri")
    return joined.unionByName(p.select("file_uri").join(joined, "file_uri", "left_anti"))


def p3_plan(spark: SparkSession, d: str) -> DataFrame:
    """How many files and bytes of each source table go into how many outputs."""
    p = compaction_plan(spark, d)
    outputs = p.groupBy("source_system", "table_name", "output_no").agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("bytes"), F.sum("row_count").alias("rows"))
    return outputs.groupBy("source_system", "table_name").agg(F.sum("files").cast("bigint").alias("files"), F.sum("bytes").cast("bigint").alias("bytes"), F.sum("rows").cast("bigint").alias("rows"))


def p3_joined(spark: SparkSession, d: str) -> DataFrame:
    """The joined files read back: landed_no and a checksum of each record that they hold."""
    _, _, folder = compacted(spark, d)
    back = spark.read.schema("landed_no bigint, payload_json string").json(folder)
    return back.select("landed_no", F.sha2("payload_json", 256).alias("checksum"))


# --- 4 drift ---------------------------------------------------------------------------------------------------------


def enforced(spark: SparkSession, d: str) -> DataFrame:
    """Each run with the schema that its ingestion enforces."""
    return drift.enforce(drift.run_schemas(table(spark, d, "run_manifests")))


def ingested(spark: SparkSession, d: str) -> DataFrame:
    """All fields of landed_samples as rescue ingestion leaves them."""
    return drift.ingest_runs(table(spark, d, "landed_samples"), enforced(spark, d))


def p4_changes(spark: SparkSession, d: str) -> DataFrame:
    """The report of all schema changes."""
    return drift.changes(enforced(spark, d)).select("source_system", "run_id", "previous_run_id", "column_name", "change", "old_type", "new_type")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Each column that is new, gone or of another type in a run, against the target that the run's ingestion enforces."""
    return p4_changes(spark, d).select("run_id", "column_name")


def p4_rescued(spark: SparkSession, d: str) -> DataFrame:
    """Rescue ingestion of the landed samples of every source table: fields by type on arrival, type now, and outcome."""
    return ingested(spark, d).groupBy("source_system", "column_name", "arrival_type", "catalog_type", "outcome").agg(F.count(F.lit(1)).alias("fields"))


def p4_table(spark: SparkSession, d: str) -> DataFrame:
    """The consistent tables of all sources, field by field: typed values as text, and what is still rescued."""
    return ingested(spark, d).select("run_id", "row_no", "column_name", "catalog_type", "outcome", "value", F.col("rescued").isNotNull().alias("is_rescued"))


def p4_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """The feed's envelopes ingested under a narrow target, two more fields promoted, and what was rescued replayed into them."""
    narrow = {"type": "string", "time": "timestamp_ntz"}
    taken = drift.ingest(table(spark, d, "feed_landing").select("landed_no", "envelope_json"), "envelope_json", narrow)
    wide = drift.replay(taken, drift.promote(narrow, {"businessdate": "date", "specversion": "decimal(2,1)"}))
    left = F.array_join(F.array_sort(F.json_object_keys("_rescued")), ",")
    return wide.select("landed_no", "type", F.col("time").cast("string").alias("time"), F.col("businessdate").cast("string").alias("businessdate"), F.col("specversion").cast("string").alias("specversion"), left.alias("left_over"))


# --- 5 and 6 late and repeated messages ------------------------------------------------------------------------------


def first_arrivals(spark: SparkSession, d: str) -> DataFrame:
    """The first copy of each message, classified by lateness."""
    rows = feed_times(spark, d, "event_id", "_source_record_id", "_s3_last_modified")
    first = quotient.first_copies(rows.select("landed_no", "event_source", "event_id", "_source_record_id", "event_instant", "_s3_last_modified"), quotient.message_name(), "landed_no")
    came = F.col("_s3_last_modified")
    arrived = first.withColumn("arrived", utc_instant(came) if dict(first.dtypes)["_s3_last_modified"] == "timestamp_ntz" else came)
    return lateness.classify(arrived, "event_instant", "arrived")


def updates(spark: SparkSession, d: str) -> DataFrame:
    """What each first copy that counts does to which version of its hour."""
    return lateness.versioned(first_arrivals(spark, d), "arrived").select("landed_no", "period_start", "version")


def hour_log(changed: DataFrame) -> DataFrame:
    """The change log of messages an hour."""
    return lateness.retractions(lateness.differential(changed, {"messages": F.lit(1).cast("bigint")}), ["messages"])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The first copies for which the change log retracts an hour already reported."""
    changed = stored(updates(spark, d), "p5-updates")
    return lateness.corrections(changed, hour_log(changed)).select("landed_no")


def p5_changes(spark: SparkSession, d: str) -> DataFrame:
    """The change log of messages an hour: retracted and new totals by version."""
    return hour_log(updates(spark, d)).select(F.unix_seconds("period_start").alias("hour_s"), "version", F.col("sign").cast("bigint").alias("sign"), F.col("messages").cast("bigint").alias("messages"))


def p5_totals(spark: SparkSession, d: str) -> DataFrame:
    """The totals an hour as corrected until the cut-off: the signed sum of the change log."""
    return lateness.current(hour_log(updates(spark, d)), ["messages"]).select(F.unix_seconds("period_start").alias("hour_s"), F.col("messages").cast("bigint").alias("messages"))


def p5_streamed(spark: SparkSession, d: str) -> DataFrame:
    """The same totals from a stream: first copies in files by order of arrival, drained a file a batch into versioned state."""
    folder = fresh(spark, "p5-stream")
    rows = first_arrivals(spark, d).select("event_instant", "arrived")
    rows.repartitionByRange(4, "arrived").write.parquet(f"{folder}/in")
    totals = VersionedTotals(spark, f"{folder}/totals", "", "event_instant", "arrived", {"messages": "1"})
    last = -1

    def each(batch: DataFrame, number: int) -> None:
        nonlocal last
        totals.batch(batch, number)
        last = max(last, number)

    drain(spark.readStream.schema("event_instant timestamp, arrived timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in"), each, f"{folder}/checkpoint")
    return totals.state(last).select(F.unix_seconds("period_start").alias("hour_s"), "messages")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Every copy of a message except the first."""
    rows = table(spark, d, "feed_landing").select("landed_no", "event_source", "event_id", "_source_record_id")
    return quotient.mark_copies(rows, quotient.message_name(), "landed_no").where("is_copy").select("landed_no")


def p6_once(spark: SparkSession, d: str) -> DataFrame:
    """Exactly one copy of each message."""
    rows = table(spark, d, "feed_landing").select("landed_no", "event_source", "event_id", "_source_record_id", "_s3_etag", "event_type", "business_date")
    return quotient.first_copies(rows, quotient.message_name(), "landed_no").select("landed_no", "event_source", "event_type", "_s3_etag", "business_date")


SQL = oracles.SQL
QUERIES = {f.__name__: f for f in (p1_found, p1_variants, p1_shapes, p1_kinds, p1_lines, p1_hops, p2_found, p2_instants, p3_found, p3_plan, p3_joined, p4_found, p4_changes, p4_rescued, p4_table, p4_envelopes, p5_found, p5_changes, p5_totals, p5_streamed, p6_found, p6_once)}
