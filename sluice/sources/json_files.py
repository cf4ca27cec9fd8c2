"""JSON documents in a folder tree: windows by modification time, folders walked by the hour, listing and decoding in tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.control.config import CLOUDEVENTS, Config, Discovery, Document, Table
from sluice.control.errors import DecodeError, SourceError
from sluice.control.files import file_system
from sluice.control.state import WatermarkCheckpoint
from sluice.functions.decode import compile_columns, compile_feed
from sluice.session import stored
from sluice.sources.base import Source

STAMP = "%Y-%m-%d %H:%M:%S.%f"
#: A landed row's text may have this many bytes.
ROW_BYTES = 30 << 20


def stamp(at: datetime) -> str:
    return at.astimezone(UTC).strftime(STAMP)


def unstamp(text: str) -> datetime:
    return datetime.strptime(text, STAMP).replace(tzinfo=UTC)


def hour_folders(d: Discovery, first: datetime, last: datetime) -> list[str]:
    """The folders of all hours from first to last (with lookahead), in order, each once.

    Steps are hours of UTC, names are of the folder's zone: an hour that a zone shows twice is one folder, and a zone with a
    fraction of an hour gets the folder its last instant lies in.
    """
    zone = ZoneInfo(d.timezone)
    at, end = first.astimezone(UTC), (last + timedelta(hours=d.lookahead_hours)).astimezone(UTC)
    names: dict[str, None] = {}
    while at <= end:
        names[at.astimezone(zone).strftime(d.path_format)] = None
        at += timedelta(hours=1)
    names[end.astimezone(zone).strftime(d.path_format)] = None
    return list(names)


def row_bytes(cells: dict[str, str | None], what: str) -> int:
    """The bytes of a row's text; DecodeError where a landed row may not have so many."""
    size = sum(len(v.encode()) for v in cells.values() if v)
    if size > ROW_BYTES:
        raise DecodeError(f"{what} has more than {ROW_BYTES} bytes")
    return size


def record_ids(bucket: Column, key: Column, etag: Column, ordinal: Column) -> Column:
    """decode.record_id for columns. An address beyond ASCII, which that function escapes, is an error here, never another identity."""
    text = F.to_json(F.array(bucket, key, etag))
    whole = F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(","), ordinal.cast("string"), F.lit("]"))
    return F.when(F.octet_length(text) == F.length(text), F.sha2(whole, 256)).otherwise(F.raise_error(F.lit("an address beyond ASCII")))


def landed_columns(table: Table, document: Document) -> list[str]:
    core = list(CLOUDEVENTS) if document.envelope == "cloudevents" else []
    envelope = ["envelope_json"] if document.envelope != "none" or document.payload.path is not None else []
    return ["_source_record_id", "_s3_bucket", "_s3_key", "_s3_etag", *core, *(c for c, _ in table.envelope_fields), *envelope, "payload_json", "_s3_record_index", "_s3_last_modified"]


OBJECTS = "path string, key string, size_bytes bigint, modified timestamp"
#: Bytes of objects that a decoding task gets, about.
TASK_BYTES = 128 << 20


def list_objects(spark: SparkSession, root: str, folders: list[tuple[str, bool]], suffix: str) -> DataFrame:
    """The objects in folders below ``root`` (name, and whether to go on into folders in it), listed by tasks: see OBJECTS. A folder that isn't there
    has none. The driver holds the folders' names only, and each task one folder's listing."""
    top = root.rstrip("/")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs

        for pdf in batches:
            for name, deep in zip(pdf["name"], pdf["deep"]):
                system, base = file_system(top)
                found = system.get_file_info(pafs.FileSelector(f"{base}/{name}".rstrip("/"), allow_not_found=True, recursive=bool(deep)))
                head = "" if "://" not in top or top.startswith("file:") else top[: top.index("://") + 3]
                files = [f for f in found if f.type == pafs.FileType.File and f.path.endswith(suffix)]
                if files:
                    yield pd.DataFrame({"path": [head + f.path for f in files], "key": [f.path[len(base) :].lstrip("/") for f in files], "size_bytes": [f.size for f in files], "modified": pd.to_datetime([f.mtime_ns // 1000 for f in files], unit="us", utc=True)})

    names = spark.createDataFrame(folders, "name string, deep boolean")
    return names.repartition(max(1, min(len(folders), 512))).mapInPandas(run, OBJECTS)


def _read_object(path: str, size: int, modified: datetime, limit: int) -> bytes:
    """An object's bytes, at most ``limit``, only as it was listed: one that was replaced since is refused."""
    system, at = file_system(path)
    with system.open_input_stream(at, compression=None) as f:
        data = f.read(limit + 1)
    if len(data) > limit:
        raise DecodeError(f"larger than {limit} bytes")
    now = system.get_file_info(at)
    if len(data) != size or now.size != size or now.mtime_ns // 1000 != int(modified.timestamp() * 1_000_000 + 0.5):
        raise DecodeError("changed since it was listed")
    return data


def decode_files(objects: DataFrame, bucket: str, table: Table, document: Document) -> DataFrame:
    """The records of listed objects (see OBJECTS). One malformed record fails the run; the error names the object, not its content."""
    columns = landed_columns(table, document)
    core = CLOUDEVENTS if document.envelope == "cloudevents" else {}
    paths = core | dict(table.envelope_fields)
    schema = pa.schema([(c, pa.int64() if c == "_s3_record_index" else pa.timestamp("us", "UTC") if c == "_s3_last_modified" else pa.string()) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, fill = compile_feed(document), compile_columns(bucket, paths, "envelope_json" in columns)
        held: dict[str, list] = {c: [] for c in columns}
        size = 0
        for batch in batches:
            for o in batch.to_pylist():
                try:
                    data = _read_object(o["path"], o["size_bytes"], o["modified"], document.max_object_bytes)
                    etag = f'"{hashlib.md5(data).hexdigest()}"'
                    for record in records(data):
                        cells = {c: v if v is None or v.isascii() else v.encode("utf-8", "replace").decode() for c, v in fill(record, o["key"], etag).items()}  # half surrogate pairs become question marks
                        size += row_bytes(cells, f"record {record.ordinal}")
                        cells |= {"_s3_record_index": record.ordinal, "_s3_last_modified": o["modified"]}
                        for c, values in held.items():
                            values.append(cells[c])
                        if size >= document.batch_bytes:
                            yield pa.RecordBatch.from_pydict(held, schema)
                            held, size = {c: [] for c in columns}, 0
                except DecodeError as e:
                    raise SourceError(f"{o['key']}: {e}") from None
        if held[columns[0]]:
            yield pa.RecordBatch.from_pydict(held, schema)

    return objects.mapInArrow(run, _ddl(columns))


def _ddl(columns: list[str]) -> str:
    return ", ".join(f"{c} {'bigint' if c == '_s3_record_index' else 'timestamp' if c == '_s3_last_modified' else 'string'}" for c in columns)


class JsonFilesSource(Source):
    commits_empty = True

    def __init__(self, spark: SparkSession, bucket: str, root: str, table: Table, discovery: Discovery, document: Document, clock: Callable[[], datetime] = lambda: datetime.now(UTC)) -> None:
        self.spark, self.bucket, self.root, self.table, self.discovery, self.document = spark, bucket, root.rstrip("/"), table, discovery, document
        self.clock, self._capped = clock, False

    def current_checkpoint(self, previous: WatermarkCheckpoint | None) -> WatermarkCheckpoint:
        high = self.clock() - timedelta(seconds=self.discovery.safety_delay_seconds)
        resume = unstamp(previous.value) if previous and previous.value else self.table.start_at
        self._capped = False
        if self.discovery.max_window_hours and resume:
            cap = resume + timedelta(hours=self.discovery.max_window_hours)
            self._capped = cap < high
            high = min(high, cap)
        return WatermarkCheckpoint("_s3_last_modified", stamp(high), "TIMESTAMP_NTZ", self.table.lookback_minutes)

    def caught_up(self, checkpoint: WatermarkCheckpoint) -> bool:
        return not self._capped

    def objects(self, previous: WatermarkCheckpoint | None, current: WatermarkCheckpoint) -> DataFrame:
        """The window's objects: [start, high] at first, later (previous high, high]. Lookback widens only the walk."""
        high = unstamp(current.value)
        first = not (previous and previous.value)
        low = self.table.start_at if first else unstamp(previous.value)
        d, base = self.discovery, f"{self.root}/{self.table.prefix}".rstrip("/")
        if low is None or low > high:
            return self.spark.createDataFrame([], OBJECTS)
        if d.type == "full_prefix":  # the first level's folders are walked by a task each
            from pyarrow import fs as pafs

            system, at = file_system(base)
            level = system.get_file_info(pafs.FileSelector(at, allow_not_found=True))
            folders = [("", False), *((f.base_name, True) for f in level if f.type == pafs.FileType.Directory)]
        else:
            walk = low if first else low - timedelta(minutes=self.table.lookback_minutes)
            if self.table.start_at:
                walk = max(walk, self.table.start_at)
            folders = [(f, True) for f in hour_folders(d, walk, high)]
        prefix = self.table.prefix.strip("/") if self.table.prefix else ""
        found = list_objects(self.spark, self.root, [(f"{prefix}/{f}".strip("/"), deep) for f, deep in folders], d.suffix)
        at = lambda t: F.timestamp_micros(F.lit(int((t - datetime(1970, 1, 1, tzinfo=UTC)) / timedelta(microseconds=1))))
        return found.where((F.col("modified") >= at(low) if first else F.col("modified") > at(low)) & (F.col("modified") <= at(high)))

    def extract(self, previous: WatermarkCheckpoint | None, current: WatermarkCheckpoint) -> DataFrame:
        """The window's records. What is listed is stored first, so that all that reads the frame meets the same objects."""
        objects = stored(self.objects(previous, current), "listing")
        limit = self.document.max_object_bytes
        total = objects.agg(F.sum("size_bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("size_bytes") > limit, F.col("key"))).alias("large")).first()
        if total["large"] is not None:
            raise SourceError(f"{total['large']} is larger than {limit} bytes")
        if not total["n"]:
            return self.spark.createDataFrame([], _ddl(landed_columns(self.table, self.document)))
        return decode_files(objects.repartition(min(total["n"], max(1, -(-total["bytes"] // TASK_BYTES)))), self.bucket, self.table, self.document)

    def metadata(self) -> dict:
        return {"bucket": self.bucket, "prefix": self.table.prefix, "suffix": self.discovery.suffix, "discovery_type": self.discovery.type}


def build(spark: SparkSession, config: Config, table: Table, credentials: dict, clock) -> JsonFilesSource:
    root = credentials.get("root", "/")
    return JsonFilesSource(spark, credentials.get("bucket", "local"), root, table, config.discovery, config.document, clock)
