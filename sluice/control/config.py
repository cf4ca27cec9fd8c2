"""Configuration: one YAML file a source. Everything wrong with its keys is reported at once."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from pathlib import Path
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from sluice.control.errors import ConfigurationError
from sluice.control.state import checkpoint_class

LINEAGE = ("_ingest_run_id", "_ingested_at", "_source_system", "_source_database", "_source_schema", "_source_table")
RECORD_COLUMNS = ("_source_record_id", "_s3_bucket", "_s3_key", "_s3_etag", "envelope_json", "payload_json", "_s3_record_index", "_s3_last_modified")
#: Columns that a CloudEvents envelope gives, with the attribute each takes. Fixed values.
CLOUDEVENTS = {"event_type": "type", "event_specversion": "specversion", "event_source": "source", "event_id": "id", "event_time": "time", "data_content_type": "datacontenttype"}
#: What a preset stands for. Fixed values.
PRESETS = {
    "cloudevents": ("cloudevents", {"path": "data_base64", "encoding": "base64", "compression": "auto"}),
    "cloudevents_plain": ("cloudevents", {"path": "data", "encoding": "none", "compression": "none"}),
    "records": ("none", {"path": None, "encoding": "none", "compression": "none"}),
}
CODECS, FRAMINGS, ENCODINGS, DISCOVERIES = ("none", "gzip", "zlib", "auto"), ("object", "array", "jsonl", "auto"), ("none", "base64"), ("time_partitioned", "full_prefix")
MIB = 1 << 20
_TRANSFORM = re.compile(r"(?:(year|month|day|hour)\(\s*([\w{}]+)\s*\)|(bucket|truncate)\(\s*(\d+)\s*,\s*([\w{}]+)\s*\)|([\w{}]+))")
_COLUMN = re.compile(r"[a-z_][a-z0-9_]*")


@dataclass(frozen=True)
class Discovery:
    type: str = "time_partitioned"
    path_format: str = "%Y/%m/%d/%H"
    timezone: str = "UTC"
    suffix: str = ".json.gz"
    safety_delay_seconds: int = 120
    prefetch: int = 8
    max_window_hours: int | None = None
    lookahead_hours: int = 1


@dataclass(frozen=True)
class Payload:
    path: str | None = None
    encoding: str = "none"
    compression: str = "none"
    format: str = "json"


@dataclass(frozen=True)
class Document:
    envelope: str = "none"
    compression: str = "gzip"
    records: str = "auto"
    payload: Payload = Payload()
    max_object_bytes: int = 32 * MIB
    max_outer_bytes: int = 128 * MIB
    max_payload_bytes: int = 16 * MIB
    batch_bytes: int = 64 * MIB


@dataclass(frozen=True)
class Table:
    name: str
    object: str
    primary_key: tuple[str, ...]
    watermark: str
    lookback_minutes: int = 0
    database: str | None = None
    schema: str | None = None
    prefix: str | None = None
    start_at: datetime | None = None
    envelope_fields: tuple[tuple[str, str], ...] = ()
    column_types: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Bronze:
    database: str
    location: str
    processed_runs_table: str | None = None
    partition_by: tuple[str, ...] = ("month({checkpoint_column})",)
    table_prefix: str = "source_key"


@dataclass(frozen=True)
class Config:
    name: str
    type: str
    tables: tuple[Table, ...]
    landing: str | None = None
    checkpoint_table: str | None = None
    secret_id: str | None = None
    bronze: Bronze | None = None
    discovery: Discovery = Discovery()
    document: Document = Document()
    fetch_size: int = 10_000
    fail_fast: bool = False

    @property
    def source_key(self) -> str:
        return f"{self.name}_{self.type}"

    def select(self, names: str) -> tuple[Table, ...]:
        """``all``, or the tables of a comma list, in the configuration's order."""
        if names.strip() == "all":
            return self.tables
        wanted = [n.strip() for n in names.split(",") if n.strip()]
        if unknown := sorted(set(wanted) - {t.name for t in self.tables}):
            raise ConfigurationError(f"no such tables: {', '.join(unknown)}")
        return tuple(t for t in self.tables if t.name in wanted)


def resolve(*values, default=None):
    """The first value that is given: command line, then configuration, then default."""
    return next((v for v in values if v is not None), default)


def boolean(value) -> bool:
    if isinstance(value, bool):
        return value
    words = {"true": True, "yes": True, "on": True, "1": True, "false": False, "no": False, "off": False, "0": False}
    try:
        return words[str(value).strip().lower()]
    except KeyError:
        raise ConfigurationError(f"{value!r} is neither yes nor no") from None


def split_uri(uri: str) -> tuple[str, str, str]:
    """(scheme, bucket, prefix without slashes around it) of an address like ``s3://bucket/some/folder/``."""
    m = re.fullmatch(r"([a-z][a-z0-9+.-]*)://([^/\s]+)(?:/(.*))?", uri.strip() if isinstance(uri, str) else "")
    if not m:
        raise ConfigurationError(f"{uri!r} isn't an address of the form scheme://bucket/prefix")
    return m[1], m[2], (m[3] or "").strip("/")


def partition_transform(spec: str, watermark: str | None = None) -> tuple[str, int | None, str]:
    """(transform, width, column) of an entry of partition_by; arguments are checked, too."""
    m = _TRANSFORM.fullmatch(spec.strip())
    if not m:
        raise ConfigurationError(f"unusable partition spec {spec!r}")
    name, width, column = (m[1], None, m[2]) if m[1] else (m[3], int(m[4]), m[5]) if m[3] else ("identity", None, m[6])
    if width == 0:
        raise ConfigurationError(f"{spec!r}: a width of 0")
    if column == "{checkpoint_column}" and watermark:
        column = watermark
    elif "{" in column and column != "{checkpoint_column}":
        raise ConfigurationError(f"{spec!r}: unknown placeholder")
    return name, width, column


class _Reader:
    """Takes known keys out of a section and remembers what is wrong with the rest."""

    def __init__(self) -> None:
        self.problems: list[str] = []

    def section(self, name: str, data, known: tuple[str, ...]) -> dict:
        if data is None:
            return {}
        if not isinstance(data, dict):
            self.problems.append(f"`{name}` must be a mapping")
            return {}
        for key in sorted(map(str, set(data) - set(known))):
            where = f"{name}.{key}" if name else key
            self.problems.append(f"`{where}` isn't a setting; known: {', '.join(sorted(known))}")
        return data

    def number(self, name: str, value, low: int, high: int) -> int:
        if isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high:
            self.problems.append(f"`{name}` must be a whole number from {low} to {high}, not {value!r}")
            return low
        return value

    def choice(self, name: str, value, of: tuple) -> str:
        if value not in of:
            self.problems.append(f"`{name}` must be one of {', '.join(map(str, of))}, not {value!r}")
            return of[0]
        return value

    def done(self) -> None:
        if self.problems:
            raise ConfigurationError("; ".join(self.problems))


def _discovery(r: _Reader, data: dict) -> Discovery:
    keys = ("type", "path_format", "timezone", "suffix", "safety_delay_seconds", "prefetch", "max_window_hours", "lookahead_hours")
    d = r.section("source.discovery", data, keys)
    kind = r.choice("source.discovery.type", d.get("type", "time_partitioned"), DISCOVERIES)
    if kind == "full_prefix":
        for k in ("path_format", "timezone", "lookahead_hours"):
            if k in d:
                r.problems.append(f"`source.discovery.{k}` has no meaning with full_prefix")
    suffix = d.get("suffix", ".json.gz")
    if not isinstance(suffix, str) or not suffix:
        r.problems.append("`source.discovery.suffix` must not be empty")
    form, zone = d.get("path_format", "%Y/%m/%d/%H"), d.get("timezone", "UTC")
    day = datetime(2026, 1, 15, tzinfo=UTC)
    if kind == "time_partitioned" and len({(day + timedelta(hours=h)).strftime(form) for h in range(24)}) < 24:
        r.problems.append(f"`source.discovery.path_format` {form!r} doesn't tell the hours of a day apart")
    try:
        ZoneInfo(zone)
    except (ZoneInfoNotFoundError, ValueError, TypeError, OSError):
        r.problems.append(f"`source.discovery.timezone` {zone!r} is unknown")
    window = d.get("max_window_hours")
    return Discovery(kind, form, zone, suffix, r.number("source.discovery.safety_delay_seconds", d.get("safety_delay_seconds", 120), 1, 3600), r.number("source.discovery.prefetch", d.get("prefetch", 8), 1, 32),
                     None if window is None else r.number("source.discovery.max_window_hours", window, 1, 8784), r.number("source.discovery.lookahead_hours", d.get("lookahead_hours", 1), 0, 24))


def _document(r: _Reader, data: dict) -> Document:
    limits = ("max_object_bytes", "max_outer_bytes", "max_payload_bytes", "batch_bytes")
    d = r.section("source.document", data, ("preset", "compression", "records", "payload", *limits))
    envelope, base = PRESETS[r.choice("source.document.preset", d.get("preset", "records"), tuple(PRESETS))]
    p = base | r.section("source.document.payload", d.get("payload"), ("path", "encoding", "compression", "format"))
    payload = Payload(p["path"], r.choice("source.document.payload.encoding", p["encoding"], ENCODINGS), r.choice("source.document.payload.compression", p["compression"], CODECS), r.choice("source.document.payload.format", p.get("format", "json"), ("json",)))
    if payload.path is None and (payload.encoding != "none" or payload.compression != "none"):
        r.problems.append("an encoded or compressed payload needs `source.document.payload.path`")
    sizes = {k: r.number(f"source.document.{k}", d[k], MIB, 512 * MIB) for k in limits if k in d}
    return Document(envelope, r.choice("source.document.compression", d.get("compression", "gzip"), CODECS), r.choice("source.document.records", d.get("records", "auto"), FRAMINGS), payload, **sizes)


def _start(r: _Reader, where: str, value) -> datetime | None:
    try:
        at = value if isinstance(value, datetime) else datetime.fromisoformat(str(value))
        if at.tzinfo is None or (isinstance(value, str) and "T" not in value):
            raise ValueError
        return at.astimezone(UTC)
    except ValueError:
        r.problems.append(f"`{where}.start_at` must be an ISO time with T and zone, not {value!r}")
        return None


def _table(r: _Reader, data, source: dict, feed: bool, discovery: Discovery, envelope: str) -> Table | None:
    name = data.get("name") if isinstance(data, dict) else None
    where = f"tables.{name}"
    common = ("name", "checkpoint", "bronze_column_types")
    d = r.section(where, data, (*common, *(("prefix", "start_at", "envelope_fields") if feed else ("object", "database", "schema", "primary_key"))))
    c = r.section(f"{where}.checkpoint", d.get("checkpoint"), ("type", "column", "lookback_minutes"))
    if not name:
        r.problems.append("a table has no name")
        return None
    if not feed and "checkpoint" not in d:
        r.problems.append(f"`{where}` has no checkpoint")
    try:
        checkpoint_class(c.get("type", "watermark"))
    except ConfigurationError as e:
        r.problems.append(f"`{where}`: {e}")
    lookback = r.number(f"{where}.checkpoint.lookback_minutes", c.get("lookback_minutes", 15 if feed else 0), 1 if feed and discovery.type == "time_partitioned" else 0, 525_600)
    types = d.get("bronze_column_types") or {}
    if feed:
        fields = []
        for column, path in (d.get("envelope_fields") or {}).items():
            taken = {*LINEAGE, *RECORD_COLUMNS, *(CLOUDEVENTS if envelope == "cloudevents" else ())}
            if not _COLUMN.fullmatch(str(column)) or column in taken:
                r.problems.append(f"`{where}.envelope_fields`: {column!r} can't be a column")
            elif not isinstance(path, str) or not all(path.split(".")):
                r.problems.append(f"`{where}.envelope_fields.{column}` must be a dotted path")
            else:
                fields.append((column, path))
        if d.get("start_at") is None:
            r.problems.append(f"`{where}` has no start_at")
        start = _start(r, where, d["start_at"]) if d.get("start_at") is not None else None
        return Table(name, str(d.get("prefix", "")).strip("/"), ("_source_record_id",), "_s3_last_modified", lookback, prefix=str(d.get("prefix", "")).strip("/"), start_at=start, envelope_fields=tuple(fields), column_types=types)
    if not c.get("column"):
        r.problems.append(f"`{where}.checkpoint` has no column")
    key = d.get("primary_key") or []
    if not d.get("object"):
        r.problems.append(f"`{where}` has no object")
    return Table(name, d.get("object", ""), tuple(key if isinstance(key, list) else [key]), c.get("column", ""), lookback, d.get("database", source.get("database")), d.get("schema", source.get("schema")), column_types=types)


def parse(data: dict, feed_types: tuple[str, ...] = ("json_files", "s3_json")) -> Config:
    """A configuration from its mapping. Raises one ConfigurationError with all problems."""
    if not isinstance(data, dict):
        raise ConfigurationError("the configuration must be a mapping")
    r = _Reader()
    top = r.section("", data, ("source", "connection", "landing", "bronze", "tables", "fetch_size", "fail_fast"))
    s = top.get("source")
    feed = isinstance(s, dict) and s.get("type") in feed_types
    s = r.section("source", s, ("name", "type", *(("discovery", "document") if feed else ("database", "schema"))))
    for k in ("name", "type"):
        if not s.get(k):
            r.problems.append(f"`source.{k}` is missing")
    connection = r.section("connection", top.get("connection"), ("secret_id",))
    if feed and connection:
        r.problems.append("`connection` has no meaning for a document feed")
    if not feed and s.get("type") and not connection.get("secret_id"):
        r.problems.append("`connection.secret_id` is missing")
    landing = r.section("landing", top.get("landing"), ("location", "checkpoint_table"))
    discovery, document = (_discovery(r, s.get("discovery")), _document(r, s.get("document"))) if feed else (Discovery(), Document())
    rows = top.get("tables")
    if not isinstance(rows, list) or not rows:
        r.problems.append("`tables` must list at least one table")
        rows = []
    tables = [t for t in (_table(r, x, s, feed, discovery, document.envelope) for x in rows) if t]
    for label, values in (("name", [t.name for t in tables]), ("source object", [(t.database, t.schema, t.object.lower()) for t in tables])):
        for value, n in Counter(values).items():
            if n > 1:
                r.problems.append(f"{n} tables have the {label} {value!r}")
    bronze = None
    if "bronze" in top:
        b = r.section("bronze", top["bronze"], ("database", "location", "processed_runs_table", "partition_by", "table_prefix"))
        for k in ("database", "location"):
            if not b.get(k):
                r.problems.append(f"`bronze.{k}` is missing")
        spec = b.get("partition_by", list(Bronze.partition_by))
        for entry in spec or ():
            try:
                partition_transform(str(entry))
            except ConfigurationError as e:
                r.problems.append(f"`bronze.partition_by`: {e}")
        bronze = Bronze(b.get("database", ""), str(b.get("location", "")).rstrip("/"), b.get("processed_runs_table"), tuple(spec or ()), r.choice("bronze.table_prefix", b.get("table_prefix", "source_key"), ("source_key", "none")))
    for where, value in (("landing.location", landing.get("location")), ("bronze.location", bronze and bronze.location)):
        if value and "://" in str(value):
            try:
                split_uri(str(value))
            except ConfigurationError as e:
                r.problems.append(f"`{where}`: {e}")
    fetch = r.number("fetch_size", top.get("fetch_size", 10_000), 1, 10_000_000)
    r.done()
    location = landing.get("location")
    return Config(s["name"], s["type"], tuple(tables), location and str(location).rstrip("/"), landing.get("checkpoint_table"), connection.get("secret_id"), bronze, discovery, document, fetch, boolean(top.get("fail_fast", False)))


def load(path: str, files=None) -> Config:
    """The configuration in a YAML file."""
    import yaml

    text = files.read(path) if files else Path(path).read_text(encoding="utf-8")
    if text is None:
        raise ConfigurationError(f"no configuration at {path}")
    try:
        return parse(yaml.safe_load(text))
    except yaml.YAMLError as e:
        raise ConfigurationError(f"{path} is no YAML: {e}") from None
