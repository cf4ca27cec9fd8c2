"""Bronze tables: history as a log of snapshots over Parquet folders.

A snapshot names the table's columns, its partition spec and one entry for each merged run (folder and range of partition
values). It is created exclusively under the next number, so a merge is there as a whole or not at all, and of two writers one
loses and may try again. Data that no snapshot names doesn't exist. A snapshot's file holds what it added; every FULL-th holds all
entries, so a merge writes and reads little however many runs came before.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.control.config import partition_transform
from sluice.control.errors import IngestError, SchemaChangeError
from sluice.control.manifest import CommittedRun
from sluice.operators.merge import partition_value, unmatched


def catalog_name(kind: str) -> str:
    """The catalog type of a type name in a manifest, for single names; drift.catalog_type is the same for columns."""
    from sluice.operators.drift import CATALOG_TYPES

    plain = "".join(kind.split()).lower()
    if plain.startswith("decimal"):
        inner = plain[plain.index("(") + 1 : plain.rindex(")")].split(",")
        return f"decimal({inner[0]},{inner[1] if len(inner) > 1 else 0})"
    if plain.startswith("timestamp"):
        return "timestamp"
    return CATALOG_TYPES.get(plain, "string")


def spark_type(catalog: str) -> str:
    return "timestamp_ntz" if catalog == "timestamp" else catalog


def union_schemas(runs: list[CommittedRun]) -> list[tuple[str, str]]:
    """(column, catalog type) over all committed runs: the newest run's columns in its order, then what only older ones had.

    Names are the same in any letter case. Two types of one column are an error: nothing is widened on the quiet.
    """
    out: dict[str, tuple[str, str, str]] = {}
    for run in reversed(runs):
        for f in run.manifest.schema or []:
            key, kind = f["name"].lower(), catalog_name(f["type"])
            if key not in out:
                out[key] = (f["name"], kind, run.run_id)
            elif out[key][1] != kind:
                raise SchemaChangeError(f"column {f['name']}: {out[key][1]} in run {out[key][2]}, {kind} in run {run.run_id}")
    return [(name, kind) for name, kind, _ in out.values()]


def diff(have: dict[str, str], want: list[tuple[str, str]], overrides: dict[str, str] | None = None) -> tuple[list[tuple[str, str]], list[tuple[str, str, str]]]:
    """(added, changed) columns. Columns that are gone don't count; a declared override counts as unchanged only if the catalog
    has exactly it."""
    low = {k.lower(): v for k, v in have.items()}
    over = {k.lower(): v for k, v in (overrides or {}).items()}
    added, changed = [], []
    for name, kind in want:
        key = name.lower()
        if key not in low:
            added.append((key, kind))
        elif "".join(low[key].lower().split()) not in ("".join(kind.lower().split()), *(["".join(over[key].lower().split())] if key in over else [])):
            changed.append((key, low[key], kind))
    return added, changed


#: Versions from one file with all entries to the next.
FULL = 32


@dataclass(frozen=True)
class Snapshot:
    version: int
    columns: tuple[tuple[str, str], ...]
    partition_by: tuple[str, ...]
    entries: tuple[dict, ...] = ()

    def to_json(self, added: tuple[dict, ...] | None) -> str:
        head = {"version": self.version, "columns": self.columns, "partition_by": self.partition_by}
        return json.dumps(head | ({"entries": self.entries} if added is None or self.version % FULL == 1 else {"added": added}), indent=1)


def _bound(value: object) -> tuple[str, object] | None:
    """A partition value as (sort of value, JSON value of the same order within its sort); None for sorts without one."""
    if isinstance(value, bool) or value is None or isinstance(value, float):
        return None
    if isinstance(value, (int, Decimal)):
        return "number", str(value)
    if isinstance(value, datetime):
        return "time", value.isoformat(sep=" ", timespec="microseconds")
    if isinstance(value, date):
        return "date", value.isoformat()
    return ("text", value) if isinstance(value, str) else None


def _meets(a: list | None, b: list | None) -> bool:
    """Whether two ranges (sort, low, high) may share a value; ranges that aren't known or of different sorts may."""
    if not a or not b or a[0] != b[0]:
        return True
    of = Decimal if a[0] == "number" else str
    return of(a[1]) <= of(b[2]) and of(b[1]) <= of(a[2])


class BronzeTable:
    def __init__(self, spark: SparkSession, files, location: str, name: str, watermark: str) -> None:
        self.spark, self.files, self.root, self.name, self.watermark = spark, files, f"{location.rstrip('/')}/{name}", name, watermark

    def snapshot(self) -> Snapshot | None:
        versions = [int(n[1:-5]) for n in self.files.names(f"{self.root}/snapshots") if n.startswith("v") and n.endswith(".json")]
        if not versions:
            if self.files.exists(f"{self.root}/data"):
                raise IngestError(f"{self.name}: data without a snapshot; refusing to start over")
            return None
        return self._load(max(versions))

    def _file(self, version: int) -> str:
        return f"{self.root}/snapshots/v{version}.json"

    def _load(self, version: int) -> Snapshot:
        entries, at = [], version
        head = d = json.loads(self.files.read(self._file(version)))
        while "entries" not in d:
            entries += reversed(d["added"])
            at -= 1
            d = json.loads(self.files.read(self._file(at)))
        return Snapshot(version, tuple(map(tuple, head["columns"])), tuple(head["partition_by"]), (*d["entries"], *reversed(entries)))

    def _commit(self, s: Snapshot, *added: dict) -> Snapshot:
        s = replace(s, entries=s.entries + added)
        if not self.files.create(self._file(s.version), s.to_json(added)):
            raise IngestError(f"{self.name}: somebody else wrote snapshot {s.version}")
        return s

    def compact(self, below_rows: int = 1_000_000) -> int:
        """Writes the rows of all entries of less than ``below_rows`` anew as one entry, laid out by the spec with files of a good size, and returns
        how many entries that replaced. The table's rows stay the same; older snapshots can still be read, as nothing is deleted."""
        s = self.snapshot()
        if s is None:
            raise IngestError(f"no table {self.name}")
        small = [e for e in s.entries if e["rows"] < below_rows]
        if len(small) < 2:
            return 0
        path = f"data/compacted/{uuid.uuid4().hex}"
        n = self._write(self._read(s, small), s, path)
        if n != sum(e["rows"] for e in small):
            raise IngestError(f"{self.name}: {n} rows instead of {sum(e['rows'] for e in small)} while compacting")
        ranges = [e["range"] for e in small]
        of = Decimal if all(ranges) and ranges[0][0] == "number" else str
        joint = [ranges[0][0], min((r[1] for r in ranges), key=of), max((r[2] for r in ranges), key=of)] if all(ranges) and len({r[0] for r in ranges}) == 1 else None
        done = Snapshot(s.version + 1, s.columns, s.partition_by, (*(e for e in s.entries if e not in small), {"run_id": None, "path": path, "rows": n, "range": joint}))
        if not self.files.create(self._file(done.version), done.to_json(None)):
            raise IngestError(f"{self.name}: somebody else wrote snapshot {done.version}")
        return len(small)

    def pointer(self) -> str | None:
        """The file of the latest snapshot."""
        s = self.snapshot()
        return s and self._file(s.version)

    def ensure(self, columns: list[tuple[str, str]], partition_by: tuple[str, ...], overrides: dict[str, str] | None = None) -> bool:
        """Creates the table or adds columns; True if it was created. Any other change is refused before anything is added.
        The partition spec counts at creation only; entries on columns that the table lacks are dropped."""
        if not columns:
            raise IngestError(f"{self.name}: no schema to create a table from")
        low = [n.lower() for n, _ in columns]
        if len(set(low)) != len(low):
            raise SchemaChangeError(f"{self.name}: columns that differ in letter case only")
        want = [(n.lower(), (overrides or {}).get(n.lower(), k)) for n, k in columns]
        now = self.snapshot()
        if now is None:
            spec = tuple(s for s in partition_by if partition_transform(s, self.watermark)[2].lower() in low)
            self._commit(Snapshot(1, tuple(want), spec))
            return True
        added, changed = diff(dict(now.columns), want, overrides)
        if changed:
            raise SchemaChangeError(f"{self.name}: " + "; ".join(f"{c} was {a} and would be {b}" for c, a, b in changed))
        if added:
            self._commit(replace(now, version=now.version + 1, columns=now.columns + tuple(added)))
        return False

    def _hidden(self, s: Snapshot) -> list[tuple[str, object]]:
        types = {n: k for n, k in s.columns}
        return [partition_value(p, self.watermark, types) for p in s.partition_by]

    def _read(self, s: Snapshot, entries, columns: list[str] | None = None) -> DataFrame:
        wanted = [(n, k) for n, k in s.columns if columns is None or n in columns]
        schema = ", ".join(f"`{n}` {spark_type(k)}" for n, k in wanted)
        if not entries:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[f"{self.root}/{e['path']}" for e in entries])

    def read(self, version: Snapshot | None = None) -> DataFrame:
        """The table's rows, as of the latest or a given snapshot. Runs that lacked a column have nulls there."""
        s = version or self.snapshot()
        if s is None:
            raise IngestError(f"no table {self.name}")
        return self._read(s, s.entries)

    def _write(self, rows: DataFrame, s: Snapshot, path: str) -> int:
        """Writes rows below the table, in folders of their partition values, and returns how many there were."""
        hidden = self._hidden(s)
        names = [n for n, _ in hidden]
        seen = Observation()
        laid_out = rows.select("*", *[v.alias(n) for n, v in hidden])
        laid_out = laid_out.hint("rebalance", *names) if names else laid_out
        laid_out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").partitionBy(*names).option("compression", "snappy").parquet(f"{self.root}/{path}")
        return seen.get["n"]

    def _range(self, rows: DataFrame, s: Snapshot, keys: list[str]) -> tuple[list | None, bool]:
        """(sort, low and high of the first partition value over rows, None where unknown; whether rows with values exist).

        Only a partition value that follows from the key bounds a merge: rows of the same key then have the same value."""
        hidden = self._hidden(s)
        if not hidden or partition_transform(s.partition_by[0], self.watermark)[2].lower() not in keys:
            return None, True
        low, high = (_bound(v) for v in rows.agg(F.min(hidden[0][1]), F.max(hidden[0][1])).first())
        return ([low[0], low[1], high[1]], True) if low and high else (None, rows.where(hidden[0][1].isNotNull()).limit(1).count() > 0)

    def merge(self, run: DataFrame, run_id: str, primary_key: list[str]) -> int:
        """Adds the run's rows whose key isn't there, and returns how many. A run merged before adds nothing, whatever the partition
        spec; rows with a null in the key match nothing and are added.

        Where the first partition value follows from the key, only runs whose range of it overlaps this run's are read for matching.
        The rows are laid out by the partition spec, with files of a good size (one shuffle of the new rows).
        """
        s = self.snapshot()
        keys = [k.lower() for k in (*primary_key, self.watermark)]
        if not primary_key:
            raise IngestError(f"{self.name}: a merge needs a primary key")
        low = run.toDF(*[c.lower() for c in run.columns])
        known = dict(s.columns)
        missing = [k for k in keys if k not in low.columns]
        if missing:
            raise IngestError(f"{self.name}: run {run_id} lacks {', '.join(missing)}")
        if extra := [c for c in low.columns if c not in known]:
            raise SchemaChangeError(f"{self.name}: run {run_id} has columns that the table lacks: {', '.join(extra)}")
        rows = low.select(*[F.col(f"`{c}`").cast(spark_type(known[c])).alias(c) for c in low.columns])
        bounds, any_key = self._range(rows, s, keys)
        entries = [e for e in s.entries if _meets(e["range"], bounds)] if any_key else []
        fresh = unmatched(rows, self._read(s, entries, keys), keys)
        path = f"data/run={run_id}/{uuid.uuid4().hex}"
        n = self._write(fresh, s, path)
        if n:
            self._commit(replace(s, version=s.version + 1), {"run_id": run_id, "path": path, "rows": n, "range": bounds})
        return n


def bronze_name(source_key: str, table: str, prefix: str = "source_key") -> str:
    return (f"{source_key}_{table}" if prefix == "source_key" else table).lower()


def check_not_stranded(files, location: str, source_key: str, table: str, prefix: str) -> None:
    """Refuses to create a second table beside one that has the other spelling of its name."""
    mine, other = (bronze_name(source_key, table, p) for p in (prefix, "none" if prefix == "source_key" else "source_key"))
    if files.exists(f"{location}/{other}/snapshots") and not files.exists(f"{location}/{mine}/snapshots"):
        raise IngestError(f"table {other} is there already; {mine} would strand it")


def run_rows(spark: SparkSession, run: CommittedRun) -> DataFrame:
    """The rows of exactly one committed run, in the schema its manifest records, from the files it names."""
    schema = ", ".join(f"`{f['name']}` {spark_type(catalog_name(f['type']))}" for f in run.manifest.schema or [])
    return spark.read.schema(schema).parquet(*[f"{run.folder}/{n.rsplit('/', 1)[-1]}" for n in run.manifest.files])



def register_landing(spark: SparkSession, name: str, root: str, columns: list[tuple[str, str]], runs: list[CommittedRun]) -> None:
    """Makes committed runs readable as one partitioned SQL table: created if it isn't there, each run a partition, those that are
    registered already left alone. Both partition columns are text, as paths would make a date of one."""
    q = lambda n: "`" + n.replace("`", "``") + "`"
    path = lambda p: "'" + p.replace("\\", "\\\\").replace("'", "\\'") + "'"
    table = ".".join(map(q, name.split(".")))
    cells = ", ".join(f"{q(c.lower())} {spark_type(k)}" for c, k in columns)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cells}, ingest_date string, run_id string) USING parquet PARTITIONED BY (ingest_date, run_id) LOCATION {path(root)}")
    have = {c.name for c in spark.catalog.listColumns(name)}
    if added := [(c.lower(), k) for c, k in columns if c.lower() not in have]:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'{q(c)} {spark_type(k)}' for c, k in added)})")
    for r in runs:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (ingest_date={path(r.ingest_date)}, run_id={path(r.run_id)}) LOCATION {path(r.folder)}")
