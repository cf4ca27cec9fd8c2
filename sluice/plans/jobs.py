"""The two jobs: landing (source to sealed run to checkpoint) and bronze (sealed runs to history)."""

from __future__ import annotations

import argparse
import contextlib
import logging
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from sluice.control import config as conf
from sluice.control import secrets
from sluice.control.catalog import Entry, FileCatalog
from sluice.control.errors import ConfigurationError, IngestError, SchemaChangeError, StatementError, WatermarkRegressionError
from sluice.control.files import LocalFiles, files_for
from sluice.control.manifest import Manifest, commit, committed_runs, run_folder
from sluice.control.state import CheckpointStore, FileCheckpointStore, FileLedger, NullLedger, RunLedger, StateRecord
from sluice.functions.watermarks import regressed
from sluice.operators import bronze
from sluice.operators.landing import LandingRun
from sluice.session import release
from sluice.sources.base import Source, factory

log = logging.getLogger("sluice")
Clock = Callable[[], datetime]
#: Seconds that one merge may take.
STATEMENT_S = 3600


def now() -> datetime:
    return datetime.now(UTC)


def setup_logging(level: int = logging.INFO) -> logging.Logger:
    """The package's logger to standard output; the root logger stays as it is, and a second call changes nothing."""
    if not log.handlers:
        handler = logging.StreamHandler(sys.stdout)
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(handler)
        log.propagate = False
    log.setLevel(level)
    return log


@dataclass(frozen=True)
class TableResult:
    table: str
    status: str  # SUCCESS, SKIPPED or FAILED
    rows: int = 0
    run_id: str | None = None
    detail: str = ""
    caught_up: bool = True


def run_table(source: Source, table: conf.Table, source_key: str, landing: str, store: CheckpointStore, files=None, clock: Clock = now, new_id: Callable[[], str] = lambda: str(uuid.uuid4())) -> TableResult:
    """One window of one table, as a transaction: bound, extract, parts, manifest, checkpoint. Nothing before the manifest is
    committed, and no failure moves the checkpoint."""
    files = files or LocalFiles()
    state = store.get(source_key, table.name)
    previous = state.checkpoint if state.checkpoint and state.checkpoint.value is not None else None
    bound = source.current_checkpoint(previous)  # before anything is extracted
    if bound is None:
        return TableResult(table.name, "SKIPPED", detail="nothing there")
    if previous and bound.value == previous.value and not table.lookback_minutes:
        return TableResult(table.name, "SKIPPED", detail="nothing new")
    if previous and regressed(bound.value_type or "", previous.value, bound.value):
        raise WatermarkRegressionError(f"{table.name}: the source went back from {previous.value} to {bound.value}")
    caught_up, started, run_id = source.caught_up(bound), clock(), new_id()
    folder = run_folder(landing, source_key, table.name, started.date().isoformat(), run_id)
    meta = source.metadata()
    run = LandingRun(files, folder, run_id, (source_key, meta.get("database"), meta.get("schema"), meta.get("table") or table.name), started)
    run.write(source.extract(previous, bound), source.schema())
    parts = run.parts()
    manifest = Manifest(run_id, source_key, meta, list(table.primary_key), {"type": bound.type, "column": bound.column, "previous": previous and previous.value, "high": bound.value}, "incremental" if previous else "full",
                        started.isoformat(timespec="seconds"), clock().isoformat(timespec="seconds"), run.row_count, len(parts), [f"{folder}/{p}" for p in parts], run.recorded_schema(), run.drift)
    commit(files, folder, manifest)
    store.commit(source_key, table.name, state.version, StateRecord(bound, 0, run_id, folder, run.row_count, len(parts), clock().isoformat(timespec="seconds")))
    return TableResult(table.name, "SUCCESS", run.row_count, run_id, caught_up=caught_up)


@contextlib.contextmanager
def utc(spark: SparkSession) -> Iterator[None]:
    """A session whose zone is UTC, as long as a job runs: windows, lineage and zone-less times mean the same everywhere."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def run_job(spark: SparkSession, config: conf.Config, tables: str = "all", landing: str | None = None, state: str | None = None, expected_type: str | None = None, fail_fast: bool | None = None, credentials: Callable[[str | None], dict] | None = None, files=None,
            clock: Clock = now, new_id: Callable[[], str] = lambda: str(uuid.uuid4())) -> list[TableResult]:
    """Lands the selected tables, each until it is caught up. Arguments win over the configuration. Places may be mounted folders or any
    addresses the session's Hadoop client reaches; credentials come from its providers unless a callable gives them."""
    with utc(spark):
        return _run_job(spark, config, tables, conf.resolve(landing, config.landing), conf.resolve(state, config.checkpoint_table), expected_type, fail_fast, credentials or secrets.from_session(spark), files, clock, new_id)


def _run_job(spark, config, tables, landing, state, expected_type, fail_fast, credentials, files, clock, new_id) -> list[TableResult]:
    files = files or files_for(spark, landing, state)
    if expected_type and config.type != expected_type:
        raise ConfigurationError(f"this job loads {expected_type}, the configuration is for {config.type}")
    if not landing or not state:
        raise ConfigurationError("landing.location and landing.checkpoint_table are needed")
    chosen, build = config.select(tables), factory(config.type)
    secret = credentials(config.secret_id)
    store, results = FileCheckpointStore(files, state), []
    for table in chosen:
        source = None
        try:
            source = build(spark, config, table, secret, clock)
            while True:
                result = run_table(source, table, config.source_key, landing, store, files, clock, new_id)
                results.append(result)
                if result.caught_up:  # the cap decides, not the clock, so a moving clock can't keep the loop alive
                    break
        except Exception as e:
            log.error("%s failed: %s", table.name, e)
            results.append(TableResult(table.name, "FAILED", detail=f"{type(e).__name__}: {e}"))
            if conf.resolve(fail_fast, config.fail_fast):
                break
        finally:
            if source is not None:
                source.close()
            release(spark, "listing", "landing")
    for r in results:
        log.info("%-30s %-8s %8d rows %s", r.table, r.status, r.rows, r.detail)
    return results


@dataclass(frozen=True)
class RunResult:
    table: str
    run_id: str
    status: str  # MERGED, SKIPPED_ALREADY_PROCESSED, SKIPPED_EMPTY or FAILED
    rows: int = 0
    detail: str = ""


def publish(catalog: FileCatalog, target: bronze.BronzeTable, types: dict[str, str]) -> None:
    """Makes the catalog's entry that of the table's latest snapshot, then asserts the declared types over it."""
    s, have = target.snapshot(), catalog.get(target.name)
    if have is None or have.metadata_location != target.pointer():
        catalog.put(Entry(target.name, s.columns, (), target.pointer(), have.version_id if have else 0))
    catalog.override(target.name, types)


def load_table_runs(spark: SparkSession, config: conf.Config, table: conf.Table, landing: str, ledger: RunLedger, files=None, timeout_s: float = STATEMENT_S, register: bool = False) -> list[RunResult]:
    """Merges a table's committed runs that aren't merged yet, oldest first. The first failure ends the table; runs behind it
    stay pending. A table of which all runs are empty is not an error: there is nothing to create it from yet.

    The catalog beside the tables is checked before (an entry that points to a snapshot that is gone is refused) and kept up after
    creation and every merge. A merge that takes more than ``timeout_s`` is cancelled and failed. register: also make the
    pending runs readable as a SQL table ``<database>.<table>_landing`` of the session's catalog.
    """
    files = files or files_for(spark, landing, config.bronze.location)
    runs = committed_runs(files, landing, config.source_key, table.name)
    if drifted := [r.run_id for r in runs if r.manifest.schema_drift]:
        raise SchemaChangeError(f"{table.name}: runs with drifted schemas: {', '.join(drifted)}")
    if not runs:
        log.warning("%s has no committed runs", table.name)
        return []
    if (empty := sum(r.manifest.row_count == 0 for r in runs)) > 100:
        log.warning("%s has %d empty runs; a sweep would speed discovery up", table.name, empty)
    b, key = config.bronze, f"{config.source_key}:{table.name}"
    columns = bronze.union_schemas(runs)
    if not columns:
        log.warning("%s: all %d committed runs are empty", table.name, len(runs))
        return [RunResult(table.name, r.run_id, "SKIPPED_EMPTY") for r in runs]
    bronze.check_not_stranded(files, b.location, config.source_key, table.name, b.table_prefix)
    target = bronze.BronzeTable(spark, files, b.location, bronze.bronze_name(config.source_key, table.name, b.table_prefix), table.watermark)
    catalog = FileCatalog(files, f"{b.location}/_catalog")
    catalog.check_metadata(target.name)
    created = target.ensure(columns, b.partition_by, table.column_types)
    publish(catalog, target, table.column_types)
    done = ledger.processed(key)
    if created and done:
        log.warning("%s was created just now; the ledger of %d merged runs doesn't count", target.name, len(done))
        done = set()
    if register and (pending := [r for r in runs if r.run_id not in done and r.manifest.row_count]):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{b.database}`")
        bronze.register_landing(spark, f"{b.database}.{target.name}_landing", f"{landing.rstrip('/')}/{config.source_key}/{table.name}", columns, pending)
    results = []
    for run in runs:
        if run.run_id in done:
            results.append(RunResult(table.name, run.run_id, "SKIPPED_ALREADY_PROCESSED"))
            continue
        rows, status = 0, "SKIPPED_EMPTY"
        if run.manifest.row_count:
            try:
                rows, status = with_timeout(spark, timeout_s, lambda run=run: target.merge(bronze.run_rows(spark, run), run.run_id, list(table.primary_key))), "MERGED"
                publish(catalog, target, table.column_types)
            except Exception as e:
                results.append(RunResult(table.name, run.run_id, "FAILED", detail=f"{type(e).__name__}: {e}"))
                break
        ledger.mark(key, run.run_id, source_row_count=run.manifest.row_count, load_type=run.manifest.load_type, bronze_processed_at=now().isoformat(timespec="seconds"))
        results.append(RunResult(table.name, run.run_id, status, rows))
    return results


def run_bronze_job(spark: SparkSession, config: conf.Config, tables: str = "all", landing: str | None = None, fail_fast: bool | None = None, files=None, timeout_s: float = STATEMENT_S, register: bool = True) -> list[RunResult]:
    """Merges all selected tables; raises at the end if any failed. Without a bronze section there is nothing to do."""
    if config.bronze is None:
        log.warning("%s has no bronze section", config.source_key)
        return []
    landing = conf.resolve(landing, config.landing)
    if not landing:
        raise ConfigurationError("landing.location is needed")
    files = files or files_for(spark, landing, config.bronze.location, config.bronze.processed_runs_table)
    ledger = FileLedger(files, config.bronze.processed_runs_table) if config.bronze.processed_runs_table else NullLedger()
    results: list[RunResult] = []
    with utc(spark):
        for table in config.select(tables):
            try:
                results += load_table_runs(spark, config, table, landing, ledger, files, timeout_s, register)
            except Exception as e:
                results.append(RunResult(table.name, "", "FAILED", detail=f"{type(e).__name__}: {e}"))
            if results and results[-1].status == "FAILED" and conf.resolve(fail_fast, config.fail_fast):
                break
    for r in results:
        log.info("%-30s %-26s %8d rows %s %s", r.table, r.status, r.rows, r.run_id, r.detail)
    if failed := [r for r in results if r.status == "FAILED"]:
        raise IngestError(f"{len(failed)} failed: " + "; ".join(f"{r.table}: {r.detail}" for r in failed))
    return results


def with_timeout(spark: SparkSession, seconds: float, action: Callable[[], object]) -> object:
    """An action's result, or StatementError after the time is up, when its Spark jobs are cancelled."""
    import threading

    tag = f"sluice-{uuid.uuid4().hex}"
    late = threading.Event()

    def stop() -> None:
        late.set()
        spark.sparkContext.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    spark.sparkContext.addJobTag(tag)
    timer.start()
    try:
        return action()
    except IngestError:
        raise
    except Exception as e:
        raise StatementError(f"took more than {seconds:g} s" if late.is_set() else f"failed: {type(e).__name__}") from (None if late.is_set() else e)
    finally:
        timer.cancel()
        spark.sparkContext.removeJobTag(tag)


def main(argv: list[str] | None = None) -> int:
    """Command line of both jobs: ``python -m sluice.plans.jobs landing|bronze --config FILE``."""
    p = argparse.ArgumentParser(prog="sluice")
    p.add_argument("job", choices=("landing", "bronze"))
    p.add_argument("--config", required=True)
    p.add_argument("--tables", default="all")
    p.add_argument("--landing")
    p.add_argument("--state")
    p.add_argument("--source-type")
    p.add_argument("--fail-fast")
    p.add_argument("--secrets", help="folder of secrets as JSON files; the session's credential providers otherwise")
    p.add_argument("--timeout", type=float, default=STATEMENT_S, help="seconds that one merge may take")
    a = p.parse_args(argv)
    setup_logging()
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        config = conf.load(a.config, files_for(spark, a.config) if "://" in a.config else None)
        fail_fast = None if a.fail_fast is None else conf.boolean(a.fail_fast)
        if a.job == "bronze":
            run_bronze_job(spark, config, a.tables, a.landing, fail_fast, timeout_s=a.timeout)
            return 0
        return int(any(r.status == "FAILED" for r in run_job(spark, config, a.tables, a.landing, a.state, a.source_type, fail_fast, a.secrets and secrets.from_folder(files_for(spark, a.secrets), a.secrets))))
    except IngestError as e:
        log.error("%s", e)
        return 1


if __name__ == "__main__":
    sys.exit(main())
