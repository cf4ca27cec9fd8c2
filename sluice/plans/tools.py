"""Command line tools: does a feed keep its folder contract, what do its records look like, which runs are empty.

``python -m sluice.plans.tools contract|census|sweep --help``.
"""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.control.config import Discovery
from sluice.control.files import files_for
from sluice.control.manifest import sweep_empty
from sluice.operators import diagnostics
from sluice.sources.json_files import list_objects


def folder_objects(spark: SparkSession, root: str, d: Discovery, first: datetime, last: datetime) -> DataFrame:
    """(key, folder_hour, modified) of the matching objects in the hour folders between two times, listed by tasks. The folder's hour is the last
    instant its name stands for, so an hour that a zone shows twice ends when it ends the second time."""
    zone, at, hours = ZoneInfo(d.timezone), first, {}
    while at <= last:
        hours[at.astimezone(zone).strftime(d.path_format)] = at
        at += timedelta(hours=1)
    of = spark.createDataFrame([(name, hour.replace(tzinfo=None)) for name, hour in hours.items()], "folder string, folder_hour timestamp_ntz")
    depth = d.path_format.count("/") + 1
    found = list_objects(spark, root, [(name, True) for name in hours], d.suffix)
    found = found.withColumn("folder", F.substring_index("key", "/", depth)).withColumn("modified", F.to_utc_timestamp("modified", F.current_timezone()).cast("timestamp_ntz"))
    return found.join(of, "folder").select("key", "folder_hour", "modified")


def contract(objects: DataFrame, start_s: int, interval_s: int = 900, lookback_s: int = 900, safety_s: int = 120, show: int = 25) -> dict:
    """Lateness, the schedule's replay, and a verdict. What comes to the driver is as small as the report."""
    seen = diagnostics.replay(objects, start_s, interval_s, lookback_s, safety_s).cache()
    try:
        missed = seen.where("not found")
        late = diagnostics.lateness(seen)
        worst = late.agg(F.max("late_seconds")).first()[0]
        report = {"lateness": {r["lateness"]: r["objects"] for r in diagnostics.lateness_histogram(seen).collect()}, "hours": diagnostics.folder_stats(seen).first().asDict(), "early": seen.where("modified < folder_hour").count(),
                  "found": seen.where("found").count(), "missed": missed.count(), "worst_missed": [r.asDict() for r in diagnostics.worst(missed, show, "key").collect()], "worst_late_s": worst}
    finally:
        seen.unpersist()
    report["holds"] = report["missed"] == 0
    report["lookback_minutes_needed"] = None if report["holds"] else int(worst // 60) + interval_s // 60 + 1
    return report


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sluice-tools")
    sub = p.add_subparsers(dest="tool", required=True)
    c = sub.add_parser("contract")
    c.add_argument("--root", required=True)
    c.add_argument("--days", type=int, default=14)
    for name, default in (("tz", "UTC"), ("path-format", "%Y/%m/%d/%H"), ("suffix", ".json.gz")):
        c.add_argument(f"--{name}", default=default)
    for name, default in (("interval", 15), ("lookback", 15), ("safety", 120), ("show", 25)):
        c.add_argument(f"--{name}", type=int, default=default)
    c.add_argument("--fail-on-miss", action="store_true")
    n = sub.add_parser("census")
    n.add_argument("--landed", required=True, help="parquet with envelope_json and payload_json")
    n.add_argument("--id-path", action="append", default=[])
    n.add_argument("--version-path", action="append", default=[])
    n.add_argument("--show-keys", type=int, default=40)
    s = sub.add_parser("sweep")
    s.add_argument("--root", required=True)
    s.add_argument("--delete", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.tool == "sweep":
        for folder in sweep_empty(files_for(spark, a.root), a.root, a.delete):
            print("deleted" if a.delete else "empty", folder)
        return 0
    if a.tool == "census":
        found = diagnostics.census(spark.read.parquet(a.landed), "envelope_json", "payload_json", a.id_path, a.version_path, keys=a.show_keys)
        for r in found.orderBy("measure", F.col("records").desc(), "value").collect():
            print(f"{r['measure']:14} {r['records']:9} {r['value']}")
        block, doubts = diagnostics.document_settings(found)
        print("document:")
        for k, v in block.items():
            print(f"  {k}: {v}" if not isinstance(v, dict) else "\n".join([f"  {k}:", *(f"    {x}: {y}" for x, y in v.items())]))
        print("envelope_fields:", diagnostics.feed_settings(diagnostics.key_census(spark.read.parquet(a.landed), "envelope_json")))
        print("one document block describes this feed" if not doubts else "no one document block describes this feed: " + "; ".join(doubts))
        return 0
    last = datetime.now(UTC)
    first = (last - timedelta(days=a.days)).replace(hour=0, minute=0, second=0, microsecond=0)
    objects = folder_objects(spark, a.root, Discovery(path_format=a.path_format, timezone=a.tz, suffix=a.suffix), first, last)
    low = objects.agg(F.min("modified")).first()[0]
    if low is None:
        print("no objects")
        return 0
    start = int(low.replace(minute=0, second=0, microsecond=0, tzinfo=UTC).timestamp())
    report = contract(objects, start, a.interval * 60, a.lookback * 60, a.safety, a.show)
    for k, v in report.items():
        print(f"{k}: {v}")
    print("the contract holds" if report["holds"] else "the contract is violated: folder walks would miss objects")
    return int(a.fail_on_miss and not report["holds"])


if __name__ == "__main__":
    sys.exit(main())
