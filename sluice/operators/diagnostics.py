"""Looking at a feed before and while it is loaded: lateness against its folders, discovery replay, shapes of its JSON."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lateness classes by minutes past the end of a folder's hour. Fixed values.
LATENESS = ((0, "in-hour"), (15, "<=15m late"), (30, "<=30m late"), (60, "<=1h late"), (1440, "<=24h late"))


def lateness(objects: DataFrame, folder_hour: str = "folder_hour", modified: str = "modified") -> DataFrame:
    """The objects with ``late_seconds`` past their folder's end and its class ``lateness``. Null times have null lateness."""
    late = (F.unix_micros(F.col(modified).cast("timestamp")) - F.unix_micros(F.col(folder_hour).cast("timestamp")) - 3_600_000_000) / 1_000_000
    x = objects.withColumn("late_seconds", late)
    label = F.when(F.col("late_seconds").isNull(), F.lit(None))
    for minutes, name in LATENESS:
        label = label.when(F.col("late_seconds") <= minutes * 60, name)
    return x.withColumn("lateness", label.otherwise(">24h late"))


def lateness_histogram(objects: DataFrame) -> DataFrame:
    """(lateness, objects, percent)."""
    counts = lateness(objects).groupBy("lateness").agg(F.count(F.lit(1)).alias("objects"))
    return counts.withColumn("percent", F.round(F.col("objects") * 100 / F.sum("objects").over(Window.partitionBy(F.lit(1))), 1))  # seven rows at most


def folder_stats(objects: DataFrame, folder_hour: str = "folder_hour") -> DataFrame:
    """One row: hours, and least, mean (whole) and most objects an hour."""
    hours = objects.groupBy(folder_hour).agg(F.count(F.lit(1)).alias("n"))
    return hours.agg(F.count(F.lit(1)).alias("hours"), F.min("n").alias("min_objects"), F.expr("sum(n) div count(1)").alias("mean_objects"), F.max("n").alias("max_objects"))


def replay(objects: DataFrame, start_s: int, interval_s: int = 900, lookback_s: int = 900, safety_s: int = 120, lookahead_s: int = 3600, folder_hour: str = "folder_hour", modified: str = "modified") -> DataFrame:
    """The objects with ``found``: whether a schedule of discovery runs would have seen them.

    Run k (1, 2, ...) at start + k * interval has the window (high of run k-1, high of run k], the first from start on, and
    walks folders from the hour of its lower bound less lookback to its upper bound plus lookahead. Every modification time
    lies in the window of exactly one run, so that run is computed, not joined.
    """
    m = F.unix_micros(F.col(modified).cast("timestamp")) / 1_000_000
    f = F.unix_micros(F.col(folder_hour).cast("timestamp")) / 1_000_000
    first_run = -(-safety_s // interval_s) if safety_s > interval_s else 1
    k = F.greatest(F.ceil((m - (start_s - safety_s)) / F.lit(interval_s)), F.lit(first_run))
    high = k * interval_s + (start_s - safety_s)
    first = k == first_run
    low = F.when(first, F.lit(start_s)).otherwise(high - interval_s)
    from_hour = low - F.when(first, 0).otherwise(lookback_s)
    from_hour = from_hour - F.pmod(from_hour, F.lit(3600))
    found = (m >= start_s) & (f <= high + lookahead_s) & (f >= from_hour)
    return objects.withColumn("found", F.coalesce(found, F.lit(False)))


def worst(objects: DataFrame, n: int, *ties: str) -> DataFrame:
    """The n latest objects."""
    return lateness(objects).orderBy(F.col("late_seconds").desc(), *[F.col(t).desc() for t in ties]).limit(n)


# --- shapes ----------------------------------------------------------------------------------------------------------


def key_census(df: DataFrame, json: str) -> DataFrame:
    """(key, type, records): how many records have each top-level member, by the type of its value."""
    entries = F.explode(F.from_json(json, "map<string,string>")).alias("key", "value")
    kind = (F.when(F.col("value").isNull(), "null").when(F.col("value").rlike(r"^\s*\{"), "object").when(F.col("value").rlike(r"^\s*\["), "array")
            .when(F.col("value").isin("true", "false"), "boolean").when(F.col("value").rlike(r"^-?\d+$"), "integer").when(F.col("value").try_cast("double").isNotNull(), "number").otherwise("string"))
    return df.select(entries).groupBy("key", kind.alias("type")).agg(F.count(F.lit(1)).alias("records"))


def sniff(content: Column) -> Column:
    """The codec of bytes by their first two: gzip, zlib or none."""
    head = F.hex(F.substring(content, 1, 2))
    zlib = F.hex(F.substring(content, 1, 1)).isin("78", "58", "48", "38", "28", "18", "08") & (F.conv(head, 16, 10).cast("int") % 31 == 0)
    return F.when(head == "1F8B", "gzip").when(zlib, "zlib").otherwise("none")


def snake_case(name: str) -> str:
    """A column name for a member name: each capital begins a word, other marks part words; ``f_`` where it would begin with a digit or
    have no letter at all."""
    apart = "".join(f" {c}" if "A" <= c <= "Z" else c for c in name).lower()
    column = "_".join(re.findall(r"[a-z0-9]+", apart))
    return column if column[:1].isalpha() else f"f_{column}"


def feed_settings(census: DataFrame, share: float = 0.5) -> dict[str, str]:
    """envelope_fields for a feed: members with scalar values in at least ``share`` of the records, by column name. The census is
    as small as the feed has member names."""
    rows = census.collect()
    total = max((r["records"] for r in rows), default=0)
    return {snake_case(r["key"]): r["key"] for r in sorted(rows, key=lambda r: (-r["records"], r["key"])) if r["type"] not in ("object", "array", "null") and r["records"] >= share * total}


def document_settings(census: DataFrame) -> tuple[dict, list[str]]:
    """(document block of a feed's configuration, why one block can't describe the feed) from the rows of ``census``. The reasons are empty where it
    can: one way to carry payloads, compressed alike or not at all, and all of them objects."""
    seen: dict[str, dict[str, int]] = {}
    for r in census.where(F.col("measure").isin("carrier", "codec", "type")).collect():  # a dozen rows
        seen.setdefault(r["measure"], {})[r["value"]] = r["records"]
    most = lambda m: max(sorted(seen.get(m, {})), key=seen.get(m, {}).get, default=None)
    coded = most("carrier") != "data"
    packed = set(seen.get("codec", {})) - {"none"}
    compression = "none" if not coded or not packed else next(iter(packed)) if len(packed) == 1 else "auto"
    block = {"preset": "cloudevents" if coded and compression != "none" else "cloudevents_plain" if not coded else None, "compression": "gzip", "records": "auto",
             "payload": {"path": "data_base64" if coded else "data", "encoding": "base64" if coded else "none", "compression": compression, "format": "json"}}
    doubts = []
    if len(seen.get("carrier", {})) > 1 or "neither" in seen.get("carrier", {}):
        doubts.append(f"payloads are carried in {', '.join(sorted(seen['carrier']))}")
    if packed and "none" in seen["codec"]:
        doubts.append("some payloads are compressed, some aren't")
    if odd := sorted(set(seen.get("type", {})) - {"object"}):
        doubts.append(f"payloads of type {', '.join(odd)}")
    return {k: v for k, v in block.items() if v is not None}, doubts


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n) of keys that stand there more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _json_type(text: Column) -> Column:
    """The type of JSON text by its first character; null for a null."""
    head = F.substring(F.ltrim(text), 1, 1)
    return (F.when(text.isNull(), "none").when(head == "{", "object").when(head == "[", "array").when(head == '"', "string").when(head.isin("t", "f"), "boolean").when(head == "n", "null").otherwise("number"))


def census(records: DataFrame, envelope: str, payload: str, id_paths: list[str], version_paths: list[str], carriers: tuple[str, ...] = ("data_base64", "data"), keys: int | None = None) -> DataFrame:
    """(measure, value, records): nine frequency tables of a feed in one pass.

    carrier (which envelope member holds the payload), codec (of a base64 carrier), type (of the payload), wrapper (the object
    around the id, by its path), key (top-level members), id_path, id_type (path and JSON type),
    id_match (whether the id equals the envelope id's last part behind a colon), version_path. A null payload counts under
    type ``none`` only. keys: how many of a measure's values, the most frequent, a report is to show; None gives all.
    """
    e, p = F.col(f"`{envelope}`"), F.col(f"`{payload}`")
    held = {c: F.get_json_object(e, f"$.{c}") for c in carriers}
    carrier = F.coalesce(*[F.when(v.isNotNull(), F.lit(c)) for c, v in held.items()], F.lit("neither"))
    coded = F.coalesce(*[v for c, v in held.items() if c.endswith("base64")], F.lit(None).cast("string"))
    one = lambda m, v: F.struct(F.lit(m).alias("measure"), v.alias("value"))
    found = [F.get_json_object(p, x) for x in id_paths]
    wrapper = F.coalesce(*[F.when(v.isNotNull(), F.lit(x.rsplit(".", 1)[0])) for x, v in zip(id_paths, found)], F.lit("bare"))
    suffix = F.element_at(F.split(F.get_json_object(e, "$.id"), ":"), -1)
    is_object = _json_type(p) == "object"
    rows = [one("carrier", carrier), one("codec", F.when(coded.isNotNull(), sniff(F.try_to_binary(F.regexp_replace(coded, r"\s+", ""), F.lit("base64"))))), one("type", _json_type(p)), one("wrapper", F.when(is_object, wrapper))]
    for x, v in zip(id_paths, found):
        typed = F.schema_of_variant(F.variant_get(F.try_parse_json(p), x, "variant"))
        rows += [one("id_path", F.when(v.isNotNull(), F.lit(x))), one("id_type", F.when(v.isNotNull(), F.concat(F.lit(x + " "), F.lower(typed)))), one("id_match", F.when(v.isNotNull() & F.get_json_object(e, "$.id").contains(":"), F.when(suffix == v, x + " ==").otherwise(x + " !=")))]
    rows += [one("version_path", F.when(F.get_json_object(p, x).isNotNull(), F.lit(x))) for x in version_paths]
    keys_of = F.transform(F.coalesce(F.when(is_object, F.json_object_keys(p)), F.array().cast("array<string>")), lambda k: F.struct(F.lit("key").alias("measure"), k.alias("value")))
    each = records.select(F.explode(F.concat(F.array(*rows), keys_of)).alias("r")).where(F.col("r.value").isNotNull())
    counts = each.groupBy("r.measure", "r.value").agg(F.count(F.lit(1)).alias("records"))
    if keys is None:
        return counts
    top = F.row_number().over(Window.partitionBy("measure").orderBy(F.col("records").desc(), "value"))  # cut before the shuffle, as only the first count
    return counts.withColumn("__rn", top).where(F.col("__rn") <= keys).drop("__rn")


def sample_newest(objects: DataFrame, folder: str, modified: str, hours: int, sample: int) -> DataFrame:
    """Objects of the newest ``hours`` folders, at most sample/hours of each, newest first: a sample by design."""
    newest = objects.select(folder).distinct().orderBy(F.col(folder).desc()).limit(hours)
    w = Window.partitionBy(folder).orderBy(F.col(modified).desc())
    return objects.join(newest, folder, "left_semi").withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= max(1, sample // hours)).drop("__rn")
