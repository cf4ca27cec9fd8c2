"""Schemas that drift: one consistent table per source, each change reported, nothing lost.

``ingest`` enforces a target schema and keeps unknown and uncastable fields in a rescue column as JSON; ``promote`` adds approved
fields to the target; ``replay`` moves rescued values that the target now takes into its typed columns. Over many runs of many
sources, ``enforce`` gives each run the target it meets, which is what was promoted from the run before it; ``changes`` reports
how the two differ, and ``ingest_runs`` ingests their rows under that target and replays them under the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Catalog type by recorded type name, in lower case without blanks. Fixed values.
CATALOG_TYPES = {
    "int64": "bigint", "int32": "int", "int16": "smallint", "int8": "tinyint", "double": "double", "float": "float", "bool": "boolean", "string": "string",
    "large_string": "string", "binary": "binary", "date32[day]": "date",
    # The catalog's own names and other spellings of the same types.
    "bigint": "bigint", "long": "bigint", "int": "int", "integer": "int", "smallint": "smallint", "short": "smallint", "tinyint": "tinyint", "byte": "tinyint",
    "float64": "double", "float32": "float", "boolean": "boolean", "date": "date", "date32": "date", "varchar": "string", "utf8": "string", "large_utf8": "string", "large_binary": "binary",
}
_DECIMAL = r"^decimal(?:\d+)?\((\d+)(?:,(-?\d+))?\)$"


def catalog_type(name: Column) -> Column:
    """The catalog type of a recorded type name, however spelled; unknown names (and times of day) are strings."""
    plain = F.lower(F.regexp_replace(name, r"\s+", ""))
    known = F.coalesce(*[F.when(plain.isin(*[k for k, v in CATALOG_TYPES.items() if v == t]), F.lit(t)) for t in dict.fromkeys(CATALOG_TYPES.values())])
    decimal = F.concat(F.lit("decimal("), F.regexp_extract(plain, _DECIMAL, 1), F.lit(","), F.coalesce(F.nullif(F.regexp_extract(plain, _DECIMAL, 2), F.lit("")), F.lit("0")), F.lit(")"))
    return F.when(plain.rlike(_DECIMAL), decimal).when(plain.startswith("timestamp"), "timestamp").otherwise(F.coalesce(known, F.lit("string")))


def run_schemas(manifests: DataFrame) -> DataFrame:
    """(source_system, source_key, run_id, at, columns map<name, catalog type>) of each successful run with a schema.

    A manifest that stands there more than once counts once (the last by completion). Names are in lower case; a name twice
    in one schema keeps its first type. source_key is the source map written as sorted text. Runs without completion time are
    left out: they have no place in the order.
    """
    key = F.to_json(F.array_sort(F.map_entries("source")))
    ok = manifests.where((F.col("status") == "SUCCESS") & F.col("schema").isNotNull() & (F.size("schema") > 0)).select(
        "source_system", F.coalesce(key, F.lit("")).alias("source_key"), "run_id", F.try_to_timestamp("completed_at").alias("at"), "schema").where(F.col("at").isNotNull())
    once = ok.groupBy("source_system", "source_key", "run_id").agg(F.max_by("schema", F.struct("at", F.to_json("schema"))).alias("schema"), F.max("at").alias("at"))
    entries = F.transform("schema", lambda c: F.struct(F.lower(c["name"]).alias("key"), c["type"].alias("value")))
    first = F.aggregate(entries, F.expr("cast(array() as array<struct<key:string,value:string>>)"), lambda acc, e: F.when(e["key"].isNull() | F.exists(acc, lambda a: a["key"] == e["key"]), acc).otherwise(F.concat(acc, F.array(e))))
    return once.select("source_system", "source_key", "run_id", "at", F.map_from_entries(F.transform(first, lambda e: F.struct(e["key"], catalog_type(e["value"])))).alias("columns"))


def enforce(runs: DataFrame) -> DataFrame:
    """Each run with the target it meets: (source_system, source_key, run_id, at, columns, previous_run_id, target), both maps of name to
    catalog type. The target is the schema of the run before of the same source, as all changes are approved once a run is
    done; null for a source's first run, which makes its table. Ties of time are ordered by run id.

    The run before is found in two levels, inside days and over one row a day, so no task sorts all runs of a large source.
    """
    src = ["source_system", "source_key"]
    inside = Window.partitionBy(*src, "__day").orderBy("at", "run_id")
    x = runs.withColumn("__day", F.to_date("at")).select("*", F.lag(F.struct("run_id", "columns")).over(inside).alias("__before"))
    ends = x.groupBy(*src, "__day").agg(F.max_by(F.struct("run_id", "columns"), F.struct("at", "run_id")).alias("__end"))
    over = ends.select(*src, "__day", F.lag("__end").over(Window.partitionBy(*src).orderBy("__day")).alias("__earlier"))
    old = F.coalesce("__before", "__earlier")
    return x.join(over, [*src, "__day"]).select(*src, "run_id", "at", "columns", old["run_id"].alias("previous_run_id"), old["columns"].alias("target"))


def changes(enforced: DataFrame) -> DataFrame:
    """Each column that is ``added``, ``removed`` or ``retyped`` in a run against the target it meets:
    (source_system, source_key, run_id, previous_run_id, at, column_name, change, old_type, new_type).

    What the target doesn't know (whose values go to the rescue column) is added, what it misses removed, what has another catalog type retyped. A
    rename is a removal and an addition. The first run of a source has no changes.
    """
    met = enforced.where(F.col("target").isNotNull())
    names = F.array_union(F.map_keys("columns"), F.map_keys("target"))
    each = met.select("*", F.explode(F.transform(names, lambda k: F.struct(k.alias("column_name"), F.col("target")[k].alias("old_type"), F.col("columns")[k].alias("new_type")))).alias("c"))
    kind = F.when(F.col("c.old_type").isNull(), "added").when(F.col("c.new_type").isNull(), "removed").otherwise("retyped")
    return each.where(~F.col("c.old_type").eqNullSafe(F.col("c.new_type"))).select("source_system", "source_key", "run_id", "previous_run_id", "at", "c.column_name", kind.alias("change"), "c.old_type", "c.new_type")


# --- values ----------------------------------------------------------------------------------------------------------

_NUMBER = r"^([+-]?)(\d+)(?:\.(\d*))?(?:[eE]([+-]?\d{1,4}))?$"
_CLOCK = r"\d{4}-\d\d-\d\d(?:[T ]\d\d:\d\d(?::\d\d(?:\.\d{1,6}0*)?)?)?"
#: Numbers of which a parsed value may have lost digits.
_LONG = r"[0-9.]{39,}|[0-9.]{17,}[eE]"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, also inside lambdas, where nothing else keeps an expression from being repeated."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _decimal(number: Column, precision: Column, room: Column) -> Column:
    """A number's text as text with ``room`` digits behind the point; null where its digits don't fit."""
    zero = F.lit("0")

    def cut(p: Column) -> Column:  # sign, digits before the point, digits behind it, exponent
        digits = F.concat(p[1], p[2])
        scale = F.length(p[2]) - F.coalesce(F.nullif(p[3], F.lit("")).try_cast("int"), F.lit(0))
        return _let(F.struct(p[0].alias("sign"), F.ltrim(digits, zero).alias("digits"), scale.alias("scale")), trimmed)

    def trimmed(n: Column) -> Column:
        return _let(F.struct(n["sign"].alias("sign"), F.rtrim(n["digits"], zero).alias("core"), (n["scale"] - F.length(n["digits"])).alias("scale")), fitted)

    def fitted(n: Column) -> Column:
        size = F.length(n["core"])
        scale = F.when(n["core"] == "", 0).otherwise(n["scale"] + size)  # digits behind the point, without zeros at the end
        return _let(F.struct(n["sign"].alias("sign"), n["core"].alias("core"), scale.alias("scale")), lambda x: F.when((x["scale"] <= room) & (F.length(x["core"]) - x["scale"] <= precision - room), _let(filled(x), lambda t: spelled(x, t))))

    def filled(x: Column) -> Column:
        return F.lpad(F.concat(x["core"], F.repeat(zero, room - x["scale"])), F.greatest(room + 1, F.length(x["core"]) - x["scale"] + room), "0")

    def spelled(x: Column, t: Column) -> Column:
        point = F.length(t) - room
        behind = F.when(room > 0, F.concat(F.lit("."), F.substring(t, point + 1, room))).otherwise("")
        return F.concat(F.when((x["sign"] == "-") & (x["core"] != ""), "-").otherwise(""), F.substring(t, F.lit(1), point), behind)

    return _let(F.split(F.regexp_replace(number, _NUMBER, "$1,$2,$3,$4"), ","), cut)


def held(value: Column, kind: Column | str) -> Column:
    """A value's text as text that a cast to the catalog type ``kind`` takes whole; null where that type can't hold exactly it.

    Numbers are judged by their digits: none may be lost to a type's precision or scale. Whole numbers need whole number text, dates
    no time of day, times no more than microseconds; zoned times don't fit timestamp_ntz. Binary numbers take any number
    in their range.
    """
    kind = F.lit(kind) if isinstance(kind, str) else kind
    v = F.trim(value)
    out = F.when(kind == "string", value).when(kind.rlike(_DECIMAL), F.when(v.rlike(_NUMBER), _decimal(v, F.regexp_extract(kind, _DECIMAL, 1).try_cast("int"), F.regexp_extract(kind, _DECIMAL, 2).try_cast("int"))))
    for t in ("bigint", "int", "smallint", "tinyint"):
        out = out.when(kind == t, F.when(v.rlike(r"^[+-]?\d+$"), v.try_cast(t).cast("string")))
    for t in ("double", "float"):
        out = out.when(kind == t, F.when(v.rlike(_NUMBER) & (F.abs(v.try_cast(t)) < F.lit("Infinity").cast(t)), v))
    out = out.when(kind == "boolean", F.when(F.lower(v).isin("true", "false"), F.lower(v)))
    out = out.when(kind == "date", F.when(v.rlike(r"^\d{4}-\d\d-\d\d$") & v.try_cast("date").isNotNull(), v))
    out = out.when(kind == "timestamp", F.when(v.rlike(f"^{_CLOCK}\\s*(?:[zZ]|[+-]\\d\\d:?\\d\\d)?$") & v.try_cast("timestamp").isNotNull(), v))
    out = out.when(kind == "timestamp_ntz", F.when(v.rlike(f"^{_CLOCK}$") & v.try_cast("timestamp_ntz").isNotNull(), v))
    return out.when(kind == "binary", value)


def _taken_apart(df: DataFrame, json: Column, exact: Column, into: str = "__raw") -> DataFrame:
    """``df`` with the members of a JSON object in order of their names: array of (low, name, text, value variant, last); null where the
    text is no JSON object or has a member twice. low: the name in lower case. last: no later name is the same there. Where not
    ``exact``, the text of numbers that may have lost digits is null. The text is parsed once a row, as a column of its own."""
    known = F.col("__known")
    text = lambda v: F.when(F.col("__exact") | (F.schema_of_variant(v) != "DOUBLE"), v.cast("string"))
    last = lambda e, i: F.col("__apart") | ~F.exists(F.slice(known, i + 2, F.size(known)), lambda x: F.lower(x["key"]) == F.lower(e["key"]))
    entries = F.transform(known, lambda e, i: F.struct(F.lower(e["key"]).alias("low"), e["key"].alias("name"), text(e["value"]).alias("text"), e["value"].alias("value"), last(e, i).alias("last")))
    parsed = df.select("*", F.map_entries(F.try_variant_get(F.try_parse_json(json), "$", "map<string,variant>")).alias("__known"), exact.alias("__exact"))
    parsed = parsed.withColumn("__apart", F.size(F.array_distinct(F.transform(known, lambda e: F.lower(e["key"])))) == F.size(known))
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns], entries.alias(into))


def _field(entries: str, name: str) -> Column:
    """A member's text by name without letter case; of names that differ in case only, the last. A JSON null is null."""
    return F.try_element_at(F.transform(F.filter(entries, lambda e: (e["low"] == name.lower()) & e["last"]), lambda e: e["text"]), F.lit(1))


def _lost(entries: str, target: dict[str, str]) -> Column:
    """The members that a target doesn't take: unknown ones, those whose value its type can't hold, and all but the last of a name."""
    taken = lambda e: F.coalesce(*[F.when(e["low"] == c.lower(), held(e["text"], t).isNotNull()) for c, t in target.items()], F.lit(False)) & e["last"]
    return F.filter(entries, lambda e: e["text"].isNotNull() & ~taken(e))


def _json(*lists: Column) -> Column:
    """Arrays of (name, value variant) as one JSON object; null without members. Arrays may be null. A name that stands there twice
    (a member that is called like what is added to it) is written twice."""
    none = F.array().cast("array<struct<name:string,value:variant>>")

    def text(pairs: Column) -> Column:
        whole = F.to_json(F.map_from_entries(pairs))
        members = F.transform(F.transform(pairs, lambda e: F.to_json(F.create_map(e["name"], e["value"]))), lambda t: F.substring(t, F.lit(2), F.length(t) - 2))
        single = F.size(F.array_distinct(F.transform(pairs, lambda e: e["name"]))) == F.size(pairs)
        return F.when(F.size(pairs) > 0, F.when(single, whole).otherwise(F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))))

    return _let(F.concat(*[F.coalesce(x, none) for x in lists]), text)


def _record(text: Column) -> Column:
    """A record's whole text as a member ``_record``."""
    return F.array(F.struct(F.lit("_record").alias("name"), F.variant_get(F.parse_json(F.to_json(F.create_map(F.lit("r"), text))), "$.r", "variant").alias("value")))


# --- ingestion -------------------------------------------------------------------------------------------------------


def ingest(records: DataFrame, record: str, target: dict[str, str], rescue: str = "_rescued") -> DataFrame:
    """``records`` with the target's columns, typed, and ``rescue``: a JSON object of all fields that the target doesn't know
    or whose value its type can't hold exactly, null if there are none. The record column is dropped.

    Names match without letter case; of names that differ in case only, the last in order of names counts and the others are rescued. A
    JSON null is a null of any type. Text that is no JSON object (or has a member twice) gives nulls and is kept under ``_record``; so is
    the text of a record with a number of more than 38 digits, beside what could be typed, so that every digit is kept.
    Structures in text columns are their JSON. Other columns pass through; those named like the target's or the rescue column are replaced.
    """
    own = {c.lower() for c in (*target, rescue, record)}
    keep = [c for c in records.columns if c.lower() not in own]
    text = F.col(f"`{record}`")
    x = records.select(*[F.col(f"`{c}`") for c in keep], text.alias("__text"), text.rlike(_LONG).alias("__long"))
    x = _taken_apart(x, F.col("__text"), ~F.col("__long"))
    typed = {c: held(_field("__raw", c), t).cast(t) for c, t in target.items()}
    whole = F.when(F.col("__text").isNotNull() & (F.col("__raw").isNull() | F.col("__long")), _record(F.col("__text")))
    return x.select(*[F.col(f"`{c}`") for c in keep], *[v.alias(c) for c, v in typed.items()], _json(_pairs(_lost("__raw", target)), whole).alias(rescue))


def _pairs(entries: Column) -> Column:
    return F.transform(entries, lambda e: F.struct(e["name"].alias("name"), e["value"].alias("value")))


def promote(target: dict[str, str], approved: dict[str, str]) -> dict[str, str]:
    """The target with approved fields added; a field that is there takes the approved type."""
    low = {c.lower(): c for c in target}
    return target | {low.get(c.lower(), c): t for c, t in approved.items()}


def replay(ingested: DataFrame, target: dict[str, str], rescue: str = "_rescued") -> DataFrame:
    """``ingested`` under a newer target: columns take rescued values that they can hold, which then leave the rescue column. A typed value
    that its column's new type can't hold exactly goes to the rescue column."""
    have = {c.lower(): c for c in ingested.columns if c != rescue}
    low = {t.lower() for t in target}
    x = _taken_apart(ingested, F.col(f"`{rescue}`"), F.lit(True))
    typed, back = {}, []
    for c, t in target.items():
        new = held(_field("__raw", c), t).cast(t)
        old = have.get(c.lower())
        if old is None:
            typed[c] = new
        elif ingested.schema[old].dataType.simpleString() == t:
            typed[c] = F.coalesce(F.col(f"`{old}`"), new)
        else:
            was = F.col(f"`{old}`")
            now = held(was.cast("string"), t).cast(t)
            typed[c] = F.coalesce(now, new)
            back.append(F.when(was.isNotNull() & now.isNull(), F.struct(F.lit(c).alias("name"), F.variant_get(F.parse_json(F.to_json(F.struct(was.alias("r")))), "$.r", "variant").alias("value"))))
    keep = [c for c in ingested.columns if c.lower() not in low and c != rescue]
    gone = F.filter(F.array(*back), lambda e: e.isNotNull()) if back else F.lit(None).cast("array<struct<name:string,value:variant>>")
    return x.select(*[F.col(f"`{c}`") for c in keep], *[v.alias(c) for c, v in typed.items()], _json(_pairs(_lost("__raw", target)), gone).alias(rescue))


def ingest_runs(samples: DataFrame, enforced: DataFrame, record: str = "record_json", keys: tuple[str, ...] = ("run_id", "row_no")) -> DataFrame:
    """Rescue ingestion of many source tables at once, in long form: one row for each field of each record, as there is no one
    schema of them all: (keys, source_system, source_key, column_name, arrival_type, catalog_type, outcome, value, rescued).

    A run's rows meet the run's target from ``enforce`` (the first run its own schema), in which they find arrival_type, and are replayed under
    the source's last schema, all changes approved, in which they find catalog_type. outcome: ``typed`` (held on arrival and still),
    ``replayed`` (rescued on arrival, held now), ``unknown`` (the last schema doesn't have it), ``uncastable`` (its type can't hold it exactly),
    ``repeated`` (a later name is the same in lower case). value is the typed value's canonical text; what isn't typed or replayed is in rescued
    as JSON. A record that is no JSON object is one field ``_record``, unknown, as is one with a number of over 38 digits besides its other
    fields. Records of runs that ``enforced`` doesn't have keep every field as unknown. JSON nulls aren't fields.
    """
    src = ["source_system", "source_key"]
    last = enforced.groupBy(*src).agg(F.max_by("columns", F.struct("at", "run_id")).alias("__last"))
    of = enforced.select("run_id", *src, F.coalesce("target", "columns").alias("__first")).join(last, src)
    text = F.col("__text")
    taken = _taken_apart(samples.select(*keys, F.col(f"`{record}`").alias("__text"), F.col(f"`{record}`").rlike(_LONG).alias("__long")), text, ~F.col("__long"))
    whole = F.when(text.isNotNull() & (F.col("__raw").isNull() | F.col("__long")), F.transform(_record(text), lambda e: F.struct(F.lit("_record").alias("low"), e["name"].alias("name"), text.alias("text"), e["value"].alias("value"), F.lit(True).alias("last"))))
    none = F.array().cast("array<struct<low:string,name:string,text:string,value:variant,last:boolean>>")
    fields = taken.select(*keys, F.inline(F.concat(F.coalesce("__raw", none), F.coalesce(whole, none)))).where(F.col("text").isNotNull())
    x = fields.withColumnRenamed("value", "__json").join(of, "run_id", "left").select("*", F.col("low").alias("column_name"), F.try_element_at("__first", F.col("low")).alias("arrival_type"), F.try_element_at("__last", F.col("low")).alias("catalog_type"))
    x = x.withColumn("__then", held(F.col("text"), F.col("arrival_type"))).withColumn("value", F.when(F.col("last"), held(F.col("text"), F.col("catalog_type"))))
    kind = (F.when(~F.col("last"), "repeated").when(F.col("value").isNotNull() & F.col("__then").isNotNull(), "typed").when(F.col("value").isNotNull(), "replayed")
            .when(F.col("catalog_type").isNull(), "unknown").otherwise("uncastable"))
    return x.select(*keys, *src, "column_name", "arrival_type", "catalog_type", kind.alias("outcome"), "value", F.when(F.col("value").isNull(), F.to_json(F.create_map("name", "__json"))).alias("rescued"))
