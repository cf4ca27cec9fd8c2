"""Deeply nested records to related flat tables: structural-variant shredding.

A bottom-up tree automaton gives every value a state: leaves by type, arrays by the set of their items' states, objects by
their members and the members' states. A member that holds child records contributes only the fact that it does, in
which form (list, lone value, list written as text); its records are routed on their own. The state of a child record is
its structural variant. Transitions are kept in a table, so a shape seen before costs one lookup; states are named by a
hash of their definition, so all tasks agree without talking to each other.

``shred`` is one narrow pass over the documents, no shuffle. ``route`` writes its records to their subtypes' tables: a folder
for each kind, in which the records of a variant lie together, and a table of definitions, from which the fields get their
types. Numbers keep their digits as written. Nothing recurses, so no depth is too great.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.jsontext import Number, plain, read, write

CHILD_MEMBERS = ("lines", "modifiers", "components", "tenders", "breaks", "hops")
SUPERTYPE = "root string, kind string, record_no int, parent_no int, record_path string, parent_path string, ordinal int, depth int, carrier string, variant string, definition string, fields map<string,string>"
_TYPES = {"int": pa.int32(), "string": pa.string(), "map<string,string>": pa.map_(pa.string(), pa.string())}
_FIELDS = [(c.split()[0], _TYPES[c.split()[1]]) for c in SUPERTYPE.split(", ")]


class Automaton:
    """The transition table: (label, children's states) to state. States are numbers within a task; names come from hashes."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[object, int] = {}
        self.made: list[tuple[str, object]] = []
        self.marks: list[str] = []  # names of states, the same in all tasks
        self.variants: dict[tuple[str, int], str] = {}

    def to(self, label: str, kids: object) -> int:
        """label: ``{`` with ((member, state), ...) by name, ``[`` with a sorted tuple of states, or '' with a leaf's name."""
        got = self.numbers.get((label, kids))
        if got is None:
            if label == "":
                mark = kids
            else:
                inner = ",".join(f"{json.dumps(k)}:{self.marks[s]}" for k, s in kids) if label == "{" else "|".join(sorted(self.marks[s] for s in kids))
                mark = "~" + hashlib.blake2b(f"{label}{inner}".encode(), digest_size=16).hexdigest()
            got = self.numbers[label, kids] = len(self.made)
            self.made.append((label, kids))
            self.marks.append(mark)
        return got

    def leaf(self, v: object) -> int:
        if v is None:
            return self.to("", "null")
        if v is True or v is False:
            return self.to("", "bool")
        if isinstance(v, Number):
            return self.to("", "int" if v.lstrip("-").isdigit() else "decimal")
        return self.to("", "string")

    def definition(self, state: int) -> str:
        """What a state stands for, written out."""
        out: list[str] = []
        todo: list[int | str] = [state]
        while todo:
            s = todo.pop()
            if isinstance(s, str):
                out.append(s)
                continue
            label, kids = self.made[s]
            if label == "":
                out.append(kids)
            elif label == "{":
                pieces: list[int | str] = []
                for k, x in kids:
                    pieces += [("," if pieces else "") + json.dumps(k) + ":", x]
                todo += ["}", *reversed(pieces), "{"]
            else:
                pieces = []
                for x in sorted(kids, key=self.marks.__getitem__):
                    pieces += ["|", x] if pieces else [x]
                todo += ["]", *reversed(pieces), "["]
        return "".join(out)

    def variant(self, kind: str, state: int) -> tuple[str, str | None]:
        """A record's structural variant, and its definition where this task hasn't given it yet."""
        got = self.variants.get((kind, state))
        if got is not None:
            return got, None
        definition = kind + self.definition(state)
        got = self.variants[kind, state] = hashlib.blake2b(definition.encode(), digest_size=8).hexdigest()
        return got, definition


def _array(cells: list, kind: pa.DataType) -> pa.Array:
    """The cells as a column; half surrogate pairs, which JSON escapes can hold but UTF-8 can't, become question marks."""
    try:
        return pa.array(cells, kind)
    except UnicodeEncodeError:
        clean = lambda v: v.encode("utf-8", "replace").decode() if isinstance(v, str) else [tuple(map(clean, x)) for x in v] if isinstance(v, list) else v
        return pa.array(list(map(clean, cells)), kind)


def _spelled(link: tuple | None) -> str:
    """A chain of (chain before, piece) as text. Chains make a path cost its length only where it is needed."""
    pieces = []
    while link:
        pieces.append(link[1])
        link = link[0]
    return "".join(reversed(pieces))


class _Open:
    """A container whose state isn't known yet."""

    __slots__ = ("value", "key", "rest", "kids", "path", "name", "fields", "outer", "before")

    def __init__(self, value: dict | list, key: object, path: tuple | None, name: str | tuple | None, fields: list | None, before: int) -> None:
        self.value, self.key, self.path, self.name, self.outer, self.before = value, key, path, name, fields, before
        if isinstance(value, dict):
            self.rest, self.kids, self.fields = iter(value.items()), [], fields
        else:  # an array's own fields count only if it holds child records; else it is one field
            self.rest, self.kids, self.fields = iter(enumerate(value)), set(), None if fields is None else []


class _Shredder:
    def __init__(self, members: frozenset[str], fields: bool) -> None:
        self.members, self.fields, self.automaton = members, fields, Automaton()

    def children(self, value: object) -> tuple[str, list]:
        """The form in which a member holds its child records, and the records by ordinal."""
        if isinstance(value, list):
            return "list", value
        if type(value) is str and value.lstrip()[:1] == "[":
            try:
                decoded = read(value)
            except ValueError:
                return "lone", [value]
            if isinstance(decoded, list):
                return "text", decoded
        return "lone", [value]

    def document(self, root: str, top: object, out: list) -> None:
        """Emits the document's own record and then its child records, depth first."""
        if len(self.automaton.made) > 200_000:  # shapes are few; this bounds memory where member names are data
            self.automaton.clear()
        number = 0
        stack = [(root, root, None, None, None, 0, "root", top)]
        while stack:
            kind, path, parent, parent_no, ordinal, depth, carrier, value = stack.pop()
            fields: list[tuple[str, str | None]] | None = [] if self.fields else None
            later: list = []
            state = self.scan(value, path, number, depth + 1, fields, later)
            out.append((root, kind, number, parent_no, path, parent, ordinal, depth, carrier, *self.automaton.variant(kind, state), fields or []))
            number += 1
            stack.extend(reversed(later))

    def scan(self, top: object, path: str, number: int, depth: int, fields: list | None, later: list) -> int:
        """The state of a record's own part of the tree; its leaves go to fields, its child records to later."""
        a = self.automaton
        if not isinstance(top, (dict, list)):
            if fields is not None:
                fields.append(("value", plain(top)))
            return a.leaf(top)
        stack = [_Open(top, None, None, None, fields, 0)]
        while True:
            o = stack[-1]
            is_list = isinstance(o.value, list)
            deeper = None
            for k, x in o.rest:
                if not is_list and k in self.members:
                    if x is None:
                        o.kids.append((k, a.to("", "null")))
                        continue
                    carrier, items = self.children(x)
                    o.kids.append((k, a.to("", f"<{k}:{carrier}>")))
                    at = f"{path}{_spelled(o.path)}.{k}"
                    later += [(k, f"{at}[{i}]", path, number, i, depth, carrier, item) for i, item in enumerate(items) if item is not None]
                elif isinstance(x, (dict, list)):
                    piece = f"[{k}]" if is_list else f".{k}"
                    deeper = _Open(x, k, (o.path, piece), (o.name, piece if is_list or o.name else k), o.fields, len(later))
                    break
                else:
                    if is_list:
                        o.kids.add(a.leaf(x))
                    else:
                        o.kids.append((k, a.leaf(x)))
                    if o.fields is not None:
                        before = _spelled(o.name)
                        o.fields.append((f"{before}[{k}]" if is_list else f"{before}.{k}" if before else k, plain(x)))
            if deeper is not None:
                stack.append(deeper)
                continue
            stack.pop()
            if is_list:
                state = a.to("[", tuple(sorted(o.kids)))
                if o.outer is not None:
                    if len(later) == o.before:
                        o.outer.append((_spelled(o.name) or "value", write(o.value)))
                    else:
                        o.outer.extend(o.fields)
            else:
                o.kids.sort()
                state = a.to("{", tuple(o.kids))
            if not stack:
                return state
            up = stack[-1]
            if isinstance(up.value, list):
                up.kids.add(state)
            else:
                up.kids.append((o.key, state))


def shred(df: DataFrame, keys: list[str], documents: dict[str, str], children: tuple[str, ...] = CHILD_MEMBERS, without: dict[str, tuple[str, ...]] | None = None,
          roots: bool = True, fields: bool = True) -> DataFrame:
    """The supertype table: one row for each record of the JSON documents, with the columns ``keys`` of its row and

    root, kind (the root's name, or the member's), record_no (unique in the document, from 0), parent_no, record_path, parent_path (both
    null for a root), ordinal (null for a root), depth, carrier (``list``, ``lone``, ``text``; ``root``), variant, definition (on
    the first record of a variant in each task, else null), fields (leaves by dotted name, as written; a scalar record has one
    field ``value``; an array is JSON text, or its leaves by index where it holds child records). Paths use names as written, so
    members with dots in their names can share a path; numbers never do.

    documents: root name to string column. children: members that hold child records, at any depth, as a list, a lone value
    (ordinal 0) or a list written as JSON text. without: members of the top object that don't count, by root. roots, fields:
    False leaves root records out or fields empty.

    A null or empty document gives no rows. Null members and items are no records, but keep their ordinal. A document
    that isn't JSON gives one root record with kind ``<root>!``, no children; a member's text that isn't a JSON list is one lone
    value. Depth doesn't matter. Repeated rows give repeated records; an empty table gives an empty table. Key columns may have
    any names, also those of the supertype; they come first in order.
    """
    drop = {r: frozenset(m) for r, m in (without or {}).items()}
    members, names, n = frozenset(children), list(documents), len(keys)
    part = df.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{c}`").cast("string") for c in documents.values()]).toDF(*[f"k{i}" for i in range(n)], *[f"d{i}" for i in range(len(names))])
    key_schema = part.select(*part.columns[:n]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shredder = _Shredder(members, fields)
        for batch in batches:
            docs = [batch.column(n + j) for j in range(len(names))]
            for lo in range(0, batch.num_rows, 2000):
                rows: list = []
                of: list[int] = []
                for i in range(lo, min(lo + 2000, batch.num_rows)):
                    for root, col in zip(names, docs):
                        text = col[i].as_py()
                        if not text:
                            continue
                        start = len(rows)
                        try:
                            doc = read(text)
                        except ValueError:
                            rows.append((root, f"{root}!", 0, None, root, None, None, 0, "root", "", None, [("value", text)] if fields else []))
                        else:
                            if isinstance(doc, dict) and root in drop:
                                doc = {k: v for k, v in doc.items() if k not in drop[root]}
                            shredder.document(root, doc, rows)
                        if not roots:
                            del rows[start]
                        of.extend([i] * (len(rows) - start))
                idx = pa.array(of, pa.int32())
                cols = list(zip(*rows)) if rows else [[]] * len(_FIELDS)
                # A repeated name keeps its last value.
                cols[-1] = [list(dict(f).items()) for f in cols[-1]] if fields else [()] * len(rows)
                yield pa.RecordBatch.from_arrays([*(batch.column(j).take(idx) for j in range(n)), *(_array(c, t) for c, (_, t) in zip(cols, _FIELDS))],
                                                 [*(f"k{j}" for j in range(n)), *(k for k, _ in _FIELDS)])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in key_schema), SUPERTYPE])
    return part.mapInArrow(run, schema).toDF(*keys, *[k for k, _ in _FIELDS])


def variants(records: DataFrame) -> DataFrame:
    """The structural variants: kind, variant, definition and how many records have it. A definition on a root that was left out is
    null here."""
    return records.groupBy("kind", "variant").agg(F.max("definition").alias("definition"), F.count(F.lit(1)).alias("records"))


def subtype(records: DataFrame, kind: str, typed: dict[str, str], keys: list[str], variant: str | None = None) -> DataFrame:
    """The typed table of one kind (and one structural variant): supertype keys, parent link, then ``typed`` fields.

    typed: field to SQL type. A value that the type can't hold whole is null there; ``other_fields`` keeps it, together with
    fields that aren't listed, so nothing is lost.
    """
    own = records.where((F.col("kind") == kind) & (F.lit(True) if variant is None else F.col("variant") == variant))
    cast: dict[str, Column] = {f: _held(F.col("fields")[f], t) for f, t in typed.items()}
    lost = F.map_filter("fields", lambda k, v: ~k.isin(*typed) | F.coalesce(*[F.when((k == f) & v.isNotNull(), _held(v, t).isNull()) for f, t in typed.items()], F.lit(False))) if typed else F.col("fields")
    return own.select(*[F.col(f"`{k}`") for k in keys], "record_no", "parent_no", "record_path", "parent_path", "ordinal", "depth", "carrier", "variant", *[c.alias(f) for f, c in cast.items()], lost.alias("other_fields"))


def _held(text: Column, kind: str) -> Column:
    """The text as a type; null where that would lose digits."""
    got = text.try_cast(kind)
    if not kind.startswith("decimal"):
        return got
    scale = int(kind[kind.index(",") + 1 : -1])
    return F.when(F.length(F.rtrim(F.regexp_extract(text, r"^[^.eE]*\.?(\d*)", 1), F.lit("0"))) - F.coalesce(F.nullif(F.regexp_extract(text, r"[eE]([+-]?\d+)$", 1), F.lit("")).cast("int"), F.lit(0)) <= scale, got)


#: SQL type of each leaf state. Fixed values.
LEAF_TYPES = {"int": "decimal(38,0)", "decimal": "decimal(38,19)", "bool": "boolean", "string": "string", "null": "void"}


def variant_fields(definition: str) -> dict[str, str]:
    """The typed fields of a structural variant, by dotted name, from its definition; ``void`` for a field that is always null.

    Arrays are JSON text; leaves of arrays that hold child records have no place in a definition and stay in ``other_fields``.
    """
    out: dict[str, str] = {}
    decode = json.JSONDecoder().raw_decode
    i = next((k for k in range(len(definition)) if definition[k] in "{["), -1)
    if i < 0:
        kinds = [k for k in LEAF_TYPES if definition.endswith(k)]
        return {"value": LEAF_TYPES[kinds[0]]} if kinds else {}
    names: list[str] = []
    name = ""
    while i < len(definition):
        c = definition[i]
        if c == "{":
            names.append(name)
            i += 1
        elif c == "}":
            name = names.pop()
            i += 1
        elif c == ",":
            i += 1
        elif c == '"':
            key, end = decode(definition, i)
            name = f"{names[-1]}.{key}" if names[-1] else key
            i = end + 1
        elif c == "[":
            depth, start = 0, i
            while True:
                if definition[i] == '"':
                    _, i = decode(definition, i)
                    continue
                depth += (definition[i] == "[") - (definition[i] == "]")
                i += 1
                if not depth:
                    break
            if "<" not in definition[start:i]:
                out[name or "value"] = "string"
        elif c == "<":
            i = definition.index(">", i) + 1
        else:
            end = next((k for k in range(i, len(definition)) if definition[k] in ",}"), len(definition))
            out[name or "value"] = LEAF_TYPES[definition[i:end]]
            i = end
    return out


def _one_type(types: set[str]) -> str:
    """The type that holds all of a field's types: numbers of both sorts are decimals, other mixtures text."""
    types = types - {"void"}
    return next(iter(types)) if len(types) == 1 else "decimal(38,19)" if types == {"decimal(38,0)", "decimal(38,19)"} else "string"


class Routed:
    """The subtypes' tables below a folder, as ``route`` writes them."""

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], schema: T.StructType) -> None:
        self.records, self.keys = spark.read.schema(schema).parquet(f"{folder}/records"), keys

    def supertype(self) -> DataFrame:
        """What all records have: the keys of their row, the numbers and paths of record and parent, kind and variant."""
        return self.records.select(*[F.col(f"`{k}`") for k in self.keys], *[c for c, _ in _FIELDS if c not in ("definition", "fields")])

    def definitions(self) -> DataFrame:
        """The table of definitions: (kind, variant, definition, records)."""
        return variants(self.records)

    def fields(self, kind: str, variant: str | None = None) -> dict[str, str]:
        """The typed fields of a kind, or one of its variants, by name. As wide as the kind's schema, whatever the rows."""

        def taken_apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pd.DataFrame([(f, t) for d in pdf["definition"] for f, t in variant_fields(d).items()], columns=["field", "type"])

        own = self.records.where((F.col("kind") == kind) & F.col("definition").isNotNull() & (F.lit(True) if variant is None else F.col("variant") == variant)).select("definition").distinct()
        rows = own.mapInPandas(taken_apart, "field string, type string").distinct().collect()
        types: dict[str, set[str]] = {}
        for r in rows:
            types.setdefault(r["field"], set()).add(r["type"])
        return {f: _one_type(types[f]) for f in sorted(types)}

    def subtype(self, kind: str, variant: str | None = None, wanted: list[str] | None = None) -> DataFrame:
        """The typed table of a kind or of one structural variant, with the types that the definitions give; only its own
        folder is read, and of that the row groups that hold the variant. wanted: these fields only, null where no definition has them."""
        known = self.fields(kind, variant)
        return subtype(self.records, kind, known if wanted is None else {f: known.get(f, "string") for f in wanted}, self.keys, variant)


def route(records: DataFrame, keys: list[str], folder: str) -> Routed:
    """Routes every record to its subtype's table: Parquet below ``folder``, a folder for each kind, the records of a structural
    variant side by side in each file, with the supertype's keys and parent links. One pass, no shuffle; a task writes one
    file a kind, however many variants there are."""
    named = records.select(*[F.col(f"`{k}`") for k in keys], *[c for c, _ in _FIELDS])
    named.sortWithinPartitions("kind", "variant").write.partitionBy("kind").option("compression", "zstd").parquet(f"{folder}/records")
    return Routed(records.sparkSession, folder, keys, named.schema)
