import json
import random

from pyspark.sql import functions as F

from sluice.operators.shredding import CHILD_MEMBERS, shred, subtype, variants


def brute(doc, root, drop=()):
    """Child paths by the plain definition."""
    out = []

    def record(kind, path, value):
        out.append(path)
        walk(value, path)

    def walk(value, path):
        if isinstance(value, dict):
            for k, x in value.items():
                at = f"{path}.{k}"
                if k in CHILD_MEMBERS:
                    if isinstance(x, str) and x.lstrip().startswith("["):
                        x = json.loads(x)
                    for i, item in enumerate(x if isinstance(x, list) else [x]):
                        if item is not None:
                            record(k, f"{at}[{i}]", item)
                else:
                    walk(x, at)
        elif isinstance(value, list):
            for i, x in enumerate(value):
                walk(x, f"{path}[{i}]")

    walk({k: v for k, v in doc.items() if k not in drop}, root)
    return out


def tree(rng, depth):
    names = ["lines", "modifiers", "components", "order", "sku", "notes", "x.y", "hops"]
    if depth == 0 or rng.random() < 0.2:
        return rng.choice([None, True, 1, 2.5, "text", "", "[not json", [], {}])
    if rng.random() < 0.6:
        d = {k: tree(rng, depth - 1) for k in rng.sample(names, rng.randrange(4))}
        for k in list(d):
            if k in CHILD_MEMBERS:
                if isinstance(d[k], str) and d[k].startswith("["):
                    d[k] = "plain"
                if isinstance(d[k], list) and rng.random() < 0.4:
                    d[k] = json.dumps(d[k])
        return d
    return [tree(rng, depth - 1) for _ in range(rng.randrange(4))]


def test_against_brute_force(spark):
    rng = random.Random(5)
    docs = [{"a": tree(rng, 5), "lines": [tree(rng, 4) for _ in range(2)], "data": {"lines": [1]}} for _ in range(150)]
    for d in docs:  # an array item of an array that holds records: no record, but may hold some
        d["lines"] = [x if not isinstance(x, list) else {"k": x} for x in d["lines"]]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "no int, doc string").repartition(5)
    got = shred(df, ["no"], {"envelope": "doc"}, without={"envelope": ("data",)}, roots=False)
    want = sorted((i, p) for i, d in enumerate(docs) for p in brute(d, "envelope", ("data",)))
    assert sorted((r["no"], r["record_path"]) for r in got.collect()) == want
    linked = {(r["no"], r["record_path"]) for r in shred(df, ["no"], {"envelope": "doc"}, without={"envelope": ("data",)}).collect()}
    assert all(r["parent_path"] is not None and (r["no"], r["parent_path"]) in linked for r in got.collect())


DOC = '{"order":{"id":"1","lines":"[{\\"sku\\":\\"a\\",\\"price\\":5822315915.6397179844482269267},null,{\\"modifiers\\":[\\"x\\",null,{\\"name\\":\\"y\\",\\"price\\":1.10}]}]"},"tenders":{"kind":"cash"},"breaks":null}'


def test_forms_links_variants_and_digits(spark):
    df = spark.createDataFrame([(1, DOC)], "landed_no bigint, p string")
    rec = {r["record_path"]: r for r in shred(df, ["landed_no"], {"payload": "p"}).collect()}
    assert list(sorted(rec)) == ["payload", "payload.order.lines[0]", "payload.order.lines[2]", "payload.order.lines[2].modifiers[0]", "payload.order.lines[2].modifiers[2]", "payload.tenders[0]"]
    line = rec["payload.order.lines[0]"]
    assert (line["carrier"], line["ordinal"], line["parent_path"], line["fields"]["price"]) == ("text", 0, "payload", "5822315915.6397179844482269267")
    assert rec["payload.order.lines[2].modifiers[2]"]["fields"]["price"] == "1.10" and rec["payload.order.lines[2].modifiers[0]"]["fields"] == {"value": "x"}
    assert rec["payload.tenders[0]"]["carrier"] == "lone" and rec["payload"]["fields"] == {"order.id": "1"}
    assert rec["payload.order.lines[2].modifiers[0]"]["variant"] != rec["payload.order.lines[2].modifiers[2]"]["variant"]
    typed = subtype(shred(df, ["landed_no"], {"payload": "p"}), "lines", {"sku": "string", "price": "decimal(10,2)"}, ["landed_no"]).collect()
    assert len(typed) == 2 and typed[0]["price"] is not None or typed[0]["other_fields"]


def test_shapes_share_a_variant_across_tasks(spark):
    df = spark.range(40).select("id", F.lit('{"lines":[{"b":1,"a":"x"}]}').alias("d")).repartition(8).unionAll(spark.createDataFrame([(99, '{"lines":[{"a":"y","b":2}]}')], "id bigint, d string"))
    v = variants(shred(df, ["id"], {"payload": "d"})).where("kind = 'lines'").collect()
    assert len(v) == 1 and v[0]["records"] == 41


def test_nulls_empty_broken_deep_and_clashing(spark):
    deep = '{"components":[' * 200 + "{}" + "]}" * 200
    data = [(1, None), (2, ""), (3, "not json"), (4, "{}"), (5, deep), (6, "[1]"), (6, "[1]"), (7, '{"a":' * 3000 + "1" + "}" * 3000), (8, '{"lines":[{"\\ud800":"\\udfff"}]}')]
    df = spark.createDataFrame(data, "kind int, variant string").select("kind", "variant", F.lit("z").alias("root"))
    out = shred(df, ["kind", "root"], {"payload": "variant"})
    rows = [tuple(r)[:4] for r in out.collect()]
    assert sum(1 for r in rows if r[0] == 5) == 201
    assert [r[3] for r in rows if r[0] == 3] == ["payload!"] and sum(1 for r in rows if r[0] == 6) == 2
    assert [r[3] for r in rows if r[0] == 7] == ["payload"] and sum(1 for r in rows if r[0] == 8) == 2
    assert not [r for r in rows if r[0] in (1, 2)]
    assert shred(df.limit(0), ["kind"], {"payload": "variant"}).count() == 0


def test_depth_loses_nothing(spark):
    far = '{"a":' * 5000 + '{"lines":[{"sku":"x"},2]}' + "}" * 5000
    text = json.dumps('[{"b":' + "[" * 4000 + "]" * 4000 + '}, {"sku":"y"}]')
    data = [(1, far), (2, f'{{"breaks":[1],"lines":{text},"hops":{{"r":1}}}}'), (3, '{"lines":"[{","hops":"[1"}')]
    out = shred(spark.createDataFrame(data, "no int, d string"), ["no"], {"payload": "d"}).collect()
    kinds = lambda no: sorted((r["kind"], r["carrier"], r["ordinal"]) for r in out if r["no"] == no and r["ordinal"] is not None)
    assert kinds(1) == [("lines", "list", 0), ("lines", "list", 1)]
    assert kinds(2) == [("breaks", "list", 0), ("hops", "lone", 0), ("lines", "text", 0), ("lines", "text", 1)]
    assert kinds(3) == [("hops", "lone", 0), ("lines", "lone", 0)]


def test_numbers_link_where_names_are_ambiguous(spark):
    df = spark.createDataFrame([(1, '{"a.b":{"lines":[1]},"a":{"b":{"lines":[2,{"modifiers":[3]}]}}}')], "no int, d string")
    out = shred(df, ["no"], {"payload": "d"}).collect()
    assert sorted(r["record_path"] for r in out if r["kind"] == "lines") == ["payload.a.b.lines[0]", "payload.a.b.lines[0]", "payload.a.b.lines[1]"]
    by = {r["record_no"]: r for r in out}
    assert len(by) == len(out) and by[next(r for r in out if r["kind"] == "modifiers")["parent_no"]]["record_path"] == "payload.a.b.lines[1]"


def test_leaves_beside_child_records_in_arrays(spark):
    df = spark.createDataFrame([(1, '{"k":[{"x":1,"lines":[5]},7,{"y":{"z":"t"}}],"m":[[1,2]]}')], "no int, d string")
    top = next(r for r in shred(df, ["no"], {"payload": "d"}).collect() if r["kind"] == "payload")
    assert top["fields"] == {"k[0].x": "1", "k[1]": "7", "k[2].y.z": "t", "m": "[[1,2]]"}


def test_routing_to_typed_subtype_tables(spark, tmp_path):
    from sluice.operators import shredding as s

    df = spark.createDataFrame([(1, DOC), (2, '{"order":{"lines":[{"sku":"q","price":2,"o":{"a":[1,"]"],"b":true}}]}}')], "landed_no bigint, p string")
    rec = shred(df, ["landed_no"], {"payload": "p"})
    tables = s.route(rec, ["landed_no"], str(tmp_path / "t"))
    seen = 0
    for v in tables.definitions().collect():
        rows = tables.subtype(v["kind"], v["variant"])
        assert rows.count() == v["records"] and v["definition"].startswith(v["kind"])
        assert not [r for r in rows.collect() if r["other_fields"] and v["kind"] != "lines"]
        seen += v["records"]
    assert seen == rec.count() == tables.supertype().count()
    assert tables.fields("lines") == {"o.a": "string", "o.b": "boolean", "price": "decimal(38,19)", "sku": "string"}
    lines = {(r["landed_no"], r["record_path"]): r for r in tables.subtype("lines").collect()}
    assert str(lines[2, "payload.order.lines[0]"]["price"]).startswith("2.0") and lines[2, "payload.order.lines[0]"]["o.a"] == '[1,"]"]'
    assert tables.subtype("absent").count() == 0 and set(tables.subtype("lines", wanted=["sku", "nothing"]).columns) >= {"sku", "nothing"}
    d = next(v["definition"] for v in variants(rec).collect() if '"o"' in v["definition"])
    assert s.variant_fields(d) == {"sku": "string", "price": "decimal(38,0)", "o.a": "string", "o.b": "boolean"}
    assert s.variant_fields("linesint") == {"value": "decimal(38,0)"} and s.variant_fields("lines[int|string]") == {"value": "string"}
    empty = s.route(shred(df.limit(0), ["landed_no"], {"payload": "p"}), ["landed_no"], str(tmp_path / "e"))
    assert empty.supertype().count() == 0 and empty.fields("lines") == {}
