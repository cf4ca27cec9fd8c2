"""Configuration, decoding and the package without a JVM."""

import gzip
import json
import subprocess
import sys
import zlib

import pytest

from sluice.control import config
from sluice.control.config import MIB, Document, Payload
from sluice.control.errors import ConfigurationError, DecodeError
from sluice.functions import decode, jsontext


def relational(**extra):
    table = {"name": "orders", "object": "ORDER_FACT", "primary_key": ["ID"], "checkpoint": {"type": "watermark", "column": "AT"}}
    return {"source": {"name": "acme", "type": "warehouse", "database": "D", "schema": "S"}, "connection": {"secret_id": "x"}, "landing": {"location": "/lake/", "checkpoint_table": "/state"}, "tables": [table]} | extra


def feed(**discovery):
    return {"source": {"name": "acme", "type": "json_files", "discovery": discovery, "document": {"preset": "cloudevents"}}, "tables": [{"name": "o", "prefix": "/o/", "start_at": "2026-01-01T00:00:00Z"}]}


def problems(data):
    with pytest.raises(ConfigurationError) as e:
        config.parse(data)
    return str(e.value)


def test_relational():
    c = config.parse(relational(bronze={"database": "b", "location": "/b/"}))
    t = c.tables[0]
    assert (c.source_key, c.landing, t.database, t.schema, t.primary_key, c.bronze.partition_by) == ("acme_warehouse", "/lake", "D", "S", ("ID",), ("month({checkpoint_column})",))
    assert c.select("all") == c.select(" orders ") == c.tables
    with pytest.raises(ConfigurationError):
        c.select("orders,nope")
    assert config.parse(relational(bronze={"database": "b", "location": "/b", "partition_by": []})).bronze.partition_by == ()


def test_all_problems_at_once():
    data = relational(state={"table": "x"}, colour="red", bronze={"location": "/b", "partition_by": ["month()"], "table_prefix": "odd"})
    data["landing"]["bucket"] = "b"
    data["tables"].append({"name": "orders", "object": "order_fact", "primary_key": "ID", "checkpoint": {"type": "cursor", "column": "A", "lookback_minutes": -1}})
    said = problems(data)
    for part in ("`state`", "`colour`", "`landing.bucket`", "`bronze.database`", "month()", "table_prefix", "cursor", "lookback_minutes", "2 tables have the name", "2 tables have the source object"):
        assert part in said, part


@pytest.mark.parametrize("change,part", [({"safety_delay_seconds": 0}, "1 to 3600"), ({"prefetch": 33}, "1 to 32"), ({"path_format": "%Y/%m/%d"}, "hours"), ({"timezone": "Mars"}, "unknown"), ({"suffix": ""}, "empty"), ({"type": "odd"}, "one of"),
                                         ({"type": "full_prefix", "path_format": "%H"}, "no meaning"), ({"max_window_hours": 9000}, "8784"), ({"lookahead_hours": True}, "whole number")])
def test_discovery_limits(change, part):
    assert part in problems(feed(**change))


def test_feed():
    c = config.parse(feed())
    assert (c.tables[0].primary_key, c.tables[0].watermark, c.tables[0].lookback_minutes, c.document.payload) == (("_source_record_id",), "_s3_last_modified", 15, Payload("data_base64", "base64", "auto"))
    data = feed()
    data["source"]["document"] = {"preset": "records", "payload": {"encoding": "base64"}, "max_object_bytes": 600 * MIB}
    data["tables"][0] |= {"start_at": "2026-01-01", "envelope_fields": {"_ingested_at": "a", "Bad": "b", "good": "a..b"}, "checkpoint": {"lookback_minutes": 0}}
    data["connection"] = {"secret_id": "x"}
    said = problems(data)
    for part in ("needs `source.document.payload.path`", "max_object_bytes", "start_at", "_ingested_at", "'Bad'", "dotted path", "lookback_minutes", "no meaning for a document feed"):
        assert part in said, part


def test_resolution_and_files(tmp_path):
    assert config.resolve(None, 0, 5) == 0 and config.boolean("Yes") and not config.boolean("off")
    with pytest.raises(ConfigurationError):
        config.boolean("maybe")
    path = tmp_path / "c.yaml"
    path.write_text(json.dumps(relational()))
    assert config.load(str(path)).name == "acme"
    path.write_text("a: [")
    with pytest.raises(ConfigurationError):
        config.load(str(path))
    assert "mapping" in problems(["x"])


RECORDS = Document("none", "auto", "auto")


def records(data, d=RECORDS):
    return [(r.outer, r.payload) for r in decode.compile_feed(d)(data)]


def test_framing():
    gz = gzip.compress
    assert records(gz(b'{"a":1}')) == [({"a": "1"}, '{"a":1}')]
    assert len(records(zlib.compress(b'[{"a":1},{"a":2}]'))) == 2 and records(gz(b"[]")) == []
    assert len(records(gz('{"a":"x y"}\r\n\n{"a":2}\n'.encode()))) == 2
    for bad in (b"", b"  \n", b"[1]", b'{"a":1,"a":2}', b'{"a":NaN}', b'{"a":1} x', b"\xff", b'{"a":1}\n[]'):
        with pytest.raises(DecodeError):
            records(gz(bad))
    for framing, bad in (("object", b"[]"), ("array", b"{}")):
        with pytest.raises(DecodeError):
            records(gz(bad), Document("none", "gzip", framing))


def test_streams_are_bounded_and_whole():
    data = gzip.compress(b'{"a":1}')
    for bad in (data[:-1], data + b"x", data + data, b"\x1f\x8bnope"):
        with pytest.raises(DecodeError):
            records(bad)
    with pytest.raises(DecodeError, match="more than"):
        decode.unpacker("gzip", 9_999, "it")(gzip.compress(b"0" * 10_000))
    noise = __import__("random").Random(1).randbytes(300_000)  # more than a chunk, in and out
    for pack, kinds in ((gzip.compress, ("gzip", "auto")), (zlib.compress, ("zlib", "auto"))):
        for kind in kinds:
            assert decode.unpacker(kind, 300_000, "it")(pack(noise)) == noise and decode.unpacker(kind, 10**7, "it")(pack(b"0" * 10**7)) == b"0" * 10**7
            for bad in (pack(noise)[:-1], pack(noise) + b"x", pack(noise) + pack(b"")):
                with pytest.raises(DecodeError):
                    decode.unpacker(kind, 300_000, "it")(bad)
            with pytest.raises(DecodeError, match="more than"):
                decode.unpacker(kind, 299_999, "it")(pack(noise))
    with pytest.raises(DecodeError, match="larger"):
        decode.unpacker("none", 2, "it")(b"abc")
    assert decode.unpacker("none", 3, "it")(b"abc") == b"abc"


def test_payloads():
    import base64

    inline = Document("cloudevents", "none", "object", Payload("data"))
    text = '{"n": 1.10, "u": "\\u00fc"}'
    assert records(f'{{"data":{text}}}'.encode(), inline)[0][1] == '{"n":1.10,"u":"\\u00fc"}'
    assert records(json.dumps({"data": text}).encode(), inline)[0][1] == text
    coded = Document("cloudevents", "none", "object", Payload("d.x", "base64", "auto"))
    wrapped = base64.encodebytes(gzip.compress(text.encode())).decode()
    assert records(json.dumps({"d": {"x": wrapped}}).encode(), coded)[0][1] == text
    for value in ("@@@", "", None, 5, {"y": 1}, base64.b64encode(gzip.compress(b"[]")).decode(), base64.b64encode(b"plain").decode()):
        with pytest.raises(DecodeError):
            records(json.dumps({"d": {"x": value}}).encode(), coded)
    with pytest.raises(DecodeError):
        records(json.dumps({"data": {"k": "ü" * 200_000}}).encode(), Document("none", "none", "object", Payload("data"), max_payload_bytes=MIB))
    for value in (1, [1]):
        with pytest.raises(DecodeError):
            records(json.dumps({"data": value}).encode(), inline)


def test_text_and_identity():
    value = jsontext.read('[null, "x", true, 7, 1.10, {"a": [2.50, "ü"]}]')
    assert [decode.cell(v) for v in value] == [None, "x", "true", "7", "1.10", '{"a":[2.50,"\\u00fc"]}']
    assert decode.getter("a.b")({"a": {"b": 1}}) == 1 and decode.getter("a.b")({"a": 2}) is None and decode.getter("a")({}) is None
    import hashlib

    assert decode.record_id("b", "ü", '"e"', 0) == hashlib.sha256(rb'["b","\u00fc","\"e\"",0]').hexdigest()


def test_addresses():
    assert config.split_uri("s3://lake/a/b/") == ("s3", "lake", "a/b") and config.split_uri(" gs://b ") == ("gs", "b", "")
    for bad in ("", "/mnt/x", "s3:///x", "s3://", "lake/x", None):
        with pytest.raises(ConfigurationError):
            config.split_uri(bad)
    assert "landing.location" in problems(relational(landing={"location": "s3:///x", "checkpoint_table": "/s"}))


def test_secrets(tmp_path):
    from sluice.control import secrets
    from sluice.control.files import LocalFiles

    (tmp_path / "db.json").write_text('{"url": "jdbc:x"}')
    (tmp_path / "bad.json").write_text("[]")
    fetch = secrets.from_folder(LocalFiles(), str(tmp_path))
    assert fetch("db") == {"url": "jdbc:x"} and fetch(None) == {}
    for bad in ("none", "bad", "../db", "a/b"):
        with pytest.raises(ConfigurationError):
            fetch(bad)


def test_control_needs_no_spark():
    code = "import sys; sys.modules['pyspark'] = None; import sluice.control.config, sluice.control.manifest, sluice.control.state, sluice.functions.decode; assert 'pandas' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
