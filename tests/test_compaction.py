import hashlib
import io
import random

import pytest
import zstandard

from sluice.operators import compaction as c

BASE = "s3://lake/landing"
MANIFEST = "status string, run_id string, source_system string, started_at string, files array<string>"
FILES = "file_uri string, run_id string, size_bytes bigint, row_count bigint, first_landed_no bigint, last_landed_no bigint, written_at timestamp"


def uri(run, name, system="acme", table="t", day="2026-01-02"):
    return f"{BASE}/{system}/{table}/ingest_date={day}/run_id={run}/{name}"


def test_committed(spark):
    m = spark.createDataFrame([
        ("SUCCESS", "r1", "acme", "2026-01-02T00:00:00+00:00", ["part-0.parquet", uri("r1", "part-1.parquet"), uri("r1", "part-1.parquet").replace("s3:", "s3a:").replace("=", "%3D"), None, uri("r1", "gone.parquet")]),
        ("FAILED", "r2", "acme", "2026-01-02T00:00:00+00:00", ["part-0.parquet"]), ("SUCCESS", "r3", "acme", "2026-01-02T00:00:00+00:00", None), ("SUCCESS", "r4", "acme", "2026-01-02T23:30:00-05:00", ["a b+c.parquet"]),
        (None, "r5", None, None, ["x.parquet"]),
    ], MANIFEST)
    names = [uri("r1", "part-0.parquet"), uri("r1", "part-1.parquet"), uri("r1", "_temporary/0/part-0.parquet"), uri("r2", "part-0.parquet"), uri("r1", "part-0.parquet"), uri("r4", "a b+c.parquet", day="2026-01-03"), uri("r1", "other.parquet"), "odd"]
    f = spark.createDataFrame([(n, "r", 10, 1, None, None, None) for n in names], FILES)
    got = c.committed_files(m, f)
    assert sorted(r["file_uri"] for r in got.collect()) == sorted({names[0], names[1], names[5]})
    assert c.committed_files(m.limit(0), f).count() == 0 == c.committed_files(m, f.limit(0)).count()


def test_plan_covers_small_files_once_in_well_sized_outputs(spark):
    rng = random.Random(2)
    rows = [(uri(f"{rng.randrange(16):x}{k}", "p", table=rng.choice("aab")), f"{k:x}", rng.randrange(1, 12 << 20), 1, None, None, None) for k in range(3000)]
    rows = [(u, u.split("run_id=")[1].split("/")[0], *x) for u, _, *x in rows]
    f = spark.createDataFrame(rows, FILES).selectExpr("*", "'acme' as source_system", "split(file_uri, '/')[5] as table_name", "'2026-01-02' as day")
    p = c.plan(f, small=8 << 20, target=64 << 20).collect()
    assert sorted(r["file_uri"] for r in p) == sorted(r[0] for r in rows if r[2] < 8 << 20)
    sizes = {}
    upto = {}
    for r in sorted(p, key=lambda r: r["position"]):
        key = r["table_name"], r["output_no"]
        assert r["position"] == upto.get(key[0], 0) and key[1] == r["position"] // (64 << 20)
        upto[key[0]] = r["position"] + r["size_bytes"]
        sizes[key] = sizes.get(key, 0) + r["size_bytes"]
    # However fine the blocks, the same files in outputs as well sized; null days are a day.
    q = c.plan(f.selectExpr("* except (day)", "if(size_bytes % 2 = 0, day, null) as day"), small=8 << 20, target=64 << 20, block=50).collect()
    assert sorted(r["file_uri"] for r in q) == sorted(r["file_uri"] for r in p) and {(r["table_name"], r["output_no"]) for r in q} == set(sizes)
    full = [v for k, v in sizes.items() if k[1] < max(o for t, o in sizes if t == k[0])]
    assert full and min(full) > 48 << 20 and max(full) < 80 << 20


@pytest.mark.parametrize("kind", ["ndjson", "zstd"])
def test_round_trip(spark, tmp_path, kind):
    rng = random.Random(4)
    lines, rows = [], []
    for k in range(60):
        own = [f'{{"k":{k},"i":{i},"t":"{"ü" * rng.randrange(5)}"}}' for i in range(rng.randrange(0, 6))]
        lines += own
        data = ("\n".join(own) + rng.choice(["", "\n"] if own else [""])).encode()
        if kind == "zstd":
            data = ("".join(x + "\n" for x in own)).encode()
            data = zstandard.ZstdCompressor(write_checksum=bool(k % 2), write_content_size=bool(k % 3)).compress(data)
        elif own and k % 7 == 0:
            data = b"\xef\xbb\xbf" + data
        path = tmp_path / f"in{k}"
        path.write_bytes(data)
        rows.append((f"out{k % 3}", str(path), len(data)))
    report = c.join_files(spark.createDataFrame(rows, "output string, path string, size_bytes bigint"), str(tmp_path / "out"), kind).collect()
    assert len(report) == 60 and sorted(r["input"] for r in report) == sorted(r[1] for r in rows) and len({r["path"] for r in report}) == 3
    assert all(r["sha256"] == hashlib.sha256(open(r["input"], "rb").read()).hexdigest() for r in report)
    assert kind == "zstd" or sum(r["lines"] for r in report) == len(lines)
    back = []
    for r in {r["path"]: r for r in report}.values():
        data = open(r["path"], "rb").read()
        assert len(data) == r["output_bytes"] and hashlib.sha256(data).hexdigest() == r["output_sha256"]
        for i in report:
            own = open(i["input"], "rb").read().removeprefix(b"\xef\xbb\xbf")
            assert i["path"] != r["path"] or data[i["start"] :].startswith(own)
        if kind == "zstd":
            data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        back += data.decode().splitlines()
    assert sorted(back) == sorted(lines)


def test_headers_and_bad_input():
    assert b"".join(c.join_bytes(iter([b"a,b\n1,2", b"a,b\r\n3,4\n", b"", b"a,b"]), "ndjson", header=True)) == b"a,b\n1,2\n3,4\n"
    with pytest.raises(ValueError, match="headers differ"):
        list(c.join_bytes(iter([b"a\n1", b"b\n2"]), "ndjson", header=True))
    frame = zstandard.compress(b"hello" * 100)
    assert c.zstd_frames(frame + frame) == 2
    for bad in (frame[:-1], frame + b"x", b"abc", frame[:5]):
        with pytest.raises(ValueError):
            c.zstd_frames(bad)


def test_wrong_length_stops(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x\n")
    with pytest.raises(Exception, match="instead of"):
        c.join_files(spark.createDataFrame([("o", str(tmp_path / "a"), 3)], "output string, path string, size_bytes bigint"), str(tmp_path / "out")).collect()
    assert not (tmp_path / "out" / "o").exists()
