"""Far too many small files: which committed files to join, into which, and the joining itself.

Files are joined byte by byte, never parsed: newline-delimited text with care for a missing last line end, byte-order marks
and repeated headers, or complete zstandard frames, which may follow each other in one file. Lengths and checksums of what
was read are compared with what was written before a file counts as done.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pa_fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.control.files import file_system

SMALL = 8 << 20
TARGET = 128 << 20
#: Layout of a landing folder: source system, table, day, run.
RUN_FOLDER = r"^s3://[^/]+/(?:[^/]+/)*?landing/([^/]+)/([^/]+)/ingest_date=([^/]+)/run_id=([^/]+)/(.+)$"


def canonical_uri(uri: Column) -> Column:
    """One spelling of an object address: scheme s3, percent escapes decoded, no doubled slashes, no query, no blanks around."""
    plain = F.regexp_replace(F.trim(uri), r"(?i)^s3[an]?://", "s3://")
    return F.regexp_replace(F.coalesce(F.try_url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))), plain), r"(?<!:)/{2,}", "/")


def committed_names(manifests: DataFrame) -> DataFrame:
    """(source_system, day, run_id, name) of every file that a manifest with status SUCCESS names, each once.

    A bare name lies directly in the run's own folder; addresses are taken apart. Null or empty lists name nothing.
    """
    named = (manifests.where(F.col("status") == "SUCCESS").select("source_system", "run_id", F.to_date(F.to_utc_timestamp(F.try_to_timestamp("started_at"), F.current_timezone())).cast("string").alias("day"),
                                                                  F.explode("files").alias("name")).where(F.col("name").isNotNull()))
    uri = named.select("*", canonical_uri(F.col("name")).alias("uri"))
    bare = ~F.col("uri").contains("/")
    part = lambda i: F.nullif(F.regexp_extract("uri", RUN_FOLDER, i), F.lit(""))
    return uri.select(F.when(bare, F.col("source_system")).otherwise(part(1)).alias("source_system"), F.when(bare, F.col("day")).otherwise(part(3)).alias("day"),
                      F.when(bare, F.col("run_id")).otherwise(part(4)).alias("run_id"), F.when(bare, F.col("uri")).otherwise(part(5)).alias("name")).where(F.col("name").isNotNull()).distinct()


def committed_files(manifests: DataFrame, files: DataFrame) -> DataFrame:
    """The rows of ``files`` that a successful manifest names, each file once, with ``source_system, table_name, day``.

    Left-overs that no manifest names and names of files that are gone drop out. Repeated rows of a file give one row: the
    largest by all its columns, so the result is the same for any order. Spelling in ``files`` is kept. Columns of ``files``
    named like the three new ones give way to them.
    """
    files = files.drop("source_system", "table_name", "day")
    uri = canonical_uri(F.col("file_uri"))
    part = lambda i: F.nullif(F.regexp_extract("__uri", RUN_FOLDER, i), F.lit(""))
    known = files.select(*files.columns, uri.alias("__uri")).select(*files.columns, part(1).alias("source_system"), part(2).alias("table_name"), part(3).alias("day"), part(4).alias("__run"), part(5).alias("__name"))
    names = committed_names(manifests).select("source_system", "day", F.col("run_id").alias("__run"), F.col("name").alias("__name"))
    hit = known.join(names, ["source_system", "day", "__run", "__name"], "left_semi")
    rest = [c for c in hit.columns if c != "file_uri" and not c.startswith("__")]
    return hit.groupBy("file_uri").agg(F.max(F.struct(*rest)).alias("__m")).select("file_uri", "__m.*")


def plan(committed: DataFrame, small: int = SMALL, target: int = TARGET, block: int = 4096) -> DataFrame:
    """Small files with the file each goes into: ``output_no`` within (source_system, table_name), and ``position``, the bytes of the
    table's small files before it, by which the files of an output are ordered.

    Running sizes decide, by day and inside a day by a hash of the address, in two levels: inside blocks of about ``block``
    files and over the blocks' totals. A day is cut into as many blocks as its files need, so however many files a table or a day
    has, no task sorts more than a block or the list of blocks. A file at or above ``small`` stays as it is.
    """
    group = ["source_system", "table_name"]
    f = committed.where(F.col("size_bytes") < small)
    days = f.groupBy(*group, "day").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("bigint").alias("__blocks"))
    f = _attach(f, days, [*group, "day"]).withColumn("__block", F.pmod(F.xxhash64("file_uri"), F.col("__blocks")))
    unit = [*group, "day", "__block"]
    total = f.groupBy(*unit).agg(F.sum("size_bytes").alias("__bytes"))
    before = F.coalesce(F.sum("__bytes").over(Window.partitionBy(*group).orderBy("day", "__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = f.withColumn("__inside", F.sum("size_bytes").over(Window.partitionBy(*unit).orderBy("file_uri")) - F.col("size_bytes"))
    at = F.col("__start") + F.col("__inside")
    return _attach(inside, total.select(*unit, before.alias("__start")), unit).select(*committed.columns, F.floor(at / F.lit(target)).alias("output_no"), at.alias("position"))


def _attach(df: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join in which null keys match; ``facts`` has one row a key."""
    right = facts.select(*[F.col(k).alias(f"__r_{i}") for i, k in enumerate(keys)], *[c for c in facts.columns if c not in keys])
    return df.join(right, [F.col(k).eqNullSafe(F.col(f"__r_{i}")) for i, k in enumerate(keys)]).drop(*[f"__r_{i}" for i in range(len(keys))])


# --- joining ---------------------------------------------------------------------------------------------------------

_ZSTD, _SKIP_LOW, _SKIP_HIGH = 0xFD2FB528, 0x184D2A50, 0x184D2A5F


def zstd_frames(data: bytes) -> int:
    """The number of complete frames that ``data`` is made of, from frame and block headers alone.

    Raises ValueError where a frame is cut off or something else follows.
    """
    at, frames, n = 0, 0, len(data)
    while at < n:
        if n - at < 8:
            raise ValueError("cut off in a frame header")
        magic = struct.unpack_from("<I", data, at)[0]
        if _SKIP_LOW <= magic <= _SKIP_HIGH:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
        elif magic == _ZSTD:
            flags = data[at + 4]
            single = flags >> 5 & 1
            at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
            last = 0
            while not last:
                if at + 3 > n:
                    raise ValueError("cut off in a block header")
                head = int.from_bytes(data[at : at + 3], "little")
                last, kind, size = head & 1, head >> 1 & 3, head >> 3
                if kind == 3:
                    raise ValueError("reserved block type")
                at += 3 + (1 if kind == 1 else size)
            at += 4 * (flags >> 2 & 1)
        else:
            raise ValueError("not a zstandard frame")
        if at > n:
            raise ValueError("cut off in a frame")
        frames += 1
    return frames


def join_bytes(parts: Iterator[bytes], kind: str, header: bool = False) -> Iterator[bytes]:
    """The pieces of the joined file. kind: ``ndjson`` (any newline-delimited text; header: the first line of every file
    is the same header and stays once) or ``zstd``. Empty files add nothing."""
    head = None
    for data in parts:
        if kind == "zstd":
            if data:
                zstd_frames(data)
                yield data
            continue
        if kind != "ndjson":
            raise ValueError(f"unknown kind {kind!r}")
        if data.startswith(b"\xef\xbb\xbf"):
            data = data[3:]
        if header and data:
            line, _, rest = data.partition(b"\n")
            if head is None:
                head = line.rstrip(b"\r")
            elif line.rstrip(b"\r") != head:
                raise ValueError("headers differ")
            else:
                data = rest
        if data:
            yield data if data.endswith(b"\n") else data + b"\n"


def replace_file(path: str, pieces: Iterator[bytes]) -> tuple[int, str]:
    """Writes a file beside its place, reads it back, and moves it there only if length and checksum are those of the pieces.
    Returns both. Whole or not at all; a second attempt of the task puts the same bytes in its place."""
    fs, at = file_system(path)
    folder, _, name = at.rpartition("/")
    fs.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    sent, back, length = hashlib.sha256(), hashlib.sha256(), 0
    try:
        with fs.open_output_stream(part) as f:
            for piece in pieces:
                sent.update(piece)
                length += len(piece)
                f.write(piece)
        with fs.open_input_stream(part) as f:
            while block := f.read(1 << 20):
                back.update(block)
        if fs.get_file_info(part).size != length or back.digest() != sent.digest():
            raise ValueError(f"{path}: what was written isn't what was read")
        fs.move(part, at)
    except BaseException:
        if fs.get_file_info(part).type != pa_fs.FileType.NotFound:
            fs.delete_file(part)
        raise
    return length, sent.hexdigest()


_REPORT = "path string, input string, start bigint, bytes bigint, lines bigint, sha256 string, output_bytes bigint, output_sha256 string"


def _join_group(kind: str, header: bool, out_dir: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["position", "path"])
        final = f"{out_dir.rstrip('/')}/{pdf['output'].iloc[0]}"
        rows: list[list] = []
        length = 0

        def read() -> Iterator[bytes]:
            for path, size in zip(pdf["path"], pdf["size_bytes"]):
                fs, at = file_system(path)
                with fs.open_input_stream(at, compression=None) as f:
                    data = f.read()
                if len(data) != size:
                    raise ValueError(f"{path}: {len(data)} bytes instead of {size}")
                rows.append([final, path, length, size, 0 if kind == "ndjson" else None, hashlib.sha256(data).hexdigest()])
                yield data

        def counted() -> Iterator[bytes]:
            nonlocal length
            for piece in join_bytes(read(), kind, header):
                length += len(piece)
                if kind == "ndjson":
                    rows[-1][4] = piece.count(b"\n")
                yield piece

        done = replace_file(final, counted())
        return pd.DataFrame([[*r, *done] for r in rows], columns=[c.split()[0] for c in _REPORT.split(", ")])

    return run


def join_files(planned: DataFrame, out_dir: str, kind: str = "ndjson", header: bool = False) -> DataFrame:
    """Writes each ``output`` of ``planned`` (output string, path string, size_bytes bigint, and position bigint to order by, if there is
    one) into ``out_dir``, a folder all executors reach (mounted or by address). Reports each input that went in: (path, input,
    start in the output, bytes and lines of it, sha256 of the input, output_bytes, output_sha256).

    A group is bounded by the plan's target size, and a task holds one input of it at a time. A file of another length than
    planned, cut-off frames or differing headers stop the job before anything is replaced; inputs are never changed. Nothing
    planned, nothing written.
    """
    position = F.col("position") if "position" in planned.columns else F.lit(0)
    rows = planned.select("output", "path", F.col("size_bytes").cast("bigint").alias("size_bytes"), position.cast("bigint").alias("position"))
    return rows.groupBy("output").applyInPandas(_join_group(kind, header, out_dir), _REPORT)
