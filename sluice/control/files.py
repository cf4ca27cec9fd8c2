"""The few file operations that commits need: exclusive creation, whole replacement, listing; and the file systems of tasks."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path


@dataclass(frozen=True)
class FileInfo:
    path: str
    size: int
    modified: datetime


class LocalFiles:
    """A mounted file system, shared where the cluster has several machines."""

    def read(self, path: str) -> str | None:
        try:
            return Path(path).read_text(encoding="utf-8")
        except FileNotFoundError:
            return None

    def create(self, path: str, text: str) -> bool:
        """Whole or not at all; False where the file is there already. The link makes both true on one step."""
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}.part"
        with open(part, "x", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(part, path)
        except FileExistsError:
            return False
        finally:
            os.unlink(part)
        return True

    def exists(self, path: str) -> bool:
        return os.path.exists(path)

    def names(self, folder: str) -> list[str]:
        try:
            return sorted(n for n in os.listdir(folder) if not n.endswith(".part"))
        except FileNotFoundError:
            return []

    def walk(self, folder: str) -> Iterator[FileInfo]:
        """All files below a folder, in order of their paths; nothing where there is no such folder."""
        for top, folders, files in os.walk(folder):
            folders.sort()
            for name in sorted(files):
                path = f"{top}/{name}"
                s = os.stat(path)
                yield FileInfo(path, s.st_size, datetime.fromtimestamp(s.st_mtime, UTC))

    def delete(self, path: str) -> None:
        Path(path).unlink(missing_ok=True)
        parent = Path(path).parent
        try:
            parent.rmdir()
        except OSError:
            pass


#: Schemes of stores that have no rename, but take an object only if there is none.
OBJECT_STORES = ("s3", "s3a", "s3n", "gs", "abfs", "abfss", "wasb", "wasbs", "oss", "cosn")


class HadoopFiles(LocalFiles):
    """Any file system that the session's Hadoop client reaches (object stores, HDFS).

    Creation is exclusive: object stores are asked for a conditional put (and where a client knows no such thing, it is refused
    rather than done without); elsewhere a whole file is renamed, which fails where the name is taken.
    """

    def __init__(self, spark) -> None:
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def read(self, path: str) -> str | None:
        p, fs = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write(self, builder, text: str) -> None:
        out = builder.build()
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def create(self, path: str, text: str) -> bool:
        from py4j.protocol import Py4JJavaError

        p, fs = self._at(path)
        if fs.exists(p):
            return False
        if path.split(":", 1)[0] in OBJECT_STORES:
            try:
                self._write(fs.createFile(p).overwrite(False).recursive().must("fs.option.create.conditional.overwrite", True), text)
            except Py4JJavaError as e:
                if e.java_exception.getClass().getSimpleName() == "IllegalArgumentException" or not fs.exists(p):
                    raise
                return False
            return True
        part = self.jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
        self._write(fs.createFile(part).overwrite(False).recursive(), text)
        if fs.exists(p) or not fs.rename(part, p):
            fs.delete(part, False)
            return False
        return True

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def names(self, folder: str) -> list[str]:
        p, fs = self._at(folder)
        return sorted(n for s in (fs.listStatus(p) if fs.exists(p) else []) if not (n := s.getPath().getName()).endswith(".part"))

    def walk(self, folder: str) -> Iterator[FileInfo]:
        """All files below a folder, folder by folder in order of their names, so no more than one folder is held."""
        p, fs = self._at(folder)
        if not fs.exists(p):
            return
        for s in sorted(fs.listStatus(p), key=lambda s: s.getPath().getName()):
            if s.isDirectory():
                yield from self.walk(s.getPath().toString())
            else:
                yield FileInfo(s.getPath().toString(), s.getLen(), datetime.fromtimestamp(s.getModificationTime() / 1000, UTC))

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, False)
        if fs.exists(p.getParent()) and not fs.listStatus(p.getParent()):
            fs.delete(p.getParent(), False)


def files_for(spark, *locations: str | None) -> LocalFiles:
    """The file operations for these locations: plain paths are mounted folders, addresses go through the session's Hadoop client."""
    return HadoopFiles(spark) if any(x and "://" in x for x in locations) else LocalFiles()


def file_system(path: str):
    """For use in tasks: the pyarrow file system of a path or address (mounted folders, object stores, HDFS) and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1)) if "://" in path else (fs.LocalFileSystem(), path)
