"""Small files beside tables, through the file system that Spark uses: local folders, HDFS and object stores alike."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import SparkSession


class Files:
    """Driver-side calls of the Hadoop file system; paths as Spark takes them."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def fingerprint(self, *paths: str) -> str:
        """16 hex digits that change when a file at or below the paths is added, removed or written anew."""
        seen = []
        for path in paths:
            fs, p = self._at(path)
            files = fs.listFiles(p, True) if fs.exists(p) else None
            while files is not None and files.hasNext():
                f = files.next()
                seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:16]

    def make(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def move(self, path: str, to: str) -> None:
        """Renames; raises if that fails or the target is there."""
        fs, p = self._at(path)
        target = self._jvm.org.apache.hadoop.fs.Path(to)
        if not fs.exists(p) or fs.exists(target) or not fs.rename(p, target):
            raise RuntimeError(f"can't put {path} at {to}")

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        with_bytes = fs.open(p)
        try:
            return bytes(with_bytes.readAllBytes()).decode("utf-8")
        finally:
            with_bytes.close()

    def write(self, path: str, text: str) -> None:
        """The whole text or nothing: written beside, synced, then renamed over what is there."""
        folder, _, name = path.rpartition("/")
        own = f"{folder or '.'}/.{name}.{uuid.uuid4().hex}"
        fs, p = self._at(own)
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
            out.hsync()
        finally:
            out.close()
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        if not fs.exists(target):
            self.move(own, path)
            return
        aside = f"{folder or '.'}/.{name}.old"
        fs.delete(self._jvm.org.apache.hadoop.fs.Path(aside), False)
        self.move(path, aside)
        try:
            self.move(own, path)
        except BaseException:
            self.move(aside, path)
            raise
        fs.delete(self._jvm.org.apache.hadoop.fs.Path(aside), False)

    def read_json(self, path: str):
        """The JSON of a file; of its former version if a replacement was cut off between two renames."""
        folder, _, name = path.rpartition("/")
        aside = f"{folder or '.'}/.{name}.old"
        return json.loads(self.read(path if self.exists(path) or not self.exists(aside) else aside))

    def write_json(self, path: str, value) -> None:
        self.write(path, json.dumps(value, ensure_ascii=False, indent=2, default=str))


def kept_folder(files: Files, path: str, inputs: tuple[str, ...], tag: str, write: Callable[[str], None]) -> str:
    """A folder below path that write() has filled for the inputs (files or folders) as they are now; filled if it isn't there.

    It is filled aside and put in place when it is whole, so that another session sees all of it or nothing.
    """
    own = f"{path.rstrip('/')}/{files.fingerprint(*inputs)}-{tag}"
    if not files.exists(own):
        staging = f"{path.rstrip('/')}/.{uuid.uuid4().hex}"
        try:
            files.make(staging)
            write(staging)
            if not files.exists(own):
                files.move(staging, own)
        finally:
            files.delete(staging)
    return own


def beside(path: str, suffix: str) -> str:
    """A hidden name next to a path, for staging and backups."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder or '.'}/.{name}.{suffix}"


def utc_now() -> str:
    """The time in UTC, ISO 8601, to the second."""
    return datetime.now(UTC).isoformat(timespec="seconds")
