"""Log files that are still written to, as a stream of their finished lines.

The offset of the stream says how many bytes of each file are done. A micro-batch reads the bytes
since, up to the last newline that is there, in ranges that are tasks of their own. A file is known
by its inode and its first line, not by its name: a rotated file goes on where it was under its new
name, and the file that takes its place, or a truncated one, begins anew.

A file that is cut in place and begins with the same line again is taken for the old one.

The folder has to be mounted under the same path on the driver and on all executors, as the folder
of a log server is. Rotated files have to stay for one micro-batch before they are compressed.
"""

from __future__ import annotations

import fnmatch
import json
import os
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Sent by value: Python workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1 << 16
#: Bytes of a first line that tell a file from another one with its inode.
MARK = 1 << 10
COMPRESSED = (".gz", ".bz2", ".xz", ".zst", ".zip")
LINES = 10_000  # of a record batch
#: Listings in a row that a file may be missing from before it is forgotten.
MISSING = 10


def local_path(folder: str) -> str:
    """A mounted folder, with or without file: before it."""
    path = folder.removeprefix("file:")
    path = "/" + path.lstrip("/") if path != folder else path
    if "://" in path:
        raise ValueError(f"{folder}: files are tailed in a mounted folder")
    return path


def identity(file: BinaryIO) -> str | None:
    """The name of a file in offsets; none while its first line is not there."""
    file.seek(0)
    line, end, _ = file.read(MARK).partition(b"\n")
    if not end and len(line) < MARK:
        return None
    return f"{os.fstat(file.fileno()).st_ino}-{zlib.crc32(line):08x}"


def whole_lines(file: BinaryIO, start: int, size: int) -> int | None:
    """The place after the last newline from start to size; none where there is no newline."""
    end = size
    while end > start:
        begin = max(start, end - BLOCK)
        file.seek(begin)
        found = file.read(end - begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        end = begin
    return None


def lines_from(file: BinaryIO, begin: int, end: int) -> Iterator[bytes]:
    """The lines whose first byte is in a range, without their ends."""
    file.seek(max(begin - 1, 0))
    if begin:
        file.readline()  # the rest of a line that began before the range
    at = file.tell()
    while at < end:
        line = file.readline()
        if not line:
            return
        at += len(line)
        yield line.rstrip(b"\n").removesuffix(b"\r")


@dataclass
class Range(InputPartition):
    """Bytes of a file; `name` is where it was seen last."""

    name: str
    file: str
    begin: int
    end: int


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder = local_path(options["path"])
        self.pattern = options.get("pattern", "*")
        self.first: dict[str, dict] = json.loads(options.get("startingoffsets", "{}"))
        self.range = int(options.get("bytespertask", 64 << 20))
        self.done: dict[str, dict] = {}  # by file: path, at
        self.sizes: dict[str, int] = {}  # by file: bytes that were searched for newlines
        self.missing: dict[str, int] = {}

    def _names(self) -> list[str]:
        # A file that is renamed while its folder is listed can be missing from one listing.
        names = set(os.listdir(self.folder)) | set(os.listdir(self.folder))
        wanted = [n for n in names if fnmatch.fnmatch(n, self.pattern) and not n.startswith((".", "_"))]
        return sorted(n for n in wanted if not n.endswith(COMPRESSED))

    def _open(self, name: str, file: str) -> BinaryIO:
        """The file of a range, wherever it is by now."""
        for path in [name, *[f"{self.folder}/{n}" for n in self._names()]]:
            try:
                found = open(path, "rb")
            except OSError:  # gone meanwhile, or a folder
                continue
            if identity(found) == file:
                return found
            found.close()
        raise FileNotFoundError(f"{name} has lines that were not read, but it is gone")

    def initialOffset(self) -> dict:
        return self.first

    def latestOffset(self) -> dict:
        seen = set()
        for name in self._names():
            path = f"{self.folder}/{name}"
            try:
                file = open(path, "rb")
            except OSError:
                continue
            with file:
                key = identity(file)
                if key is None or key in seen:  # no line yet; or a link to the same file
                    continue
                seen.add(key)
                size = os.fstat(file.fileno()).st_size
                before = self.sizes.get(key, 0)
                at = whole_lines(file, before, size) if size > before else None
                self.sizes[key] = size
                known = self.done.get(key, self.first.get(key, {"at": 0}))["at"]
                self.done[key] = {"path": path, "at": known if at is None else at}
        for key in list(self.done):
            self.missing[key] = 0 if key in seen else self.missing.get(key, 0) + 1
            if self.missing[key] > MISSING:
                del self.done[key], self.sizes[key], self.missing[key]
        return {k: dict(v) for k, v in self.done.items()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for key, now in sorted(end.items()):
            begin, stop = start.get(key, {"at": 0})["at"], now["at"]
            edges = [*range(begin, stop, self.range), stop]
            out += [Range(now["path"], key, a, b) for a, b in zip(edges, edges[1:], strict=False)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        with self._open(partition.name, partition.file) as file:
            for line in lines_from(file, partition.begin, partition.end):
                held.append(line.decode(errors="replace"))
                if len(held) >= LINES:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])


class TailedLines(DataSource):
    """Options: path (the folder), pattern (of file names), bytesPerTask, startingOffsets (JSON)."""

    @classmethod
    def name(cls) -> str:
        return "tailed_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> TailReader:
        return TailReader({k.lower(): v for k, v in self.options.items()})


def tailed_lines(
    spark: SparkSession,
    folder: str,
    pattern: str = "*",
    bytes_per_task: int = 64 << 20,
    starting_offsets: str | None = None,
) -> DataFrame:
    """Every finished line of the files in a folder once, also over restarts; what follows the
    last newline of a file waits. Names that begin with `.` or `_` and compressed files are left
    out. Bytes that are no UTF-8 become replacement characters; a carriage return before a line
    end goes. `starting_offsets` are those at which an earlier query has ended; they count for the
    first start only."""
    spark.dataSource.register(TailedLines)
    reader = spark.readStream.format("tailed_lines").option("pattern", pattern)
    reader = reader.option("startingOffsets", starting_offsets or "{}")
    return reader.option("bytesPerTask", bytes_per_task).load(local_path(folder))
