"""The ``mails`` data source: a flat folder of ``*.txt`` files, one mail each
(SURVEY 2.1 S1, S1a, S1b, S1d, 2.9 ST1).

``spark.read.format("mails").load(path)`` lists the folder once; its
partitions are slices of that listing, and the files are opened in the tasks.
A zero-length file is a mail with empty text. ``spark.readStream`` reads the
same rows from files as they arrive, ``df.write.format("mails").save(path)``
writes ``(file_name, text)`` rows as files, each under its own name, so a task
that runs twice writes the same files.

Folders may be given as a path or as a URI of any file system that pyarrow
opens (``file``, ``hdfs``, ``s3``, ``gs``). Sub-folders and names that begin
with ``_`` or ``.`` are not read. Text is UTF-8; bytes that are not become
U+FFFD. A missing folder has no rows.
"""

from __future__ import annotations

import heapq
import io
import json
import logging
import os
import posixpath
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, islice, tee

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

log = logging.getLogger(__name__)

SCHEMA = "doc_id STRING, file_name STRING, text STRING"
FIELDS = ["doc_id", "file_name", "text"]
#: A slice ends at either; files count for as many bytes at least.
SLICE_FILES, SLICE_BYTES, FILE_BYTES = 20_000, 64 << 20, 4096
#: Bytes of text in an Arrow batch, about.
BATCH_BYTES = 4 << 20
#: Names that a stream sorts in memory, and sorted files of names that it merges, at most.
RUN_NAMES, MOST_RUNS = 50_000, 64


def opened(path: str) -> tuple[pafs.FileSystem, str, str]:
    """The file system of a path or URI, the path in it, and what stands in
    front of such a path in ``doc_id``."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path.rstrip("/"), ""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:") :].strip("/"), ""
    found, inner = pafs.FileSystem.from_uri(path)
    return found, inner.rstrip("/"), path[: len(path.rstrip("/")) - len(inner.rstrip("/"))]


def text_files(system: pafs.FileSystem, inner: str) -> Iterator[tuple[str, int]]:
    """``(name, bytes)`` of a folder's ``*.txt`` files, one at a time; file systems that are not local hand out whole
    listings alone."""
    if not isinstance(system, pafs.LocalFileSystem):
        for i in system.get_file_info(pafs.FileSelector(inner)):
            if i.type == pafs.FileType.File and i.base_name.endswith(".txt"):
                yield i.base_name, i.size
        return
    with os.scandir(inner or "/") as entries:
        for e in entries:
            try:
                if e.name.endswith(".txt") and e.is_file():
                    yield e.name, e.stat().st_size
            except FileNotFoundError:  # gone since
                continue


def scan(path: str) -> Iterator[tuple[str, int]]:
    """``(name, bytes)`` of the folder's mails in any order."""
    system, inner, _ = opened(path)
    if system.get_file_info(inner).type != pafs.FileType.Directory:
        log.warning("mail folder %s does not exist or is not a directory: no rows", path)
        return
    hidden = 0
    for name, size in text_files(system, inner):
        if name.startswith(("_", ".")):
            hidden += 1
        else:
            yield name, size
    if hidden:
        log.warning("mail folder %s: %d files are hidden by their names and not read", path, hidden)


def listing(path: str) -> list[tuple[str, int]]:
    """``(name, bytes)`` of the folder's mails by name."""
    return sorted(scan(path))


class Names:
    """``(name, bytes)`` rows in sorted files that have no names themselves and go with the process, so that memory does not
    grow with the rows."""

    def __init__(self):
        self.runs: list = []

    def add(self, rows: Iterable[tuple[str, int]]) -> None:
        """Adds sorted rows; not while rows are being read."""
        if len(self.runs) >= MOST_RUNS:
            merged = self.written(self)
            self.runs = [merged]
        self.runs.append(self.written(rows))

    def add_unsorted(self, rows: Iterator[tuple[str, int]]) -> None:
        while some := sorted(islice(rows, RUN_NAMES)):
            self.add(some)

    @staticmethod
    def written(rows: Iterable[tuple[str, int]]):
        run = tempfile.TemporaryFile("w+", encoding="ascii", prefix="mailspark-names-")
        run.writelines(line(row) for row in rows)
        return run

    @staticmethod
    def read(run) -> Iterator[tuple[str, int]]:
        run.seek(0)
        return map(tuple, map(json.loads, run))

    def __iter__(self) -> Iterator[tuple[str, int]]:
        return heapq.merge(*map(self.read, self.runs))


def line(row: tuple[str, int]) -> str:
    return json.dumps(row) + "\n"


def unseen(rows: Iterable[tuple[str, int]], seen: Iterable[tuple[str, int]]) -> Iterator[tuple[str, int]]:
    """The rows whose names ``seen`` doesn't have; both by name."""
    seen = iter(seen)
    last = next(seen, None)
    for row in rows:
        while last is not None and last[0] < row[0]:
            last = next(seen, None)
        if last is None or last[0] != row[0]:
            yield row


@dataclass
class Slice(InputPartition):
    names: list[str]


def begins(sizes: Iterable[int], most_files: int, most_bytes: int) -> Iterator[bool]:
    """For each file's bytes whether it begins a slice of bounded numbers of files and bytes."""
    n, total = 0, most_bytes
    for size in sizes:
        new = total >= most_bytes or n >= most_files
        if new:
            n = total = 0
        n += 1
        total += max(size, FILE_BYTES)
        yield new


def slices(files: list[tuple[str, int]], most_files: int = SLICE_FILES, most_bytes: int = SLICE_BYTES) -> list[Slice]:
    """The listing in slices of bounded numbers of files and bytes."""
    out: list[Slice] = []
    for (name, _), new in zip(files, begins((n for _, n in files), most_files, most_bytes)):
        if new:
            out.append(Slice([]))
        out[-1].names.append(name)
    return out or [Slice([])]


def read_slice(path: str, part: Slice | LogSlice) -> Iterator[pa.RecordBatch]:
    """The rows of a slice. A file that has gone since the listing has none."""
    system, inner, front = opened(path)
    rows: list[tuple[str, str, str]] = []
    size = 0
    for name in part.names:
        full = posixpath.join(inner, name)
        try:
            with system.open_input_stream(full) as f:
                text = f.read().decode("utf-8", "replace")
        except FileNotFoundError:
            log.warning("mail %s has gone", full)
            continue
        rows.append((front + full, name, text))
        size += len(text)
        if size >= BATCH_BYTES:
            yield batch(rows)
            rows, size = [], 0
    if rows:
        yield batch(rows)


def batch(rows: list[tuple[str, str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], FIELDS)


class MailReader(DataSourceReader):
    def __init__(self, path: str, most_files: int):
        self.path, self.most_files = path, most_files

    def partitions(self) -> list[Slice]:
        return slices(listing(self.path), self.most_files)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return read_slice(self.path, partition)


class FileLog:
    """Entries 1, 2, ... of ``(name, bytes)`` rows by name in a folder, a row a line. Entries of an older form are one list."""

    def __init__(self, path: str):
        self.system, self.folder, _ = opened(path)

    def path(self, n: int) -> str:
        return f"{self.folder}/{n:012d}.json"

    def has(self, n: int) -> bool:
        return self.system.get_file_info(self.path(n)).type == pafs.FileType.File

    def rows(self, n: int, lo: int = 0, hi: int | None = None) -> Iterator[tuple[str, int, int, int]]:
        """``(name, bytes, lo, hi)`` of an entry's rows from place ``lo`` to ``hi`` and their places: bytes of the file, numbers
        of rows in the older form."""
        with self.system.open_input_file(self.path(n)) as f, io.BufferedReader(f, 1 << 16) as r:
            if r.read(2) == b"[[":
                r.seek(0)
                for i, (name, size) in enumerate(json.loads(r.read())[lo:hi], lo):
                    yield name, size, i, i + 1
                return
            r.seek(lo)
            while (hi is None or lo < hi) and (text := r.readline()):
                yield *json.loads(text), lo, lo + len(text)
                lo += len(text)

    def write(self, n: int, rows: Iterable[tuple[str, int]]) -> None:
        """An entry is there under its name only when it is whole."""
        with self.system.open_output_stream(self.path(n) + ".part") as f:
            for row in rows:
                f.write(line(row).encode())
        self.system.move(self.path(n) + ".part", self.path(n))


@dataclass
class LogSlice(InputPartition):
    """Rows of a log's entries: ``(entry, lo, hi)`` each."""

    log: str
    parts: list[tuple[int, int, int]]

    @property
    def names(self) -> list[str]:
        entries = FileLog(self.log)
        return [row[0] for part in self.parts for row in entries.rows(*part)]


class MailStream(DataSourceStreamReader):
    """Offset n stands for the first n entries of a log of file lists in the
    folder ``log``. Files that no entry names yet become the next one, so a
    batch that is planned again, also after a restart, has the same files,
    whatever has arrived since and in whatever order of names and times.
    Slices are places in the log, and names are compared as sorted rows, so
    the driver holds neither the listing nor the names that were seen."""

    def __init__(self, path: str, log_path: str, most_files: int):
        self.path, self.log_path, self.most_files = path, log_path, most_files
        self.entries = FileLog(log_path)
        self.seen: Names | None = None
        self.n = 0

    def load(self) -> None:
        self.entries.system.create_dir(self.entries.folder, recursive=True)
        self.seen, self.n = Names(), 0
        while self.entries.has(self.n + 1):
            self.n += 1
            self.seen.add(row[:2] for row in self.entries.rows(self.n))

    def initialOffset(self) -> dict:  # noqa: N802 - the API's name
        return {"n": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        if self.seen is None:
            self.load()
        listed = Names()
        listed.add_unsorted(scan(self.path))
        new = unseen(listed, self.seen)
        if (first := next(new, None)) is not None:
            self.entries.write(self.n + 1, chain([first], new))
            self.n += 1
            self.seen.add(row[:2] for row in self.entries.rows(self.n))
        return {"n": self.n}

    def partitions(self, start: dict, end: dict) -> list[LogSlice]:
        rows, same = tee((n, *row) for n in range(start["n"] + 1, end["n"] + 1) for row in self.entries.rows(n))
        out: list[LogSlice] = []
        for (n, _, _, lo, hi), new in zip(rows, begins((row[2] for row in same), self.most_files, SLICE_BYTES)):
            if new:
                out.append(LogSlice(self.log_path, []))
            parts = out[-1].parts
            if parts and parts[-1][0] == n:
                parts[-1] = (n, parts[-1][1], hi)
            else:
                parts.append((n, lo, hi))
        return out or [LogSlice(self.log_path, [])]

    def read(self, partition: LogSlice) -> Iterator[pa.RecordBatch]:
        return read_slice(self.path, partition)


@dataclass
class Written(WriterCommitMessage):
    files: int


class MailWriter(DataSourceWriter):
    def __init__(self, path: str, names: list[str]):
        self.path, self.at = path, (names.index("file_name"), names.index("text"))

    def write(self, rows) -> Written:
        system, inner, _ = opened(self.path)
        system.create_dir(inner, recursive=True)
        n = 0
        for row in rows:
            name, text = row[self.at[0]], row[self.at[1]]
            if not name or "/" in name:
                raise ValueError(f"not a file name: {name!r}")
            with system.open_output_stream(posixpath.join(inner, name)) as f:
                f.write((text or "").encode())
            n += 1
        return Written(n)

    def commit(self, messages: list[Written]) -> None:
        log.info("%d mails written to %s", sum(m.files for m in messages if m), self.path)


class MailSource(DataSource):
    """Options: ``path``; ``filesPerSlice``; for streams ``log``, a folder
    that outlives the query, as its checkpoint does."""

    @classmethod
    def name(cls) -> str:
        return "mails"

    def schema(self) -> str:
        return SCHEMA

    def most_files(self) -> int:
        return int(self.options.get("filesPerSlice", SLICE_FILES))

    def reader(self, schema) -> MailReader:
        return MailReader(self.options["path"], self.most_files())

    def streamReader(self, schema) -> MailStream:  # noqa: N802
        return MailStream(self.options["path"], self.options["log"], self.most_files())

    def writer(self, schema, overwrite: bool) -> MailWriter:
        return MailWriter(self.options["path"], schema.fieldNames())


def register(spark: SparkSession) -> None:
    """Makes the format known to a session; doing so again changes nothing."""
    spark.dataSource.register(MailSource)
