"""An acknowledged message source: landed message files, read with own offsets, a cap on a trigger and acknowledgements.

Producers land text files, one message a line, in a folder; ``land`` and ``land_rows`` do it so that a file is complete once
its name is seen, and put the number of messages in the name, so that nobody reads a file to count them. The source gives every message a position: files in order of their names, lines in order within a file. A micro-batch
takes at most ``max_messages`` further positions, split over tasks by runs of a file's lines. Once a batch has
gone through, Spark calls ``commit`` with its end, and the source writes it as the acknowledgement: a small file that
replaces the last one by a rename. What is acknowledged isn't given to any later query, also not one with a fresh
checkpoint; what isn't, comes again.

Names must sort after those that are already read; a file that turns up before the acknowledged place is an error and
not a loss. A file with no number in its name is counted once, by the driver. Line feeds and backslashes inside a message are
escaped in the file.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "file string, line long, value string"
_ACKNOWLEDGED = "_acknowledged"
_LINES_A_TASK = 10_000


def _folder(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), os.path.abspath(path)
    return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def _read(files: pafs.FileSystem, path: str) -> bytes:
    with files.open_input_stream(path) as stream:
        return stream.read()


def _lines(files: pafs.FileSystem, path: str) -> Iterator[str]:
    """Lines of a file, read piece by piece; only a line feed ends a line."""
    with files.open_input_stream(path) as stream:
        rest = b""
        while piece := stream.read(1 << 20):
            *whole, rest = (rest + piece).split(b"\n")
            for line in whole:
                yield line.decode()
        if rest:
            yield rest.decode()


def _replace(files: pafs.FileSystem, path: str, content: str) -> None:
    """Write beside and rename, so that a reader sees the old content or the new."""
    beside = f"{os.path.dirname(path)}/_{uuid.uuid4().hex}"
    with files.open_output_stream(beside) as stream:
        stream.write(content.encode())
    files.move(beside, path)


def _escaped(message: str) -> str:
    return message.replace("\\", "\\\\").replace("\n", "\\n")


def _plain(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], line) if "\\" in line else line


def land(path: str, name: str, messages: list[str]) -> str:
    """Land messages as one file; returns its name."""
    files, folder = _folder(path)
    files.create_dir(folder, recursive=True)
    full = f"{name}.n{len(messages)}"
    _replace(files, f"{folder}/{full}", "".join(f"{_escaped(m)}\n" for m in messages))
    return full


def land_rows(rows: DataFrame, path: str, prefix: str, per_file: int = 10_000) -> None:
    """Land the column ``value`` of ``rows``, null left out, by tasks: files of at most ``per_file`` messages each.

    A task that runs again writes the same names, so rows must come in the same order then: read them from files.
    """

    def write(batches: Iterator) -> Iterator:
        task, number, waiting = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            for value in batch.column("value"):
                waiting.append(value.as_py())
                if len(waiting) == per_file:
                    land(path, f"{prefix}-{task:06d}-{number:06d}", waiting)
                    number, waiting = number + 1, []
        if waiting:
            land(path, f"{prefix}-{task:06d}-{number:06d}", waiting)
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64())], ["files"])

    rows.where("value IS NOT NULL").select("value").mapInArrow(write, "files long").write.format("noop").mode("overwrite").save()


def acknowledged(path: str) -> dict | None:
    """The place up to which messages are acknowledged: file and lines of it; None before the first."""
    files, folder = _folder(path)
    place = f"{folder}/{_ACKNOWLEDGED}"
    if files.get_file_info(place).type == pafs.FileType.NotFound:
        return None
    return json.loads(_read(files, place))


class LineRange(InputPartition):
    def __init__(self, file: str, first: int, last: int):
        self.file, self.first, self.last = file, first, last


class MessageReader(DataSourceStreamReader):
    """Offsets are places: ``{"file": name, "lines": n}``, n lines of that file and all files before it are behind."""

    def __init__(self, path: str, max_messages: int | None):
        self.path, self.cap = path, max_messages
        self.sizes: dict[str, int] = {}
        self.at: dict | None = None
        self.listed: list[str] | None = None  # names of the last listing, sorted; a trigger lists the folder once

    def _names(self, fresh: bool = True) -> list[str]:
        if fresh or self.listed is None:
            files, folder = _folder(self.path)
            found = files.get_file_info(pafs.FileSelector(folder))
            self.listed = sorted(f.base_name for f in found if f.type == pafs.FileType.File and f.base_name[:1] not in "_.")
        return self.listed

    def _size(self, name: str) -> int:
        if name not in self.sizes:
            if named := re.search(r"\.n(\d+)$", name):
                self.sizes[name] = int(named[1])
                return self.sizes[name]
            files, folder = _folder(self.path)
            self.sizes[name] = sum(1 for _ in _lines(files, f"{folder}/{name}"))
        return self.sizes[name]

    def initialOffset(self) -> dict:
        return acknowledged(self.path) or {"file": "", "lines": 0}

    def _advance(self, start: dict, cap: int | None, names: list[str]) -> list[tuple[str, int, int]]:
        """Runs (file, first line, line after the last) behind ``start`` among ``names``, of at most ``cap`` messages."""
        runs, left = [], cap
        for name in names[bisect.bisect_left(names, start["file"]) :]:
            if left == 0:
                break
            first, size = start["lines"] if name == start["file"] else 0, self._size(name)
            last = size if left is None else min(size, first + left)
            if last > first:
                runs.append((name, first, last))
                left = None if left is None else left - (last - first)
        return runs

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self.initialOffset()
        # The last listing serves while it fills the cap; otherwise the folder is listed again for what came since.
        runs = self._advance(self.at, self.cap, self._names(fresh=False)) if self.cap is not None else []
        if sum(last - first for _, first, last in runs) < (self.cap or 1):
            runs = self._advance(self.at, self.cap, self._names())
        if runs:
            self.at = {"file": runs[-1][0], "lines": runs[-1][2]}
        return dict(self.at)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # A restarted query may first repeat a batch of its own log; the next batch then follows its end.
        if self.at is None or (end["file"], end["lines"]) > (self.at["file"], self.at["lines"]):
            self.at = dict(end)
        parts, names = [], self._names(fresh=False)
        if end["file"] and (not names or names[-1] < end["file"]):
            names = self._names()
        for name in names[bisect.bisect_left(names, start["file"]) : bisect.bisect_right(names, end["file"])]:
            first = start["lines"] if name == start["file"] else 0
            last = end["lines"] if name == end["file"] else self._size(name)
            parts += [LineRange(name, i, min(i + _LINES_A_TASK, last)) for i in range(first, last, _LINES_A_TASK)]
        return parts

    def read(self, partition: LineRange) -> Iterator[pa.RecordBatch]:
        files, folder = _folder(self.path)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            names, lines, values = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(lines, pa.int64()), pa.array(values, pa.string())], ["file", "line", "value"])

        for i, value in enumerate(_lines(files, f"{folder}/{partition.file}")):
            if i >= partition.last:
                break
            if i >= partition.first:
                rows.append((partition.file, i, _plain(value)))
                if len(rows) == 1_000:
                    yield batch()
                    rows = []
        if rows:
            yield batch()

    def commit(self, end: dict) -> None:
        done = acknowledged(self.path)
        if done is not None and (end["file"], end["lines"]) <= (done["file"], done["lines"]):
            return
        late = [n for n in self._names() if n < end["file"] and n not in self.sizes and (done is None or n > done["file"])]
        if late:
            raise RuntimeError(f"message file {late[0]} turned up before {end['file']}, which is read already")
        files, folder = _folder(self.path)
        _replace(files, f"{folder}/{_ACKNOWLEDGED}", json.dumps(end))
        self.sizes = {n: size for n, size in self.sizes.items() if n >= end["file"]}


class MessageSource(DataSource):
    """``spark.readStream.format("messages")`` with options ``path`` and ``max_messages`` (none: no cap)."""

    @classmethod
    def name(cls) -> str:
        return "messages"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        cap = self.options.get("max_messages")
        if cap is not None and int(cap) < 1:
            raise ValueError("max_messages must be at least 1")
        return MessageReader(self.options["path"], None if cap is None else int(cap))


def message_stream(spark: SparkSession, path: str, max_messages: int | None = None) -> DataFrame:
    """file, line, value of every message behind the acknowledged place, at most ``max_messages`` a trigger."""
    spark.dataSource.register(MessageSource)
    reader = spark.readStream.format("messages").option("path", path)
    return (reader if max_messages is None else reader.option("max_messages", str(max_messages))).load()
