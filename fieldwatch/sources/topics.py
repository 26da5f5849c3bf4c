"""A folder of line files as a topic with offsets (S1, S2, ST8), for ``readStream`` and
``read``.

Format ``fieldwatch_topic``. Rows have Kafka's columns: ``key`` (null), ``value``,
``topic``, ``partition``, ``offset``, ``timestamp``. Files below ``partition=<n>/`` make up
partition n, all others partition 0; folders may be nested, names that begin with
``_`` or ``.`` are not looked at.

Offsets. When the reader first sees a file it gives it the partition's next number
(files first seen together: by modification time, then path) and keeps it in the
stream's offset, with the bytes taken from it. A line's ``offset`` is that number and
the byte at which the line starts, so offsets order a partition's lines totally,
whatever the files' times, and never change: files may grow, and a restart goes on
inside a file. A file that has left the folder leaves the offset, so an offset is as
long as the folder's list of files, which the topic's retention bounds.

Only whole lines are taken. Bytes after the last line feed wait until the line is
ended, or until the file has not changed for ``settleMs``. A file that becomes shorter
than what was taken from it is an error.

Options: ``path``; ``topic`` (default: the folder's name); ``startingOffsets``:
``earliest``, ``latest`` or JSON ``{"<partition>": offset}`` (the first offset wanted; a
partition that is not named starts at its earliest, -1 at its latest);
``endingOffsets`` likewise for ``read`` (exclusive); ``maxBytesPerTrigger``;
``splitBytes`` (a task reads about so much, files are split); ``settleMs``.

``maxBytesPerTrigger`` holds for triggers that go on. Spark asks a Python source for
its end once under ``availableNow``: give no limit there.

Listing happens in the driver's planner process, reading in the tasks, both through
``pyarrow.fs`` (local, HDFS, S3, GCS paths).
"""

from __future__ import annotations

import json
import re
import time
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "fieldwatch_topic"
#: an offset is a file's number and a byte of it; ``seq`` adds the partition
BYTE_BITS, PARTITION_BITS, NUMBER_BITS = 32, 6, 25
SCHEMA = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
_CHUNK = 4 << 20
_PARTITION = re.compile(r"(?:^|/)partition=(\d+)/")


@dataclass
class Lines(InputPartition):
    """The lines of a file that start from ``first`` on and before ``stop``. Lines end
    before ``end``."""

    path: str
    partition: int
    number: int
    begin: int  # a line starts here
    first: int
    stop: int
    end: int
    stamp_us: int


class _Folder:
    """What both readers share: the files, and offsets over them."""

    def __init__(self, options):
        path = options.get("path")
        if not path:
            raise ValueError("the topic's folder (path) is required")
        self.fs, self.root = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("/") \
            else (pafs.LocalFileSystem(), path)
        self.root = self.root.rstrip("/")
        self.topic = options.get("topic") or self.root.rsplit("/", 1)[-1]
        self.split = int(options.get("splitBytes", 64 << 20))
        self.settle_ms = int(options.get("settleMs", 60_000))
        self.limit = int(options.get("maxBytesPerTrigger", 0)) or None

    def files(self) -> dict[int, list]:
        """Partition -> [(time in ms, name, size)], in order of time and name."""
        out = {}
        for info in self.fs.get_file_info(pafs.FileSelector(self.root, recursive=True, allow_not_found=True)):
            name = info.path[len(self.root) + 1:]
            if info.type != pafs.FileType.File or any(x.startswith(("_", ".")) for x in name.split("/")):
                continue
            m = _PARTITION.search(name)
            partition = int(m[1]) if m else 0
            if partition >= 1 << PARTITION_BITS:
                raise ValueError(f"more than {1 << PARTITION_BITS} partitions: {name}")
            if info.size >= 1 << BYTE_BITS:
                raise ValueError(f"{name} has {info.size} bytes; roll files below {1 << BYTE_BITS}")
            out.setdefault(partition, []).append((info.mtime_ns // 1_000_000, name, info.size))
        return {p: sorted(found) for p, found in sorted(out.items())}

    def whole(self, name: str, done: int, size: int, stamp: int) -> int:
        """Where the whole lines of a file end that has ``size`` bytes."""
        if size <= done or time.time() * 1000 - stamp >= self.settle_ms:
            return max(size, done)
        with self.fs.open_input_file(f"{self.root}/{name}") as f:
            at = size
            while at > done:
                low = max(done, at - (1 << 16))
                hit = f.read_at(at - low, low).rfind(b"\n")
                if hit >= 0:
                    return low + hit + 1
                at = low
        return done

    def line_end(self, name: str, at: int, end: int) -> int:
        """The end of the line that holds byte ``at - 1``."""
        with self.fs.open_input_file(f"{self.root}/{name}") as f:
            at -= 1
            while at < end:
                hit = f.read_at(min(1 << 16, end - at), at).find(b"\n")
                if hit >= 0:
                    return at + hit + 1
                at += 1 << 16
        return end

    def advance(self, known: dict, limit: int | None = None) -> dict:
        """The offset that takes all whole lines beyond ``known``, or about ``limit`` bytes of
        them, oldest files first."""
        out, waiting = {}, []
        for partition, found in self.files().items():
            was = known.get(str(partition), {"next": 0, "files": {}})
            number, files = was["next"], {}
            for stamp, name, size in found:
                if name not in was["files"]:
                    if number >= 1 << NUMBER_BITS:
                        raise ValueError(f"partition {partition} has had {number} files")
                    files[name] = [number, 0]
                    number += 1
                else:
                    files[name] = list(was["files"][name])
                no, done = files[name]
                if size < done:
                    raise ValueError(f"{name} has {size} bytes, but {done} were read from it")
                if size > done:
                    waiting.append((no, partition, name, done, size, stamp))
            out[str(partition)] = {"next": number, "files": files}
        for partition, was in known.items():  # a partition whose files have all gone keeps its count
            out.setdefault(partition, {"next": was["next"], "files": {}})
        left = limit
        for no, partition, name, done, size, stamp in sorted(waiting):
            if left is not None and left <= 0:
                break
            end = self.whole(name, done, size, stamp)
            if left is not None:
                if end - done > left:
                    end = self.line_end(name, done + left, end)
                left -= end - done
            out[str(partition)]["files"][name][1] = end
        return out

    def at(self, offsets: str) -> dict:
        """The offset that an option names."""
        all_lines = self.advance({})
        if offsets == "latest":
            return all_lines
        nothing = {p: {"next": x["next"], "files": {n: [no, 0] for n, (no, _) in x["files"].items()}}
                   for p, x in all_lines.items()}
        if offsets == "earliest":
            return nothing
        for partition, offset in json.loads(offsets).items():
            if partition not in nothing:
                continue
            number, byte = int(offset) >> BYTE_BITS, int(offset) & ((1 << BYTE_BITS) - 1)
            for name, own in nothing[partition]["files"].items():
                end = all_lines[partition]["files"][name][1]
                if int(offset) < 0 or own[0] < number:
                    own[1] = end
                elif own[0] == number and byte:
                    own[1] = min(end, self.line_end(name, byte, end)) if byte < end else end
        return nothing

    def ranges(self, start: dict, end: dict) -> list[Lines]:
        stamps = None
        out = []
        for partition, now in end.items():
            was = start.get(partition, {"files": {}})["files"]
            for name, (number, stop) in now["files"].items():
                begin = was.get(name, (number, 0))[1]
                if stop <= begin:
                    continue
                if stamps is None:
                    stamps = {n: t for found in self.files().values() for t, n, _ in found}
                for low in range(begin, stop, self.split):
                    out.append(Lines(f"{self.root}/{name}", int(partition), number, begin, low,
                                     min(low + self.split, stop), stop, stamps.get(name, 0) * 1000))
        return out

    def read(self, part: Lines):
        """Batches of the rows of one range."""
        with self.fs.open_input_file(part.path) as f:
            f.seek(part.first)
            at, rest = part.first, b""
            if part.first > part.begin:  # the line that holds the byte before belongs to the range before
                f.seek(part.first - 1)
                at = part.first - 1
                skip = True
            else:
                skip = False
            while at < part.stop or rest:
                data = f.read(min(_CHUNK, part.end - at - len(rest))) if at + len(rest) < part.end else b""
                ended = at + len(rest) + len(data) >= part.end
                data = rest + data
                cut = data.rfind(b"\n") + 1
                if ended and cut < len(data):
                    cut = len(data)  # a settled last line without a line feed
                whole, rest = data[:cut], data[cut:]
                if whole:
                    yield from self._rows(part, at, whole, skip)
                    skip = False
                at += cut
                if ended or at >= part.stop:
                    break

    def _rows(self, part: Lines, at: int, data: bytes, skip: bool):
        lines = data.split(b"\n")
        if not lines[-1]:
            lines.pop()
        values, offsets = [], []
        base = part.number << BYTE_BITS
        for k, line in enumerate(lines):
            here, at = at, at + len(line) + 1
            if here >= part.stop:
                break
            if skip and k == 0:
                continue
            line = line[:-1] if line.endswith(b"\r") else line
            if line:
                values.append(line)
                offsets.append(base + here)
        n = len(values)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.binary()), pa.array(values, pa.binary()), pa.array([self.topic] * n, pa.string()),
                 pa.array([part.partition] * n, pa.int32()), pa.array(offsets, pa.int64()),
                 pa.array([part.stamp_us] * n, pa.timestamp("us", tz="UTC"))],
                ["key", "value", "topic", "partition", "offset", "timestamp"])


class TopicStream(DataSourceStreamReader):
    def __init__(self, options):
        self.folder = _Folder(options)
        self.starting = options.get("startingOffsets", "latest")
        self.first = self.now = None  # where a new query starts; how far the query is planned

    def initialOffset(self) -> dict:
        self.first = self.first or self.folder.at(self.starting)
        return self.first

    def latestOffset(self) -> dict:
        # asked before the initial offset of a new query, and after the last one of an old query
        if self.now is None:
            self.now = self.initialOffset()
        return self.folder.advance(self.now, self.folder.limit)

    def partitions(self, start: dict, end: dict):
        self.now = end  # also called with the last offset when a query starts again
        return self.folder.ranges(start, end)

    def read(self, partition: Lines):
        return self.folder.read(partition)


class TopicBatch(DataSourceReader):
    def __init__(self, options):
        self.folder = _Folder(options)
        self.starting, self.ending = options.get("startingOffsets", "earliest"), options.get("endingOffsets", "latest")

    def partitions(self):
        return self.folder.ranges(self.folder.at(self.starting), self.folder.at(self.ending)) or [InputPartition(None)]

    def read(self, partition):
        return self.folder.read(partition) if isinstance(partition, Lines) else iter(())


class FolderTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TopicStream:
        return TopicStream(self.options)

    def reader(self, schema) -> TopicBatch:
        return TopicBatch(self.options)


def register(spark) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(FolderTopic)
