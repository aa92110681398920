"""A message log in files whose offsets can be replayed, as a Spark data source.

A log is a folder of numbered segments, ``segment=00000001`` and so on, each written as a whole and
never changed; a segment counts once its success file is there. An offset is a segment, a file of it
by name, and a number of messages of that file, so it says how far a reader has come without listing
what it has read. A stream asks for the messages between two offsets, and gets the same ones however
often it asks: after a restart it goes on in the middle of a file.

Register ``MessageSegments`` once a session, then ``spark.readStream.format("message_segments")``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from reelhouse.functions.events import to_wire
from reelhouse.sources.event_log import WIRE_SCHEMA

PREFIX = "segment="
DONE = "_SUCCESS"
MESSAGES_PER_PARTITION = 1_000_000
#: Messages decoded together, and bytes of a column read ahead.
READ_ROWS, READ_BYTES = 10_000, 1 << 20


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def segments(path: str, after: int = 0) -> list[int]:
    """Numbers of the finished segments above ``after``."""
    files, root = _opened(path)
    found = files.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    names = [f.base_name for f in found if f.type == pafs.FileType.Directory]
    numbers = sorted(int(n[len(PREFIX) :]) for n in names if n.startswith(PREFIX))
    done = lambda n: files.get_file_info(f"{root}/{_name(n)}/{DONE}").type == pafs.FileType.File
    return [n for n in numbers if n > after and done(n)]


def _name(number: int) -> str:
    return f"{PREFIX}{number:08d}"


def append_segment(events: DataFrame, path: str) -> int:
    """Write events as the next segment, and return its number. One writer at a time."""
    number = max(segments(path), default=0) + 1
    to_wire(events).write.mode("overwrite").parquet(f"{path}/{_name(number)}")
    return number


@dataclass
class Span(InputPartition):
    """Messages ``begin`` to ``end`` of one file."""

    file: str
    begin: int
    end: int


@dataclass(frozen=True, order=True)
class Place:
    """An offset: the messages of all earlier files, and the first ``messages`` of ``file``."""

    segment: int = 0
    file: str = ""
    messages: int = 0

    @classmethod
    def of(cls, offset: dict) -> Place:
        return cls(offset["segment"], offset["file"], offset["messages"])

    def offset(self) -> dict:
        return {"segment": self.segment, "file": self.file, "messages": self.messages}


class _Log:
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.files, self.root = _opened(self.path)

    def _sizes(self, segment: int) -> list[tuple[str, int]]:
        """Files of a segment by name, with their messages; footers only are read."""
        found = self.files.get_file_info(pafs.FileSelector(f"{self.root}/{_name(segment)}"))
        names = sorted(f.base_name for f in found if f.base_name.endswith(".parquet"))
        at = lambda n: f"{self.root}/{_name(segment)}/{n}"
        return [(n, pq.read_metadata(at(n), filesystem=self.files).num_rows) for n in names]

    def end(self, start: Place, most: int | None = None) -> Place:
        """The place after all messages there are, or after ``most`` more than at ``start``."""
        place, left = start, most
        for segment in segments(self.path, start.segment - 1):
            for name, size in self._sizes(segment):
                here = Place(segment, name, size)
                if here <= start:
                    continue
                begin = start.messages if (segment, name) == (start.segment, start.file) else 0
                if left is not None and size - begin > left:
                    return Place(segment, name, begin + left) if left else place
                left = None if left is None else left - (size - begin)
                place = here
        return place

    def spans(self, start: Place, stop: Place, most: int) -> list[Span]:
        out = []
        for segment in [n for n in segments(self.path, start.segment - 1) if n <= stop.segment]:
            for name, size in self._sizes(segment):
                at = (segment, name)
                if at < (start.segment, start.file) or at > (stop.segment, stop.file):
                    continue
                begin = start.messages if at == (start.segment, start.file) else 0
                end = stop.messages if at == (stop.segment, stop.file) else size
                for cut in range(begin, end, most):
                    out.append(Span(f"{self.root}/{_name(segment)}/{name}", cut, min(end, cut + most)))
        return out

    def read(self, span: Span) -> Iterator:
        """Record batches of a span; row groups outside it are not read.

        Pages are decoded as they are asked for, so that no row group is held as a whole.
        """
        with self.files.open_input_file(span.file) as opened:
            file = pq.ParquetFile(opened, buffer_size=READ_BYTES)
            at = 0
            for group in range(file.num_row_groups):
                size = file.metadata.row_group(group).num_rows
                begin, end = max(span.begin - at, 0), min(span.end - at, size)
                if begin < end:
                    place = 0
                    for rows in file.iter_batches(READ_ROWS, row_groups=[group], columns=["key", "value"]):
                        first, last = max(begin - place, 0), min(end - place, rows.num_rows)
                        if first < last:
                            yield rows.slice(first, last - first)
                        place += rows.num_rows
                        if place >= end:
                            break
                at += size


class MessageReader(DataSourceReader):
    """All messages of the log, in partitions of bounded size."""

    def __init__(self, options: dict):
        self.log = _Log(options)
        self.most = int(options.get("messagesperpartition", MESSAGES_PER_PARTITION))

    def partitions(self) -> list[Span]:
        return self.log.spans(Place(), self.log.end(Place()), self.most)

    def read(self, partition: Span) -> Iterator:
        return self.log.read(partition)


class MessageStreamReader(DataSourceStreamReader):
    """Messages between offsets. ``messagesUpTo`` ends the stream's view at that many messages."""

    def __init__(self, options: dict):
        self.log = _Log(options)
        self.most = int(options.get("messagesperpartition", MESSAGES_PER_PARTITION))
        up_to = options.get("messagesupto")
        self.up_to = int(up_to) if up_to else None
        self.known = Place()

    def initialOffset(self) -> dict:
        return Place().offset()

    def latestOffset(self) -> dict:
        if self.up_to is None:
            # What was there before is not listed again.
            self.known = self.log.end(self.known)
            return self.known.offset()
        return self.log.end(Place(), self.up_to).offset()

    def partitions(self, start: dict, end: dict) -> list[Span]:
        return self.log.spans(Place.of(start), Place.of(end), self.most)

    def read(self, partition: Span) -> Iterator:
        return self.log.read(partition)

    def commit(self, end: dict) -> None:
        """Nothing to do: the log keeps its messages."""


class MessageSegments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_segments"

    def schema(self) -> str:
        return WIRE_SCHEMA

    def reader(self, schema) -> MessageReader:
        return MessageReader(self.options)

    def streamReader(self, schema) -> MessageStreamReader:
        return MessageStreamReader(self.options)


def read_segments(spark: SparkSession, path: str, up_to: int | None = None) -> DataFrame:
    """Unbounded messages of a log; with ``up_to`` no more than so many from its start."""
    spark.dataSource.register(MessageSegments)
    reader = spark.readStream.format("message_segments").option("path", path)
    if up_to is not None:
        reader = reader.option("messagesUpTo", up_to)
    return reader.load()


def read_all_segments(spark: SparkSession, path: str) -> DataFrame:
    """The messages of a log as a table."""
    spark.dataSource.register(MessageSegments)
    return spark.read.format("message_segments").option("path", path).load()
