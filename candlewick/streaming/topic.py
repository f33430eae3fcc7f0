"""A topic of numbered messages in files, read as a stream without a broker.

A topic is a folder with one folder per partition. A partition is a row of segments that are written once, each named by
the offsets it holds, ``<first>-<end>.jsonl`` (end excluded), with one message per line: its value and its time. Offsets
are thus known from names alone, and a range of offsets is read by one task from the segments that overlap it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime, timedelta, timezone

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from candlewick.session import ship
from candlewick.sources.schemas import RAW_MESSAGE

FORMAT = "candlewick_topic"
SEGMENT = re.compile(r"(\d+)-(\d+)\.jsonl")
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def names(path: str, kind: fs.FileType) -> list[str]:
    system, at = opened(path)
    found = system.get_file_info(fs.FileSelector(at, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == kind and not f.base_name.startswith((".", "_")))


def segments(path: str, partition: str) -> list[tuple[int, int]]:
    """First offset and end of each segment of a partition, in order."""
    hits = [SEGMENT.fullmatch(n) for n in names(f"{path}/{partition}", fs.FileType.File)]
    return sorted((int(m[1]), int(m[2])) for m in hits if m)


def ends(path: str) -> dict[str, int]:
    """The end of each partition: the offset that its next message will have."""
    return {p: max((e for _, e in segments(path, p)), default=0) for p in names(path, fs.FileType.Directory) if p.isdigit()}


def write_text(path: str, text: str) -> None:
    """A file that appears whole: written aside, then renamed."""
    system, at = opened(path)
    folder, _, name = at.rpartition("/")
    system.create_dir(folder, recursive=True)
    with system.open_output_stream(f"{folder}/.{name}") as out:
        out.write(text.encode())
    system.move(f"{folder}/.{name}", at)


def write_segment(path: str, partition: int, first: int, messages: Iterable[tuple[str, datetime]]) -> int:
    """One segment of messages (value, time) that begins at an offset; the offset after its last one."""
    lines = [json.dumps([value, round((at.replace(tzinfo=at.tzinfo or timezone.utc) - EPOCH) / timedelta(microseconds=1))]) for value, at in messages]
    if lines:
        write_text(f"{path}/{partition}/{first:020d}-{first + len(lines):020d}.jsonl", "\n".join(lines) + "\n")
    return first + len(lines)


def append_segment(path: str, partition: int, messages: Iterable[tuple[str, datetime]]) -> tuple[int, int]:
    """Adds messages to the end of a partition, as one segment; its offsets. One writer per partition."""
    first = ends(path).get(str(partition), 0)
    return first, write_segment(path, partition, first, messages)


class Range(InputPartition):
    """Offsets of one topic partition, for one task."""

    def __init__(self, partition: str, first: int, end: int):
        self.partition, self.first, self.end = partition, first, end


class TopicReader(DataSourceStreamReader):
    """Offsets are a number per topic partition; a partition that comes later begins at its first message.

    With a limit, every planned end is written to ``positions`` before Spark hears of it. After a restart the last
    planned end is offered first, which is never before what Spark has taken in; only then the next one is planned.
    So no batch has more messages than the limit, and none is read twice or left out.
    """

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.start = options.get("startingoffsets", "latest")
        self.most = int(options["maxoffsetspertrigger"]) if "maxoffsetspertrigger" in options else None
        self.positions = options.get("positions", "").rstrip("/")
        if self.most is not None and (self.most < 1 or not self.positions):
            raise ValueError("a limit is a positive number and needs a folder for planned positions")
        self.planned: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        if self.start == "latest":
            first = ends(self.path)
        elif self.start == "earliest":
            first = {p: min((f for f, _ in segments(self.path, p)), default=0) for p in ends(self.path)}
        else:
            first = {p: int(o) for p, o in json.loads(self.start).items()}
        if self.most is not None:
            self._plan(first)
        return first

    def latestOffset(self) -> dict:
        if self.most is None:
            return ends(self.path)
        if self.planned is None:
            found = names(self.positions, fs.FileType.File)
            if found:
                system, at = opened(f"{self.positions}/{found[-1]}")
                with system.open_input_stream(at) as f:
                    self.planned = json.loads(f.read())
                return self.planned
            return self.initialOffset()
        latest, room, goal = ends(self.path), self.most, dict(self.planned)
        waiting = {p: e - goal.get(p, self._first(p)) for p, e in latest.items()}
        while room and any(n > 0 for n in waiting.values()):  # equal shares, what one leaves goes to the others
            open_ones = [p for p, n in waiting.items() if n > 0]
            share = max(1, room // len(open_ones))
            for p in open_ones[:room]:
                n = min(share, waiting[p], room)
                goal[p], waiting[p], room = goal.get(p, self._first(p)) + n, waiting[p] - n, room - n
        if goal != self.planned:
            self._plan(goal)
        return self.planned

    def _first(self, partition: str) -> int:
        return min((f for f, _ in segments(self.path, partition)), default=0)

    def _plan(self, goal: dict[str, int]) -> None:
        number = len(names(self.positions, fs.FileType.File))
        write_text(f"{self.positions}/{number:012d}.json", json.dumps(goal))
        self.planned = goal

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        out = []
        for p, e in sorted(end.items()):
            first = start.get(p)
            first = self._first(p) if first is None else first
            if e > first:
                out.append(Range(p, first, e))
        return out

    def read(self, partition: Range) -> Iterator[tuple]:
        for first, end in segments(self.path, partition.partition):
            if first >= partition.end or end <= partition.first:
                continue
            system, at = opened(f"{self.path}/{partition.partition}/{first:020d}-{end:020d}.jsonl")
            with system.open_input_stream(at) as f:
                for i, line in enumerate(f.read().decode().splitlines()):
                    if partition.first <= first + i < partition.end:
                        value, micros = json.loads(line)
                        yield value, first + i, int(partition.partition), EPOCH + timedelta(microseconds=micros)


class TopicSource(DataSource):
    """Raw messages of a topic folder: value, offset, partition, timestamp."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RAW_MESSAGE

    def streamReader(self, schema) -> TopicReader:
        return TopicReader({k.lower(): v for k, v in self.options.items()})


def read_topic_files(
    spark: SparkSession, path: str, start: str = "latest", max_offsets: int | None = None, positions: str | None = None
) -> DataFrame:
    """Raw messages of a topic folder as a stream.

    ``start`` is ``latest``, ``earliest`` or offsets per partition as JSON, and counts for a new query only. At most
    ``max_offsets`` messages enter a batch; the plan is kept in ``positions``, a folder of this query alone.
    """
    ship(spark)
    spark.dataSource.register(TopicSource)
    options = {"path": path, "startingOffsets": start}
    if max_offsets is not None:
        options |= {"maxOffsetsPerTrigger": str(max_offsets), "positions": positions or ""}
    return spark.readStream.format(FORMAT).options(**options).load()
