"""A partitioned topic log in files, as a Spark data source (A1, A2, B6 without a broker).

``spark.dataSource.register(TopicLog)`` (or ``register(spark)``) adds the format
``topiclog`` with the options ``path``, ``topic`` and:

* writing (batch and stream): ``partitions`` (default 8), ``writer`` (the name under which
  batches of a stream are told apart).  Rows have ``key`` and ``value``; rows of one
  key go to one partition.
* reading (stream): ``maxCommitsPerTrigger``, ``group`` (whose progress is kept in the
  log), ``startingOffsets`` (earliest, latest).  A run with ``availableNow`` asks once where
  the log ends, so with a limit it reads that many commits; without one, all.  Rows are key, value, partition, offset.

Layout of a topic: ``segments/partition=<p>/<unique>.jsonl`` and ``commits/<n>.json``.
Tasks write segments under names of their own.  When all have succeeded the driver
writes one commit file, which gives every segment its first offset and names the last
batch of each writer: a commit is there as a whole or not at all.  Segments of
failed, repeated or speculative tasks are in no commit, so nobody reads them; a
batch that its writer has committed before is not committed again; an aborted
batch's segments are deleted.  A reader's position is a number of commits; it is
kept in Spark's checkpoint, so a restarted query reads every message once.

Files are reached through ``pyarrow.fs`` (local, HDFS, S3, GCS paths), by the
executors for segments and by the driver for commits.  One committing writer per
topic at a time.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceStreamReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage,
)

FORMAT = "topiclog"
SCHEMA = "key string, value string, partition int, offset bigint"
ROWS = 4096  # messages of one Arrow batch


class Store:
    """The files of one topic."""

    def __init__(self, path: str, topic: str):
        self.uri = f"{path.rstrip('/')}/{topic}"
        self.fs, self.base = pafs.FileSystem.from_uri(self.uri if "://" in self.uri else f"file://{self.uri}")

    def names(self, folder: str) -> list[str]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.base}/{folder}", allow_not_found=True))
        return sorted(i.base_name for i in found if i.type == pafs.FileType.File)

    def get(self, name: str) -> bytes:
        with self.fs.open_input_stream(f"{self.base}/{name}") as f:
            return f.read()

    def put(self, name: str, data: bytes) -> None:
        """The whole file or none: written beside its place, then moved."""
        folder, last = name.rsplit("/", 1)
        self.fs.create_dir(f"{self.base}/{folder}", recursive=True)
        beside = f"{self.base}/{folder}/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(beside) as f:
            f.write(data)
        self.fs.move(beside, f"{self.base}/{folder}/{last}")

    def delete(self, name: str) -> None:
        if self.fs.get_file_info(f"{self.base}/{name}").type == pafs.FileType.File:
            self.fs.delete_file(f"{self.base}/{name}")

    def last_commit(self) -> int:
        """Number of the newest commit, -1 without one."""
        found = [n for n in self.names("commits") if n.endswith(".json")]
        return int(found[-1][:-5]) if found else -1

    def commit(self, n: int) -> dict:
        return json.loads(self.get(f"commits/{n:012d}.json")) if n >= 0 else {"ends": {}, "writers": {}, "segments": []}


@dataclass
class Written(WriterCommitMessage):
    segments: list  # (partition, name, messages)


class _Writer:
    def __init__(self, options):
        self.path, self.topic = options["path"], options["topic"]
        self.partitions, self.writer = int(options.get("partitions", 8)), options.get("writer")

    def write(self, rows) -> Written:
        """Segments of one task attempt, one per partition it has rows of."""
        store, name = Store(self.path, self.topic), uuid.uuid4().hex
        out, counts = {}, {}
        try:
            for row in rows:
                key, value = row["key"], row["value"]
                p = zlib.crc32(key.encode()) % self.partitions if key is not None else counts.get("rows", 0) % self.partitions
                counts["rows"] = counts.get("rows", 0) + 1
                if p not in out:
                    folder = f"{store.base}/segments/partition={p}"
                    store.fs.create_dir(folder, recursive=True)
                    out[p] = store.fs.open_output_stream(f"{folder}/{name}.jsonl")
                out[p].write((json.dumps([key, value]) + "\n").encode())
                counts[p] = counts.get(p, 0) + 1
        finally:
            for f in out.values():
                f.close()
        return Written([(p, f"segments/partition={p}/{name}.jsonl", counts[p]) for p in sorted(out)])

    def _discard(self, messages) -> None:
        store = Store(self.path, self.topic)
        for m in messages:
            for _, name, _ in m.segments if m else ():
                store.delete(name)

    def _commit(self, messages, batch: int | None) -> None:
        store = Store(self.path, self.topic)
        n = store.last_commit()
        before = store.commit(n)
        if batch is not None and before["writers"].get(self.writer, -1) >= batch:
            self._discard(messages)  # this batch is in the log already
            return
        ends, segments = dict(before["ends"]), []
        for p, name, count in sorted(s for m in messages if m for s in m.segments):
            first = ends.get(str(p), 0)
            segments.append([p, first, count, name])
            ends[str(p)] = first + count
        writers = before["writers"] if batch is None else {**before["writers"], self.writer: batch}
        store.put(f"commits/{n + 1:012d}.json", json.dumps({"ends": ends, "writers": writers, "segments": segments}).encode())


class BatchWriter(_Writer, DataSourceWriter):
    def commit(self, messages) -> None:
        self._commit(messages, None)

    def abort(self, messages) -> None:
        self._discard(messages)


class StreamWriter(_Writer, DataSourceStreamWriter):
    def __init__(self, options):
        super().__init__(options)
        if not self.writer:
            raise ValueError("a stream that writes a topic log needs the option writer")

    def commit(self, messages, batchId: int) -> None:
        self._commit(messages, batchId)

    def abort(self, messages, batchId: int) -> None:
        self._discard(messages)


@dataclass
class Segment(InputPartition):
    partition: int
    first: int
    count: int
    name: str


class StreamReader(DataSourceStreamReader):
    """Position: {"commit": n}, all commits up to ``n`` have been read.

    Spark asks for the latest position before it tells a restarted query's own.  So
    that a limit holds then too, the position offered last is kept in the log under
    the group's name, before Spark can note it: Spark stands there or before it.  The
    first answer after a start repeats it, and if nothing came of that, Spark stands
    there, and the next answers go on from it.
    """

    def __init__(self, options):
        self.path, self.topic = options["path"], options["topic"]
        options = {k.lower(): v for k, v in options.items()}
        self.limit, self.group = int(options.get("maxcommitspertrigger", 0)), options.get("group")
        if self.limit and not self.group:
            raise ValueError("maxCommitsPerTrigger needs the option group")
        self.latest = options.get("startingoffsets", "earliest") == "latest"
        self.at: int | None = None  # where Spark stands, once it has told us
        self.asked = False

    def _progress(self, store: Store, **new) -> dict:
        name = f"groups/{self.group}.json"
        known = json.loads(store.get(name)) if name.split("/")[1] in store.names("groups") else {"offered": -1, "commit": -1}
        if new and {**known, **new} != known:
            store.put(name, json.dumps({**known, **new}).encode())
        return known

    def initialOffset(self) -> dict:
        return {"commit": Store(self.path, self.topic).last_commit() if self.latest else -1}

    def latestOffset(self) -> dict:
        """The newest commit, or ``limit`` commits on from where Spark stands."""
        store = Store(self.path, self.topic)
        newest = store.last_commit()
        if not self.limit:
            return {"commit": newest}
        offered = self._progress(store)["offered"]
        if self.at is not None:
            offered = self.at + self.limit
        elif self.asked or offered < 0:
            offered += self.limit
        self.asked = True
        self._progress(store, offered=min(newest, offered))
        return {"commit": min(newest, offered)}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        self.at = end["commit"]
        store = Store(self.path, self.topic)
        return [Segment(*s) for n in range(start["commit"] + 1, end["commit"] + 1) for s in store.commit(n)["segments"]]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        store, rows, offset = Store(self.path, self.topic), [], partition.first
        with store.fs.open_input_stream(f"{store.base}/{partition.name}") as f:
            for line in _lines(f):
                rows.append((*json.loads(line), partition.partition, offset))
                offset += 1
                if len(rows) == ROWS:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)

    def commit(self, end: dict) -> None:
        if self.group:
            self._progress(Store(self.path, self.topic), **end)


def _lines(stream, size: int = 1 << 20) -> Iterator[bytes]:
    rest = b""
    while chunk := stream.read(size):
        *whole, rest = (rest + chunk).split(b"\n")
        yield from whole
    if rest:
        yield rest


def _batch(rows) -> pa.RecordBatch:
    key, value, partition, offset = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.string()), pa.array(value, pa.string()), pa.array(partition, pa.int32()), pa.array(offset, pa.int64())],
        names=["key", "value", "partition", "offset"])


class TopicLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(self.options)

    def streamWriter(self, schema, overwrite) -> StreamWriter:
        return StreamWriter(self.options)

    def writer(self, schema, overwrite) -> BatchWriter:
        if overwrite:
            raise ValueError("a topic log is only appended to")
        return BatchWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TopicLog)
