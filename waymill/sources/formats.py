"""Sources of Spark's Python data source interface: members of zip archives, and a landed message log.

    register(spark)
    spark.read.format("zip_members").option("path", "in/*.zip").schema("a string, b string").load()
    spark.readStream.format("message_log").option("path", "log").option("group", "trips").load()

Files are opened by URI (local paths, hdfs, s3 and what else Arrow's file systems know), on the tasks, and read in pieces.
"""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: Rows of an Arrow batch; bytes looked at in one step for the end of the last whole message.
ROWS, TAIL = 10_000, 1 << 16


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if urlparse(path).scheme else (fs.LocalFileSystem(), path)


def listed(path: str, pattern: str | None = None) -> list[str]:
    """The file, or the files of a folder whose name matches, or those that a path with * in its last part names."""
    folder, _, last = path.rpartition("/")
    if "*" in last:
        path, pattern = folder, "^" + ".*".join(map(re.escape, last.split("*"))) + "$"
    files, own = opened(path)
    info = files.get_file_info(own)
    if info.type == fs.FileType.File:
        return [path]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    names = [x.base_name for x in files.get_file_info(fs.FileSelector(own)) if x.type == fs.FileType.File]
    return [f"{path.rstrip('/')}/{n}" for n in sorted(names) if re.search(pattern or "", n)]


def column_order(header: list[str], names: list[str], where: str) -> list[int]:
    """Where each name stands in a header, in whatever order; a missing or repeated one is an error."""
    for n in names:
        if header.count(n) != 1:
            raise ValueError(f"{where}: column {n} is there {header.count(n)} times")
    return [header.index(n) for n in names]


@dataclass
class Member(InputPartition):
    path: str
    name: str


class ZipMembers(DataSource):
    """Delimited members of zip archives, one task for each member, whose bytes are read as they are needed.

    Options: path (a file, a folder, or a name with *), members (a pattern; all by default, or "first"), sep, encoding,
    password, skip (columns that may be there). The schema's columns, all text, are found by name in whatever order; other
    columns must be in skip, or have no values. ``path`` and ``member`` in the schema are the file's and the member's name.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        raise ValueError("give a schema: the text columns that the members have")

    def reader(self, schema: StructType) -> ZipReader:
        return ZipReader(dict(self.options), schema.fieldNames())


class ZipReader(DataSourceReader):
    def __init__(self, options: dict[str, str], names: list[str]) -> None:
        self.options, self.names = options, names

    def partitions(self) -> list[Member]:
        out = []
        for path in listed(self.options["path"], r"\.zip$"):
            files, own = opened(path)
            with files.open_input_file(own) as raw, zipfile.ZipFile(raw) as z:
                found = [x.filename for x in z.infolist() if not x.is_dir()]
            wanted = self.options.get("members", "")
            out += [Member(path, m) for m in (found[:1] if wanted == "first" else [m for m in found if re.search(wanted, m)])]
        return out

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        files, own = opened(partition.path)
        password = self.options.get("password")
        with files.open_input_file(own) as raw, zipfile.ZipFile(raw) as z, z.open(partition.name, pwd=password.encode() if password else None) as member:
            lines = csv.reader(io.TextIOWrapper(member, encoding=self.options.get("encoding", "utf-8-sig"), newline=""), delimiter=self.options.get("sep", ";"))
            where = f"{partition.path}/{partition.name}"
            header = next(lines, None)
            if header is None:
                return
            given = {"path": partition.path, "member": partition.name}
            wanted = [n for n in self.names if n not in given]
            order = column_order(header, wanted, where)
            skip = set(self.options.get("skip", "").split(","))
            other = [k for k, n in enumerate(header) if n not in wanted and n not in skip]
            while part := [x for x in islice(lines, ROWS) if x]:
                for k in other:
                    if any(len(x) > k and x[k].strip() not in ("", "0") for x in part):
                        raise ValueError(f"{where}: column {header[k]} is not expected and has values")
                found = {n: [x[k] if len(x) > k and x[k] != "" else None for x in part] for n, k in zip(wanted, order)}
                yield pa.RecordBatch.from_pydict({n: pa.array([given[n]] * len(part) if n in given else found[n], pa.string()) for n in self.names})


@dataclass
class Span(InputPartition):
    path: str
    key: str
    start: int
    end: int


class MessageLog(DataSource):
    """Messages of a landed log: files to which lines are appended, one file for each partition of a topic.

    Options: path (the folder), group (a consumer's name), bytes (the most that a batch takes of each file), from
    ("earliest", the default, or "latest"). Offsets are places in each file, up to the last whole line. A batch's offsets are committed under
    ``_commits/<group>.json`` when the next one begins (``consume`` does so at the end too); a new query of the group goes on from
    there, one with a checkpoint from its checkpoint. With ``trigger(availableNow=True)`` it takes what there is and ends.
    """

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return "partition string, offset long, value string"

    def streamReader(self, schema: StructType) -> LogReader:
        return LogReader(dict(self.options))

    def reader(self, schema: StructType) -> LogReader:
        return BoundedLogReader(dict(self.options))


class Log:
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.group = options["path"].rstrip("/"), options.get("group")
        self.most, self.start = int(options.get("bytes", 0)), options.get("from", "earliest")
        self.taken: dict[str, int] | None = None

    def ends(self) -> dict[str, int]:
        """The end of the last whole line of each file."""
        out = {}
        for path in listed(self.path, r"\.jsonl?$|\.log$"):
            files, own = opened(path)
            with files.open_input_file(own) as f:
                at = f.size()
                while at:
                    low = max(0, at - TAIL)
                    f.seek(low)
                    if (cut := f.read(at - low).rfind(b"\n")) >= 0:
                        at = low + cut + 1
                        break
                    at = low
            out[path.rpartition("/")[2]] = at
        return out

    def committed(self) -> dict[str, int]:
        if not self.group:
            return {}
        files, own = opened(f"{self.path}/_commits/{self.group}.json")
        if files.get_file_info(own).type != fs.FileType.File:
            return {}
        with files.open_input_stream(own) as f:
            return json.loads(f.read())

    def commit(self, end: dict[str, int]) -> None:
        if self.group:
            files, own = opened(f"{self.path}/_commits/{self.group}.json")
            files.create_dir(own.rpartition("/")[0], recursive=True)
            with files.open_output_stream(own) as f:
                f.write(json.dumps(end).encode())

    def whole_line(self, key: str, start: int, end: int) -> int:
        """The end of the last line that ends by ``start + most``; of the first one if that is longer."""
        if not self.most or end - start <= self.most:
            return end
        files, own = opened(f"{self.path}/{key}")
        with files.open_input_file(own) as f:
            f.seek(start)
            part = f.read(self.most)
            if (cut := part.rfind(b"\n")) >= 0:
                return start + cut + 1
            at = start + len(part)
            while part := f.read(TAIL):
                if (cut := part.find(b"\n")) >= 0:
                    return at + cut + 1
                at += len(part)
        return end

    def spans(self, start: dict[str, int], end: dict[str, int]) -> list[Span]:
        return [Span(f"{self.path}/{k}", k, start.get(k, 0), e) for k, e in sorted(end.items()) if e > start.get(k, 0)]

    def read(self, partition: Span) -> Iterator[tuple]:
        files, own = opened(partition.path)
        with files.open_input_file(own) as f:
            f.seek(partition.start)
            at, rest = partition.start, b""
            while at + len(rest) < partition.end:
                part = rest + f.read(min(1 << 20, partition.end - at - len(rest)))
                *lines, rest = part.split(b"\n")
                for line in lines:
                    yield partition.key, at, line.decode("utf-8", "replace")
                    at += len(line) + 1


class LogReader(Log, DataSourceStreamReader):
    def initialOffset(self) -> dict[str, int]:
        return self.committed() or (self.ends() if self.start == "latest" else {})

    def latestOffset(self, start: dict[str, int] | None = None, limit: object = None) -> dict[str, int]:
        ends = self.ends()
        if not self.most:
            return ends
        before = self.taken if self.taken is not None else start or self.initialOffset()
        self.taken = before | {k: self.whole_line(k, before.get(k, 0), e) for k, e in ends.items()}
        return self.taken

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Span]:
        return self.spans(start, end)


class BoundedLogReader(Log, DataSourceReader):
    """What there is since the group's last commit; nothing is committed by reading."""

    def partitions(self) -> list[Span]:
        return self.spans(self.committed(), self.ends())


def register(spark: SparkSession) -> None:
    for source in (ZipMembers, MessageLog):
        spark.dataSource.register(source)


def consume(spark: SparkSession, path: str, group: str, use: Callable[[DataFrame, int], None], checkpoint: str, **options: str) -> None:
    """Gives all messages there are to ``use``, batch by batch, and commits for the group when all are done."""
    read = spark.readStream.format("message_log").options(path=path, group=group, **options).load()
    query = read.writeStream.foreachBatch(use).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    done = [p for p in query.recentProgress if p.numInputRows]
    if done:
        Log({"path": path, "group": group}).commit(json.loads(done[-1].json)["sources"][0]["endOffset"])
