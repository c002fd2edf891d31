"""Rows of CSV members inside zip archives of any size.

A data source plans the scan from the archives' central directories: a large
member is a task of its own, small ones share a task. A task opens the archive
as a seekable stream and reads just the ranges of its members, decompressed in
small batches; neither an archive nor a member is ever held whole. A deflated
member cannot be entered in the middle, so one member is one task.
"""

from __future__ import annotations

import io
import json
import sys
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

LINES = "path string, member string, line_no bigint, line string"
FORMAT = "zip_members"
#: Compressed bytes of small members that one task reads.
TASK_BYTES = 64 * 2**20
BATCH_LINES = 20_000
BATCH_BYTES = 16 * 2**20

# Workers get the data source itself, wherever the package is installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Members(InputPartition):
    """Members of archives that one task reads."""

    listed: list[tuple[str, str]]


def _open(uri: str):
    """A seekable stream that reads ranges of the file."""
    from pyarrow.fs import FileSystem

    store, path = FileSystem.from_uri(uri)
    return store.open_input_file(path)


def _directory(uri: str) -> list[tuple[str, str, int]]:
    """(uri, member, compressed bytes) from the end of an archive."""
    with _open(uri) as stream, zipfile.ZipFile(stream) as archive:
        return [(uri, m.filename, m.compress_size) for m in archive.infolist() if not m.is_dir()]


def _records(stream: Iterable[str], multi_line: bool) -> Iterator[str]:
    parts, in_quotes = [], False
    for text in stream:
        parts.append(text)
        if multi_line and text.count('"') % 2:
            in_quotes = not in_quotes
        if not in_quotes:
            yield "".join(parts).rstrip("\r\n")
            parts = []
    if parts:
        yield "".join(parts).rstrip("\r\n")


class ZipMemberReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.archives = json.loads(options["archives"])
        self.members = json.loads(options["members"])
        self.multi_line = options["multi_line"] == "true"
        self.batch_lines = int(options["batch_lines"])

    def partitions(self) -> list[Members]:
        """Large members alone, small ones together. Only names and sizes pass here."""
        wanted = None if self.members is None else set(self.members)
        tasks: list[list[tuple[str, str]]] = []
        room = 0
        with ThreadPoolExecutor(16) as pool:
            for uri, found in zip(self.archives, pool.map(_directory, self.archives)):
                lost = (wanted or set()) - {name for _, name, _ in found}
                if lost:
                    raise KeyError(f"no member {sorted(lost)} in {uri}")
                for _, name, size in found:
                    if wanted is not None and name not in wanted:
                        continue
                    if size > room:
                        tasks.append([])
                        room = TASK_BYTES
                    tasks[-1].append((uri, name))
                    room -= size
        # Spark asks for one partition at least.
        return [Members(task) for task in tasks] or [Members([])]

    def read(self, partition: Members):
        import pyarrow as pa

        schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("line_no", pa.int64()), ("line", pa.string())])

        def batch(uri, name, start, lines):
            numbers = range(start, start + len(lines))
            columns = [[uri] * len(lines), [name] * len(lines), list(numbers), lines]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
            )

        for uri, name in partition.listed:
            with _open(uri) as stream, zipfile.ZipFile(stream) as archive, archive.open(name) as raw:
                text = io.TextIOWrapper(raw, "utf-8-sig", newline="")
                start, size, lines = 0, 0, []
                for record in _records(text, self.multi_line):
                    lines.append(record)
                    size += len(record)
                    if len(lines) == self.batch_lines or size > BATCH_BYTES:
                        yield batch(uri, name, start, lines)
                        start, size, lines = start + len(lines), 0, []
                if lines:
                    yield batch(uri, name, start, lines)


class ZipMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> ZipMemberReader:
        return ZipMemberReader(self.options)


def list_archives(spark: SparkSession, path: str) -> list[str]:
    """Addresses of the zip archives at ``path``: a file, a folder or a pattern."""
    found = spark.read.format("binaryFile").load(path).select("path")  # contents are not read
    return sorted(row["path"] for row in found.collect())


def member_lines(
    spark: SparkSession,
    path: str,
    members: Sequence[str] | None = None,
    multi_line: bool = False,
    batch_lines: int = BATCH_LINES,
) -> DataFrame:
    """(path, member, line_no, line) of the named members, of all where none is
    named, header line included.

    With ``multi_line`` a record with line breaks inside quotes is one line. An
    archive without a named member fails, as extracting it would.
    """
    spark.dataSource.register(ZipMembers)
    options = {
        "archives": json.dumps(list_archives(spark, path)),
        "members": json.dumps(None if members is None else list(members)),
        "multi_line": "true" if multi_line else "false",
        "batch_lines": str(batch_lines),
    }
    return spark.read.format(FORMAT).options(**options).load()


def member_rows(
    spark: SparkSession,
    path: str,
    members: Sequence[str] | None,
    schema: T.StructType,
    multi_line: bool = False,
) -> DataFrame:
    """Parsed rows of the CSV members, whose columns are in the order of
    ``schema``; header and blank lines are skipped."""
    parsed = F.from_csv("line", schema.toDDL(), {"escape": '"'})
    return (
        member_lines(spark, path, members, multi_line)
        .where((F.col("line_no") > 0) & (F.trim("line") != ""))
        .select("path", "member", parsed.alias("row"))
        .select("path", "member", "row.*")
    )
