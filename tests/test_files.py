from __future__ import annotations

import io
import json
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewise.sinks.files import replace_partitions, write_csv, write_partitioned
from statewise.sources import archives
from statewise.sources.archives import member_lines, member_rows
from statewise.sources.files import (
    month_file,
    read_documents,
    read_header_csv,
    read_months,
    read_typed_csv,
    under,
)

PAIR = T.StructType().add("a", "integer").add("b", "string")


def test_paths():
    assert under("s3a://store/base/", "cities", "/c.csv") == "s3a://store/base/cities/c.csv"
    assert month_file("base", "employment", 2019, 3) == "base/employment/201903/employment201903.json"


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text('extra,b,a\n1,"two, ""quoted""",3\n4,,6\n')
    frame = read_header_csv(spark, str(tmp_path / "x.csv"), ["a", "b"])
    assert rows(frame) == [("3", 'two, "quoted"'), ("6", None)]
    with pytest.raises(ValueError, match="no column z"):
        read_header_csv(spark, str(tmp_path / "x.csv"), ["a", "z"])


def test_csv_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_header_csv(spark, str(tmp_path), ["a", "b"]).collect()


def test_typed_csv_keeps_bad_lines(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x\nbad,y\n")
    frame = read_typed_csv(spark, str(tmp_path), PAIR, corrupt="broken")
    assert rows(frame) == [(1, "x", None), (None, "y", "bad,y")]


def test_csv_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([(1, 'a "b", c'), (2, None), (None, "x")], PAIR)
    write_csv(frame, str(tmp_path / "out"))
    write_csv(frame, str(tmp_path / "out"))  # replaces
    assert rows(read_typed_csv(spark, str(tmp_path / "out"), PAIR)) == rows(frame)


def test_empty_document_folder_keeps_its_schema(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"status":"nothing"}\n')
    assert read_documents(spark, str(tmp_path)).select("Results.series").collect()[0][0] is None


def test_months(spark, tmp_path, plan_of):
    path = str(tmp_path / "m")
    months = spark.range(30).select("id", (F.col("id") % 3 + 201901).cast("string").alias("ingest_month"))
    schema = T.StructType().add("id", "long")
    write_partitioned(months, path, ["ingest_month"])
    one = read_months(spark, path, schema, "201902")
    assert one.count() == 10 and "PartitionFilters: [isnotnull(ingest_month" in plan_of(one)
    replace_partitions(months.where("ingest_month = '201902' and id < 5"), path, ["ingest_month"])
    assert read_months(spark, path, schema, "201902").count() == 2
    assert read_months(spark, path, schema, "201901", "201903").count() == 22


def test_sorted_layout_lets_range_filters_reach_the_files(spark, tmp_path, plan_of):
    path = str(tmp_path / "sorted")
    frame = spark.range(100).select("id", (F.col("id") % 2).alias("p"))
    write_partitioned(frame, path, ["p"], ["id"])
    some = spark.read.parquet(path).where("p = 1 and id > 90")
    assert some.count() == 5
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,90)]" in plan_of(some)


def archive(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as target:
        for name, text in members.items():
            target.writestr(name + ".csv", text)


def test_zip_members(spark, tmp_path):
    archive(tmp_path / "1.zip", wanted='a,b\r\n1,"x, y"\r\n2,\r\n', other="a,b\n8,no\n")
    archive(tmp_path / "2.zip", wanted="\ufeffa,b\n3,z\n\n", other="a,b\n")
    path = str(tmp_path)
    frame = member_rows(spark, path, ["wanted.csv"], PAIR).drop("path", "member")
    assert rows(frame) == [(1, "x, y"), (2, None), (3, "z")]
    assert member_rows(spark, path, ["wanted.csv", "other.csv"], PAIR).count() == 4
    assert member_rows(spark, path, None, PAIR).count() == 4


def test_zip_batches_and_quoted_line_breaks(spark, tmp_path):
    body = "".join(f'{i},"line\nbreak {i}"\n' for i in range(25))
    archive(tmp_path / "1.zip", wanted="a,b\n" + body)
    path = str(tmp_path)
    lines = member_lines(spark, path, ["wanted.csv"], multi_line=True, batch_lines=4)
    assert [r.line_no for r in lines.orderBy("line_no").collect()] == list(range(26))
    assert member_lines(spark, path, ["wanted.csv"]).count() == 51
    parsed = member_rows(spark, path, ["wanted.csv"], PAIR, multi_line=True)
    assert parsed.where(F.col("b") == F.concat(F.lit("line\nbreak "), F.col("a").cast("string"))).count() == 25


def test_missing_zip_member_fails(spark, tmp_path):
    archive(tmp_path / "1.zip", other="a\n")
    with pytest.raises(Exception, match="wanted.csv"):
        member_lines(spark, str(tmp_path), ["wanted.csv"]).collect()


def test_large_members_are_tasks_of_their_own_and_small_ones_share(tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "TASK_BYTES", 100)
    with zipfile.ZipFile(tmp_path / "1.zip", "w") as target:  # stored, so sizes are known
        for name, size in (("a", 300), ("b", 40), ("c", 40), ("d", 400)):
            target.writestr(name, "x" * size)
    uri = (tmp_path / "1.zip").as_uri()
    options = {"archives": json.dumps([uri]), "members": "null", "multi_line": "false", "batch_lines": "9"}
    tasks = [[name for _, name in task.listed] for task in archives.ZipMemberReader(options).partitions()]
    assert tasks == [["a"], ["b", "c"], ["d"]]


class Tail(io.RawIOBase):
    """A file of which only the last bytes are held; before them stand zeros."""

    def __init__(self, before: int, tail: bytes):
        self.before, self.tail, self.at, self.given = before, tail, 0, 0

    def seekable(self):
        return True

    def readable(self):
        return True

    def tell(self):
        return self.at

    def seek(self, offset, whence=0):
        self.at = offset + {0: 0, 1: self.at, 2: self.before + len(self.tail)}[whence]
        return self.at

    def readinto(self, buffer):
        assert self.at >= self.before, "read outside the ranges of the member"
        given = self.tail[self.at - self.before : self.at - self.before + len(buffer)]
        buffer[: len(given)] = given
        self.at += len(given)
        self.given += len(given)
        return len(given)


def test_a_member_behind_three_gigabytes_is_read_by_its_range(tmp_path, monkeypatch):
    before = 3 * 2**30
    archive(tmp_path / "1.zip", wanted="a,b\n1,x\n")
    monkeypatch.setattr(archives, "_open", lambda uri: Tail(before, (tmp_path / "1.zip").read_bytes()))
    options = {"archives": '["big.zip"]', "members": "null", "multi_line": "false", "batch_lines": "9"}
    reader = archives.ZipMemberReader(options)
    (task,) = reader.partitions()
    (batch,) = reader.read(task)
    assert batch.column("line").to_pylist() == ["a,b", "1,x"]


def test_the_zip_query_scans_archives_in_the_shared_folder(spark, plan_of):
    from driver_queries.storage import zip_member_rows

    found = zip_member_rows(spark, "/root/testdata/sf0.001")
    assert "zip_members" in plan_of(found)
    assert found.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
