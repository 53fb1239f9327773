"""Listing: every object once, whatever its name; large flat folders in ranges."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.sinks.files import write_files
from sluice.sources import listing
from sluice.sources.connector import read_new_records
from sluice.sources.objects import read_objects

ODD = [
    "plain", "_a=b", "_a", "_metadata", "_metadatax", "_metadata.d/x", "_common_metadata", "x._COPYING_", "_x=._COPYING_",
    "d._COPYING_/x", "_staging/0", "_staging/" + "a" * 31, ".a.crc", "a", ".hidden", "in/_b", "_c/d", "_c=1/d", ".e/f",
    "k=v/_SUCCESS", "a b%20+", "we[i]rd*{x}",
]


def grouped(spark, names):
    rows = [(name, n, f"v{name}{n}") for name in names for n in range(3)]
    df = spark.createDataFrame(rows, "file_name string, offset long, value string")
    return df.withColumns({"topic": F.lit("t"), "partition": F.lit(0), "key": F.lit("k"), "timestamp_ms": F.lit(0)})


@pytest.mark.parametrize("fmt", ["parquet", "jsonl", "bytes"])
def test_every_name_is_read_once(spark, tmp_path, fmt):
    root = f"{tmp_path}/o"
    write_files(grouped(spark, ODD), root, "csv" if fmt == "bytes" else fmt, fields=["value"], value_encoding="none").count()
    names = {r.object_key for r in listing.list_files(spark, root).collect()}
    assert names == set(ODD)
    for listed in (None, listing.list_files(spark, root)):
        read = read_objects(spark, root, fmt, listing=listed)
        times = {r.object_key: r["count"] for r in read.groupBy("object_key").count().collect()}
        assert times == {name: 1 if fmt == "bytes" else 3 for name in ODD}


def test_checksums_and_attempts_of_writers_are_no_objects(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    assert any(n.endswith(".crc") for n in os.listdir(f"{tmp_path}/t"))
    attempt = tmp_path / "t" / "_staging" / ("0123456789abcdef" * 2)
    attempt.mkdir(parents=True)
    (attempt / "piece").write_bytes(b"x")
    names = {r.object_key for r in listing.list_files(spark, f"{tmp_path}/t").collect()}
    assert names and not [n for n in names if n.endswith(".crc") or "_staging" in n]


def test_a_flat_folder_is_listed_by_several_tasks(spark, tmp_path):
    n = 200_000
    for i in range(n):
        os.close(os.open(f"{tmp_path}/{i * 7919 % 1_000_003:07d}{'-long' * (i % 5)}", os.O_CREAT | os.O_WRONLY))
    found = listing.walk(spark, str(tmp_path)).persist()
    assert {r.path.rsplit("/", 1)[1] for r in found.select("path").toLocalIterator()} == set(os.listdir(tmp_path))
    per_task = [r["count"] for r in found.groupBy("task").count().collect()]
    assert found.count() == n and len(per_task) > 3 and max(per_task) < n / 2
    found.unpersist()


def test_ranges_cover_all_names_once():
    names = [f"{i % 97}x{i}" for i in range(5000)]
    for most in (1, 10, 700, 4999, 5000):
        parts = listing._ranges(iter(names), None, None, most)
        assert all(sum(listing._in_range(n, *p) for p in parts) == 1 for n in names)
        assert (len(parts) > 1) == (most < 5000)
    inner = listing._ranges((n for n in names if listing._in_range(n, "2", "5")), "2", "5", 100)
    assert inner[0][0] == "2" and inner[-1][1] == "5"
    assert listing._ranges(iter([]), None, None, 5) == [(None, None)]


def test_new_parquet_records_are_read_by_spark(spark, tmp_path):
    root = f"{tmp_path}/o"
    write_files(grouped(spark, ["t-0-0", "t-0-3"]), root, "parquet", fields=["value"]).count()
    records, commit = read_new_records(
        spark, root, "{{topic}}-{{partition}}-{{start_offset}}", "parquet", state=f"{tmp_path}/state"
    )
    plan = records.select("value.value")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "Scan parquet" in line)
    assert "ReadSchema: struct<value:string" in scan, scan
    assert records.count() == 6
    commit()
    write_files(grouped(spark, ["t-0-6"]), root, "parquet", fields=["value"]).count()
    again, _ = read_new_records(
        spark, root, "{{topic}}-{{partition}}-{{start_offset}}", "parquet", state=f"{tmp_path}/state"
    )
    assert {r.object_key for r in again.collect()} == {"t-0-6"}
