"""Whole paths: objects in by pattern and share, properties to arguments."""

import pytest
from pyspark.sql import functions as F

from sluice.settings import sink_arguments, source_arguments
from sluice.sources.connector import read_new_records, read_records
from test_sources import put

PATTERN = "{{topic}}-{{partition}}-{{start_offset}}"


@pytest.fixture
def root(tmp_path):
    for p in range(12):
        put(str(tmp_path), f"in/t-{p}-{p * 10}.txt", f"data {p}")
    put(str(tmp_path), "in/unnamed.txt", "x")
    put(str(tmp_path), "in/t-99999999999-1.txt", "y")
    return str(tmp_path)


def test_records_carry_name_and_key(spark, root):
    row = read_records(spark, root, PATTERN).filter("partition = 3").first()
    assert (row["topic"], row["partition"], row["start_offset"]) == ("t", 3, 30)
    assert bytes(row["key"]) == b"in/t-3-30.txt" and bytes(row["value"]) == b"data 3"
    assert read_records(spark, root, PATTERN, target_topic="z").select("topic").distinct().first()[0] == "z"


@pytest.mark.parametrize("distribution, total", [("object_hash", 13), ("partition", 12)])
def test_tasks_share_the_objects(spark, root, distribution, total):
    shares = [
        {r["object_key"] for r in read_records(spark, root, PATTERN, tasks=4, task=t, distribution=distribution).collect()}
        for t in range(4)
    ]
    assert len(set().union(*shares)) == sum(map(len, shares)) == total
    whole = read_records(spark, root, PATTERN, distribution=distribution)
    assert {r["object_key"] for r in whole.collect()} == set().union(*shares)


def test_prefix_and_start_key(spark, root):
    read = read_records(spark, root, PATTERN, prefix="in/t-1", after="in/t-1-10.txt")
    assert sorted(r["partition"] for r in read.collect()) == [10, 11]


def test_parquet_rows_are_a_struct(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/t-1-0")
    rows = read_records(spark, str(tmp_path), PATTERN, "parquet").select("partition", "value.id").collect()
    assert sorted(map(tuple, rows)) == [(1, 0), (1, 1), (1, 2)]


def test_sink_properties():
    assert sink_arguments({}) == {
        "template": "{{topic}}-{{partition}}-{{start_offset}}",
        "prefix": "", "max_records": 0, "compression": "none", "tz": "UTC", "ts_source": "wallclock",
        "fmt": "csv", "fields": ["value"], "value_encoding": "base64", "envelope": True,
    }
    found = sink_arguments(
        {
            "format.output.type": "JSONL",
            "format.output.fields": "key, value,offset",
            "file.compression.type": "gzip",
            "file.max.records": "10",
            "connector.class": "ignored",
        }
    )
    assert found["template"].endswith("{{start_offset}}.gz")
    assert (found["fmt"], found["fields"], found["max_records"]) == ("jsonl", ["key", "value", "offset"], 10)


@pytest.mark.parametrize(
    "properties",
    [
        {"file.name.template": "{{key}}", "file.max.records": "2"},
        {"file.name.template": "{{topic}}"},
        {"format.output.fields": "nope"},
        {"format.output.fields": "key,value", "format.output.envelope": "false"},
        {"format.output.envelope": "maybe"},
    ],
)
def test_bad_sink_properties(properties):
    with pytest.raises(ValueError):
        sink_arguments(properties)


def test_source_properties():
    found = source_arguments({"file.name.template": PATTERN, "azure.blob.prefix": "p/", "tasks.max": "3"})
    assert (found["pattern"], found["prefix"], found["tasks"], found["fmt"]) == (PATTERN, "p/", 3, "bytes")
    assert found["target_topic"] is None and found["after"] is None
    with pytest.raises(ValueError):
        source_arguments({})


def test_properties_drive_the_reader_and_the_writer(spark, root, tmp_path_factory):
    from sluice.streaming.sink import flush_batch

    out = str(tmp_path_factory.mktemp("out"))
    rows = spark.range(10).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.lit(0).cast("bigint").alias("timestamp_ms"), F.lit("k").alias("key"),
        F.col("id").cast("string").alias("value"),
    )
    sink = sink_arguments({"file.max.records": "4", "file.compression.type": "zstd"})
    flush_batch(rows, 0, out, **sink).count()
    source = source_arguments(
        {"file.name.template": PATTERN, "input.format": "bytes", "file.compression.type": "zstd"}
    )
    read = {r["start_offset"]: bytes(r["value"]) for r in read_records(spark, out, **source).collect()}
    assert read == {0: b"MA==\nMQ==\nMg==\nMw==", 4: b"NA==\nNQ==\nNg==\nNw==", 8: b"OA==\nOQ=="}


@pytest.mark.parametrize("fmt", ["jsonl", "bytes", "parquet"])
def test_progress_is_kept_between_runs(spark, tmp_path, fmt):
    root, state = f"{tmp_path}/in", f"{tmp_path}/state"

    def grow(name, n):
        if fmt == "parquet":
            spark.range(n).coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/made")
            part = next(p for p in (tmp_path / "made").iterdir() if p.suffix == ".parquet")
            put(root, name, part.read_bytes())
        else:
            put(root, name, "".join(f"{i:03d}\n" if fmt == "bytes" else f"{i}\n" for i in range(n)))

    def run(late=None, commit=True):
        how = {"chunk_size": 4} if fmt == "bytes" else {}
        records, done = read_new_records(spark, root, "{{topic}}-{{partition}}", fmt, state=state, **how)
        if late:
            grow(*late)
        found = sorted((r["partition"], str(r["value"])) for r in records.collect())
        if commit:
            done()
        return [sum(p == n for p, _ in found) for n in (1, 2, 3)]

    grow("t-1", 5)
    assert run(commit=False) == [5, 0, 0]
    assert run() == [5, 0, 0]  # not stored before
    assert run() == [0, 0, 0]
    grow("t-1", 8)
    grow("_t-2", 3)
    assert run(late=("t-3", 4)) == [3, 3, 0]  # what comes during a run waits
    assert run() == [0, 0, 4]


def test_parquet_properties(spark, tmp_path):
    import pyarrow.parquet as pq

    from sluice.operators.grouping import group_records
    from sluice.sinks.files import write_files

    found = sink_arguments(
        {"format.output.type": "parquet", "connect.parquet.block.size": "4000", "connect.parquet.enable.dictionary": "false",
         "connect.parquet.avro.schema": "{}", "connect.parquet.writer.version": "V2"}
    )
    assert found["options"] == {"row_group_bytes": 4000, "use_dictionary": False, "data_page_version": "2.0"}
    rows = spark.range(2000).coalesce(1).selectExpr("'t' topic", "0 partition", "id as offset", "0L timestamp_ms", "'k' key", "'v' value")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        write_files(group_records(rows, PATTERN), str(tmp_path), "parquet", fields=["offset"], options=found["options"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    written = pq.ParquetFile(f"{tmp_path}/t-0-0")
    assert written.num_row_groups == 4 and "PLAIN_DICTIONARY" not in written.metadata.row_group(0).column(0).encodings
    assert "options" not in sink_arguments({"format.output.type": "csv"})
