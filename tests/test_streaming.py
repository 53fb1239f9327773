"""Streams: flushes, restarts, rate caps."""

import json
import os
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from sluice.sinks.codecs import encode
from sluice.sources.objects import read_lines, read_objects
from sluice.sources.records import log_records
from sluice.streaming.sink import record_stream, write_stream
from sluice.streaming.objects import ObjectReader
from sluice.streaming.source import drain, drop_processed_stream, publish_stream, read_growing, read_stream
from test_sinks import contents

CHANGELOG = "{{topic}}-{{partition}}-{{start_offset}}"
SCHEMA = "topic string, partition int, offset bigint, timestamp_ms bigint, key string, value string"


def feed(spark, folder, name, offsets, key="k"):
    rows = [("t", o % 2, o, o, f"{key}{o % 3}", f"v{o}") for o in offsets]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, tmp_path, template=CHANGELOG, **how):
    records = (
        spark.readStream.schema(SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{tmp_path}/in")
    )
    flushes = []
    query = write_stream(
        records, f"{tmp_path}/out", template, f"{tmp_path}/cp", fields=["value"],
        value_encoding="none", available_now=True,
        on_flush=lambda m, i: flushes.append((i, m.agg(F.sum("n_records")).first()[0])), **how,
    )
    query.awaitTermination()
    return flushes


def test_one_batch_is_one_flush_and_restarts_go_on(spark, tmp_path):
    feed(spark, f"{tmp_path}/in", "a", range(0, 10))
    assert run(spark, tmp_path) == [(0, 10)]
    assert run(spark, tmp_path) == []
    feed(spark, f"{tmp_path}/in", "b", range(10, 16))
    assert run(spark, tmp_path) == [(1, 6)]
    assert not os.path.exists(f"{tmp_path}/out/_staging")
    # State ends with the flush: the second one opens files of its own.
    assert contents(f"{tmp_path}/out") == {
        "t-0-0": b"v0\nv2\nv4\nv6\nv8",
        "t-1-1": b"v1\nv3\nv5\nv7\nv9",
        "t-0-10": b"v10\nv12\nv14",
        "t-1-11": b"v11\nv13\nv15",
    }


def test_limited_stream(spark, tmp_path):
    feed(spark, f"{tmp_path}/in", "a", range(0, 7))
    run(spark, tmp_path, template=None, max_records=2, persist=True)
    assert set(contents(f"{tmp_path}/out")) == {"t-0-0", "t-0-4", "t-1-1", "t-1-5"}


def test_keyed_stream_overwrites(spark, tmp_path):
    feed(spark, f"{tmp_path}/in", "a", range(0, 6))
    run(spark, tmp_path, template="{{key}}")
    assert contents(f"{tmp_path}/out") == {"k0": b"v3", "k1": b"v4", "k2": b"v5"}
    feed(spark, f"{tmp_path}/in", "b", [9])
    run(spark, tmp_path, template="{{key}}")
    assert contents(f"{tmp_path}/out") == {"k0": b"v9", "k1": b"v4", "k2": b"v5"}


def test_replayed_flush_puts_the_same_objects(spark, tmp_path):
    """The checkpoint forgets the last commit, as after a crash before it."""
    feed(spark, f"{tmp_path}/in", "a", range(0, 10))
    run(spark, tmp_path, max_records=3)
    before = contents(f"{tmp_path}/out")
    for name in os.listdir(f"{tmp_path}/cp/commits"):
        os.remove(f"{tmp_path}/cp/commits/{name}")
    assert run(spark, tmp_path, max_records=3) == [(0, 10)]
    assert contents(f"{tmp_path}/out") == before


def test_a_flush_replayed_later_has_the_same_wallclock_names(spark, tmp_path):
    """The time of a flush is in the checkpoint: made to be two days ago, a replay takes that."""
    template = CHANGELOG + "-{{timestamp:unit=dd}}"
    feed(spark, f"{tmp_path}/in", "a", range(0, 4))
    run(spark, tmp_path, template=template)
    before = set(contents(f"{tmp_path}/out"))
    offsets = f"{tmp_path}/cp/offsets/0"
    version, meta, *rest = open(offsets).read().split("\n")
    told = json.loads(meta)
    told["batchTimestampMs"] -= 2 * 24 * 3600 * 1000
    open(offsets, "w").write("\n".join([version, json.dumps(told), *rest]))
    for name in os.listdir(f"{tmp_path}/cp/offsets"):
        if name.endswith(".crc"):
            os.remove(f"{tmp_path}/cp/offsets/{name}")
    for name in os.listdir(f"{tmp_path}/cp/commits"):
        os.remove(f"{tmp_path}/cp/commits/{name}")
    run(spark, tmp_path, template=template)
    day = datetime.fromtimestamp(told["batchTimestampMs"] / 1000, UTC).strftime("%d")
    assert set(contents(f"{tmp_path}/out")) - before == {f"t-0-0-{day}", f"t-1-1-{day}"}


def test_a_log_as_parquet(spark, tmp_path):
    """Rows as a log gives them have one schema, and columnar files of them are not cut."""
    feed(spark, f"{tmp_path}/in", "a", range(0, 9))
    log = record_stream(spark, f"{tmp_path}/in", SCHEMA).selectExpr(
        "cast(key as binary) as key", "cast(value as binary) as value", "topic", "partition", "offset",
        "timestamp_millis(timestamp_ms) as timestamp",
    )
    write_stream(
        log_records(log), f"{tmp_path}/out", CHANGELOG, f"{tmp_path}/cp", fmt="parquet",
        fields=["key", "value", "offset"], available_now=True,
    ).awaitTermination()
    read = read_objects(spark, f"{tmp_path}/out", "parquet")
    assert sorted((r["object_key"], r["offset"], bytes(r["value"])) for r in read.collect()) == sorted(
        (f"t-{o % 2}-{o % 2}", o, f"v{o}".encode()) for o in range(9)
    )


def test_a_failing_flush_is_not_committed(spark, tmp_path):
    feed(spark, f"{tmp_path}/in", "a", range(0, 4))
    blocked = tmp_path / "out"
    blocked.write_text("a file where the folder should be")
    try:
        run(spark, tmp_path)
        raise AssertionError("the flush should fail")
    except Exception as e:
        assert "should fail" not in str(e)
    blocked.rename(tmp_path / "moved")
    assert run(spark, tmp_path) == [(0, 4)]
    assert read_lines(spark, f"{tmp_path}/out").count() == 4


def test_flushes_are_capped_by_bytes(spark, tmp_path):
    for i in range(4):
        feed(spark, f"{tmp_path}/in", str(i), range(10 * i, 10 * i + 10))
    flushes = []
    write_stream(
        record_stream(spark, f"{tmp_path}/in", SCHEMA, bytes_per_flush=1),
        f"{tmp_path}/out",
        CHANGELOG,
        f"{tmp_path}/cp",
        available_now=True,
        on_flush=lambda m, i: flushes.append(m.agg(F.sum("n_records")).first()[0]),
    ).awaitTermination()
    assert flushes == [10, 10, 10, 10]


def put(root, name, data):
    os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
    with open(f"{root}/{name}", "wb") as out:
        out.write(data)


def publish(spark, tmp_path, fmt, **how):
    records = read_stream(spark, f"{tmp_path}/objects", fmt, state=f"{tmp_path}/state", **how)
    query = publish_stream(records, f"{tmp_path}/cp", path=f"{tmp_path}/table", available_now=True)
    query.awaitTermination()
    return query, spark.read.parquet(f"{tmp_path}/table")


def test_new_objects_are_picked_up_once(spark, tmp_path):
    how = {"pattern": "{{topic}}-{{partition}}-{{start_offset}}.jsonl", "objects_per_batch": 2}
    for i in range(5):
        put(f"{tmp_path}/objects", f"t-{i}-0.jsonl", b'{"a":1}\n\n bad \n{"a":2}\n')
    put(f"{tmp_path}/objects", "unnamed.jsonl", b'{"a":1}\n')
    runs = drain(lambda: publish(spark, tmp_path, "jsonl", **how)[0])
    assert runs == 3 and spark.read.parquet(f"{tmp_path}/table").count() == 10
    put(f"{tmp_path}/objects", "later/t-9-4.jsonl", b'{"a":3}\n')
    table = publish(spark, tmp_path, "jsonl", **how)[1]
    rows = sorted((r["topic"], r["partition"], r["start_offset"]) for r in table.collect())
    assert len(rows) == 11 and rows[-1] == ("t", 9, 4)


def test_bytes_stream(spark, tmp_path):
    put(f"{tmp_path}/objects", "t-1", b"abcdefg")
    put(f"{tmp_path}/objects", "empty-2", b"")
    table = publish(spark, tmp_path, "bytes", chunk_size=4, pattern="{{topic}}-{{partition}}", target_topic="z")[1]
    assert sorted((r["topic"], r["partition"], bytes(r["value"])) for r in table.collect()) == [
        ("z", 1, b"abcd"), ("z", 1, b"efg"),
    ]


@pytest.mark.parametrize("compression", ["gzip", "zstd", "snappy"])
def test_compressed_stream(spark, tmp_path, compression):
    put(f"{tmp_path}/objects", "t-1", encode(b'{"a":1}\n\nbad\n{"a":2}', compression))
    table = publish(spark, tmp_path, "jsonl", compression=compression, pattern="{{topic}}-{{partition}}")[1]
    assert sorted(r["value"] for r in table.collect()) == ['{"a":1}', '{"a":2}']


def test_parquet_stream(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/objects/t-1")
    table = publish(spark, tmp_path, "parquet", schema="id bigint", pattern="{{topic}}-{{partition}}/")[1]
    assert sorted(r["value"]["id"] for r in table.collect()) == list(range(10))


def test_a_stream_takes_its_share(spark, tmp_path):
    for i in range(6):
        put(f"{tmp_path}/objects", f"in/t-{i}", b"x")
    put(f"{tmp_path}/objects", "other/t-1", b"x")
    how = {"pattern": "{{topic}}-{{partition}}", "prefix": "in/", "after": "in/t-0", "tasks": 2, "task": 1, "distribution": "partition"}
    table = publish(spark, tmp_path, "bytes", **how)[1]
    assert sorted(r["object_key"] for r in table.collect()) == ["in/t-1", "in/t-3", "in/t-5"]


NAMES = ["_schemas-0-0", "plain-0-0", ".dot-1-0", "in/_x-2-0", "_a=b-3-0", "x._COPYING_", "_staging/t-4-0", "a b%20+-5-0"]


@pytest.mark.parametrize("fmt", ["bytes", "jsonl", "parquet"])
def test_names_of_any_kind_are_published_once(spark, tmp_path, fmt):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for name in NAMES:
        put(f"{tmp_path}/objects", name, b'{"v":1}')
        if fmt == "parquet":
            pq.write_table(pa.table({"v": [1, 2]}), f"{tmp_path}/objects/{name}")
    how = {"schema": "v bigint, w string"} if fmt == "parquet" else {}
    publish(spark, tmp_path, fmt, **how)
    rows = publish(spark, tmp_path, fmt, **how)[1].collect()  # a second run finds nothing new
    assert sorted(r.object_key for r in rows) == sorted(NAMES * (2 if fmt == "parquet" else 1))
    if fmt == "parquet":
        assert {(r.value.v, r.value.w) for r in rows} == {(1, None), (2, None)}


def reader(tmp_path, **how):
    options = dict.fromkeys(["objects", "bytes", "after", "glob", "forget"]) | {"prefix": ""} | how
    return ObjectReader(root=f"file://{tmp_path}/objects", state=f"file://{tmp_path}/state", **options)


def taken(r, start, end):
    return [k for p in r.partitions({"batch": start}, {"batch": end}) for b in r.read(p) for k in b.column(0).to_pylist()]


def test_batches_are_the_same_when_run_again_and_after_a_restart(tmp_path):
    for i in range(7):
        put(f"{tmp_path}/objects", f"t-{i}", b"x" * (i + 1))
    first = reader(tmp_path, objects=3)
    assert [first.latestOffset()["batch"] for _ in range(4)] == [1, 2, 3, 3]
    put(f"{tmp_path}/objects", "a-late", b"x")
    os.utime(f"{tmp_path}/objects/a-late", (1, 1))  # renamed into place: older than all that was seen
    again = reader(tmp_path, objects=3)  # batch 3 was logged and may not have run: its objects stay in it
    assert again.latestOffset() == {"batch": 4}
    assert taken(again, 0, 3) == taken(first, 0, 3) == [f"t-{i}" for i in range(7)]
    assert taken(again, 3, 4) == ["a-late"] and taken(again, 4, 4) == []


def test_a_batch_without_its_marker_does_not_count(tmp_path):
    put(f"{tmp_path}/objects", "t-1", b"x")
    put(f"{tmp_path}/state/log/000000000001", "000000", b'["lost", 1, 1]\n')
    r = reader(tmp_path)
    assert r.latestOffset() == {"batch": 1} and taken(r, 0, 1) == ["t-1"]


def test_caps_prefix_start_and_glob(tmp_path):
    for name in ["a/1.x", "a/2.x", "a/3.y", "b/1.x", "b/2.x", "c"]:
        put(f"{tmp_path}/objects", name, b"12345")
    r = reader(tmp_path, bytes=12)
    assert r.latestOffset() == {"batch": 1} and taken(r, 0, 1) == ["a/1.x", "a/2.x"]
    other = ObjectReader(f"file://{tmp_path}/objects", f"file://{tmp_path}/s2", 1, None, "", "a/3", "?.x", None)
    assert [other.latestOffset()["batch"] for _ in range(3)] == [1, 2, 2]
    assert taken(other, 0, 2) == ["b/1.x", "b/2.x"]
    third = ObjectReader(f"file://{tmp_path}/objects", f"file://{tmp_path}/s3", None, None, "b/", None, None, None)
    assert sorted(taken(third, 0, third.latestOffset()["batch"])) == ["b/1.x", "b/2.x"]


def test_the_log_is_written_together_and_old_keys_are_forgotten(tmp_path, monkeypatch):
    from sluice.streaming import objects

    monkeypatch.setattr(objects, "COMPACT", 3)
    r = reader(tmp_path, forget=100)
    for i in range(8):
        put(f"{tmp_path}/objects", f"t-{i}", b"x")
        os.utime(f"{tmp_path}/objects/t-{i}", (1000 + 60 * i, 1000 + 60 * i))
        assert r.latestOffset() == {"batch": i + 1}
    assert len(r.seen) == 2  # those of the last 100 seconds
    names = sorted(os.listdir(f"{tmp_path}/state/log"))
    assert "000000000001" not in names and "seen-000000000006" in names and "seen-000000000003" not in names
    again = reader(tmp_path, forget=100)
    put(f"{tmp_path}/objects", "t-8", b"x")
    assert again.latestOffset() == {"batch": 9} and taken(again, 8, 9) == ["t-8"]


def test_processed_keys_are_kept_for_a_time(spark, tmp_path):
    def told(name, rows):
        spark.createDataFrame(rows, "object_key string, at long").coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    def run():
        notices = spark.readStream.schema("object_key string, at long").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        notices = notices.withColumn("modified", F.timestamp_seconds("at"))
        new = drop_processed_stream(notices, forget_after="100 seconds")
        query = new.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp")
        query = query.trigger(availableNow=True).start()
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    told("a", [(f"k{i}", 1000 + i) for i in range(50)] * 2)
    run()
    told("b", [(f"k{i}", 1000 + i) for i in range(50)] + [("new", 1060)])  # all told of again
    run()
    told("c", [("k1", 1001), ("later", 5000)])
    run()
    told("d", [("k1", 1001), ("later", 5000), ("last", 5001)])  # k1 is forgotten, and too old to be new
    assert run() <= 3
    keys = [r.object_key for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(keys) == sorted([f"k{i}" for i in range(50)] + ["new", "later", "last"])


def test_objects_that_grow_are_read_on(spark, tmp_path):
    def run():
        records = read_growing(spark, f"{tmp_path}/objects", state=f"{tmp_path}/state")
        publish_stream(records, f"{tmp_path}/cp", path=f"{tmp_path}/table", available_now=True).awaitTermination()
        return sorted((r.object_key, r.value) for r in spark.read.parquet(f"{tmp_path}/table").collect())

    put(f"{tmp_path}/objects", "a", b'{"n":1}\n\n{"n":2}\n{"n":')  # the last line is not whole yet
    put(f"{tmp_path}/objects", "_b", b'{"n":1}')  # whole without a newline
    first = [("_b", '{"n":1}'), ("a", '{"n":1}'), ("a", '{"n":2}')]
    assert run() == first and run() == first
    put(f"{tmp_path}/objects", "a", b'{"n":1}\n\n{"n":2}\n{"n":3}\nbad\n{"n":4}\n')
    put(f"{tmp_path}/objects", "_b", b'{"n":1}\n{"n":2}\n')
    put(f"{tmp_path}/objects", "c", b'{"n":9}\n')
    second = sorted([*first, ("a", '{"n":3}'), ("a", '{"n":4}'), ("_b", '{"n":2}'), ("c", '{"n":9}')])
    assert run() == second
    put(f"{tmp_path}/objects", "c", b"{}")  # shorter than before
    assert run() == second
