"""Reading objects from files: listing, splitting, compression, progress."""

import gzip
import io
import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.functions.naming import match_source_name
from sluice.operators.grouping import group_records
from sluice.sinks.codecs import encode
from sluice.sources import objects as obj
from sluice.sources import progress as prog
from sluice.sources.records import conversation_records, log_records, read_log
from sluice.sources.streams import decompressed


def put(root, name, data):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(data if isinstance(data, bytes) else data.encode())


def values(df):
    out = {}
    order = [c for c in ("record_no",) if c in df.columns]
    for r in df.collect():
        out.setdefault(r["object_key"], []).append((*[r[c] for c in order], r["value"]))
    return {k: [v[-1] for v in (sorted(vs) if order else vs)] for k, vs in out.items()}


def test_listing(spark, tmp_path):
    root = str(tmp_path)
    for name in ("a/1.txt", "a/2 +ü%41.txt", "a/10.txt", "b/1.txt", "empty.txt"):
        put(root, name, b"" if name.startswith("empty") else b"x")
    keys = [r["object_key"] for r in obj.list_objects(spark, root).collect()]
    assert keys == ["a/1.txt", "a/10.txt", "a/2 +ü%41.txt", "b/1.txt"]
    keys = [r["object_key"] for r in obj.list_objects(spark, f"file://{root}/", prefix="a/", after="a/1.txt").collect()]
    assert keys == ["a/10.txt", "a/2 +ü%41.txt"]
    text = obj.read_lines(spark, root).select("object_key").distinct()
    assert {r[0] for r in text.collect()} == {"a/1.txt", "a/10.txt", "a/2 +ü%41.txt", "b/1.txt"}


@pytest.mark.parametrize(
    "root, path, key",
    [
        ("s3://b/p", "s3a://b/p/a/b.txt", "a/b.txt"),
        ("s3a://p/p/", "s3a://p/p/x", "x"),
        ("gs://b", "gs://b/x/y", "x/y"),
        ("/tmp/x", "file:/tmp/x/y", "y"),
        ("file:///tmp/x/", "file:///tmp/x/tmp/x/y", "tmp/x/y"),
        ("/", "file:/a/b", "a/b"),
        ("/tmp/x", "file:/tmp/xy/z", "file:/tmp/xy/z"),
    ],
)
def test_object_keys(spark, root, path, key):
    df = spark.range(1).select(F.lit(path).alias("p"))
    assert df.select(obj.object_key_of(F.col("p"), root)).first()[0] == key


@pytest.mark.parametrize("size, second", [(4096, 1904), (3000, 3000), (4101, 1899)])
def test_bytes(spark, tmp_path, size, second):
    data = bytes(i % 256 for i in range(6000))
    put(str(tmp_path), "six.bin", data)
    put(str(tmp_path), "none.bin", b"")
    chunks = values(obj.read_objects(spark, str(tmp_path), "bytes", chunk_size=size))
    assert list(chunks) == ["six.bin"]
    assert [len(c) for c in chunks["six.bin"]] == [size, second]
    assert b"".join(bytes(c) for c in chunks["six.bin"]) == data


def test_bytes_of_a_table(spark):
    df = spark.createDataFrame([("a", b"abcdefg"), ("b", b""), ("c", b"abcd")], "object_key string, content binary")
    assert {k: [bytes(v) for v in vs] for k, vs in values(obj.bytes_chunks(df, 4)).items()} == {
        "a": [b"abcd", b"efg"], "c": [b"abcd"],
    }


def test_large_object_is_read_in_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sluice.sources.streams.RANGE_BYTES", 1000)
    data = os.urandom(25_001)
    put(str(tmp_path), "big", data)
    read = obj.read_objects(spark, str(tmp_path), "bytes", chunk_size=100)
    assert b"".join(bytes(c) for c in values(read)["big"]) == data
    progress = spark.createDataFrame([("big", 37)], "object_key string, record_count bigint")
    rest = obj.read_objects(spark, str(tmp_path), "bytes", chunk_size=100, progress=progress)
    assert rest.agg(F.min("record_no"), F.max("record_no"), F.count("*")).first()[:] == (38, 251, 214)
    assert b"".join(bytes(c) for c in values(rest)["big"]) == data[3700:]
    done = spark.createDataFrame([("big", 251)], "object_key string, record_count bigint")
    assert obj.read_objects(spark, str(tmp_path), "bytes", chunk_size=100, progress=done).count() == 0


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr("sluice.sources.streams.RANGE_BYTES", 2000)


def jsonl(n, bad=()):
    lines = []
    for i in range(n):
        lines.append(f'  {{"id": {i}}}\t' if i not in bad else "invalid-json")
        if i % 5 == 0:
            lines.append("   ")
    return "\n".join(lines)


def test_jsonl_across_ranges(spark, tmp_path, small_ranges):
    put(str(tmp_path), "good.jsonl", jsonl(1000))
    put(str(tmp_path), "bad.jsonl", jsonl(1000, bad=(613, 700)))
    put(str(tmp_path), "first.jsonl", jsonl(10, bad=(0,)))
    put(str(tmp_path), "blank.jsonl", "\n \n\t\n")
    lines = obj.read_lines(spark, str(tmp_path))
    assert lines.select("object_key", "block").distinct().count() > 8

    def ids(df):
        return {k: sorted(json.loads(v)["id"] for v in vs) for k, vs in values(df).items()}

    cut = obj.read_objects(spark, str(tmp_path), "jsonl", on_error="truncate")
    assert ids(cut) == {"good.jsonl": list(range(1000)), "bad.jsonl": list(range(613))}
    dropped = obj.read_objects(spark, str(tmp_path), "jsonl")
    assert ids(dropped)["bad.jsonl"] == [i for i in range(1000) if i not in (613, 700)]
    assert ids(dropped)["first.jsonl"] == list(range(1, 10))
    with pytest.raises(PySparkException, match="not JSON"):
        obj.read_objects(spark, str(tmp_path), "jsonl", on_error="fail").collect()
    assert obj.rejects(lines).count() == 3

    progress = spark.createDataFrame([("good.jsonl", 777), ("bad.jsonl", 700)], "object_key string, record_count bigint")
    rest = obj.read_objects(spark, str(tmp_path), "jsonl", on_error="truncate", progress=progress)
    assert ids(rest) == {"good.jsonl": list(range(777, 1000))}


def test_blank_and_trimmed_lines(spark):
    """Blank as Character.isWhitespace sees it, trimmed up to the space character."""
    lines = ["", " ", "\t\x0b\x0c\x1c\x1f ", "\u2003\u3000", "\u2003 x", "\u00a0", "\x00\x01a b\x02 ", " \u2007 ", "é "]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    kept = [r[0] for r in obj.clean_lines(df).collect()]
    assert kept == ["\u2003 x", "\u00a0", "a b", "\u2007", "é"]


@pytest.mark.parametrize("width", [1, 2, 3, 7, 50, 10_000])
def test_an_inventory_in_place_of_listing(spark, tmp_path, monkeypatch, width):
    """Every line is read once, wherever the ranges are cut."""
    monkeypatch.setattr("sluice.sources.streams.RANGE_BYTES", width)
    texts = {"a": "1\n22\n\n333\n", "b": "4\r\n5\r6\n\n\n7", "c": "\n", "d": "é" * 30 + "\n8"}
    for name, text in texts.items():
        put(str(tmp_path), name, text)
    rows = [(n, f"{tmp_path}/{n}", len(t.encode())) for n, t in texts.items()]
    listing = spark.createDataFrame([*rows, ("e", "/nowhere", 0)], "object_key string, path string, length bigint")
    found = {}
    for r in obj.read_lines(spark, "", listing=listing).orderBy("object_key", "block", "row").collect():
        found.setdefault(r["object_key"], []).append(r["line"])
    assert found == {"a": ["1", "22", "", "333"], "b": ["4", "5", "6", "", "", "7"], "c": [""], "d": ["é" * 30, "8"]}
    read = obj.read_objects(spark, "", "jsonl", listing=listing, keep=lambda k: k < "d")
    assert {k: sorted(v) for k, v in values(read).items()} == {"a": ["1", "22", "333"], "b": ["4", "5", "6", "7"]}
    chunks = values(obj.read_objects(spark, "", "bytes", chunk_size=4, listing=listing))
    assert {k: b"".join(bytes(c) for c in v).decode() for k, v in chunks.items()} == texts


@pytest.mark.parametrize("compression", ["gzip", "snappy", "zstd"])
def test_compressed(spark, tmp_path, compression, monkeypatch):
    monkeypatch.setattr("sluice.sources.streams.BATCH_ROWS", 7)
    monkeypatch.setattr("sluice.sources.streams.BLOCK_ROWS", 5)
    put(str(tmp_path), "a.jsonl", encode(jsonl(100, bad=(61,)).encode(), compression))
    # Two streams, one after the other, are one object.
    put(str(tmp_path), "b.jsonl", encode(b'{"id":1}\n{"id":', compression) + encode(b"2}\n", compression))
    read = values(obj.read_objects(spark, str(tmp_path), "jsonl", compression=compression, on_error="truncate"))
    assert sorted(json.loads(v)["id"] for v in read["a.jsonl"]) == list(range(61))
    assert sorted(json.loads(v)["id"] for v in read["b.jsonl"]) == [1, 2]
    data = values(obj.read_objects(spark, str(tmp_path), "bytes", compression=compression, chunk_size=9))
    assert b"".join(bytes(c) for c in data["b.jsonl"]) == b'{"id":1}\n{"id":2}\n'
    progress = spark.createDataFrame([("b.jsonl", 1)], "object_key string, record_count bigint")
    rest = values(obj.read_objects(spark, str(tmp_path), "bytes", compression=compression, chunk_size=9, progress=progress))
    assert [bytes(c) for c in rest["b.jsonl"]] == [b'{"id":2}\n']


def test_gzip_is_plain_gzip():
    data = os.urandom(100_000)
    assert gzip.decompress(encode(data, "gzip")) == data
    for compression in ("none", "snappy", "zstd", "gzip"):
        assert decompressed(io.BytesIO(encode(data, compression)), compression).read() == data


def test_cut_off_stream_fails():
    with pytest.raises(EOFError):
        decompressed(io.BytesIO(encode(b"abc" * 1000, "snappy")[:-3]), "snappy").read()


def test_parquet(spark, tmp_path):
    spark.range(100).selectExpr("concat('name', id) as name", "30 as age").coalesce(1).write.parquet(f"{tmp_path}/p/x")
    evolved = spark.range(5).selectExpr("concat('n', id) as name", "false as blocked")
    evolved.coalesce(1).write.parquet(f"{tmp_path}/p/y")
    read = obj.read_objects(spark, f"{tmp_path}/p", "parquet")
    assert set(read.columns) == {"object_key", "name", "age", "blocked"}
    assert read.filter("object_key like 'x/%'").select("name").distinct().count() == 100
    assert read.count() == 105


def test_avro_needs_its_package(spark, tmp_path):
    with pytest.raises(PySparkException, match="(?i)avro"):
        obj.read_objects(spark, str(tmp_path), "avro")


def test_keep_opens_matching_objects_only(spark, tmp_path):
    for p in range(4):
        put(str(tmp_path), f"t-{p}-0.jsonl", '{"id":1}\n')

    def third(key):
        found = match_source_name(key, "{{topic}}-{{partition}}-{{start_offset}}")
        return found.matches & (found.partition == 3)

    for fmt in ("jsonl", "bytes"):
        assert list(values(obj.read_objects(spark, str(tmp_path), fmt, keep=third))) == ["t-3-0.jsonl"]


def test_match_and_envelope(spark):
    df = spark.createDataFrame([("t-1-5.txt", b"x"), ("other", b"y")], "object_key string, value binary")
    row = obj.envelope(obj.match_names(df, "{{topic}}-{{partition}}-{{start_offset}}"), "start_offset").collect()
    assert [tuple(r) for r in row] == [("t", 1, b"t-1-5.txt", b"x", 5)]
    assert obj.match_names(df, "{{topic}}-{{partition}}", target_topic="z").first()["topic"] == "z"


def test_tolerance(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "a int, bad boolean")
    assert obj.tolerate(df, F.col("bad"), tolerance="all").count() == 2
    with pytest.raises(PySparkException, match="data error"):
        obj.tolerate(df, F.col("bad")).collect()
    assert obj.tolerate(df.filter("a > 1"), F.col("bad")).count() == 2


def test_progress_merge(spark):
    schema = "bucket string, object_key string, record_count bigint"
    stored = spark.createDataFrame([("b", "x", 5), ("b", "y", 7), ("b", "z", 1)], schema)
    updates = spark.createDataFrame([("b", "x", 6, 1), ("b", "x", 9, 2), ("c", "x", 2, 1)], schema + ", seq bigint")
    removed = spark.createDataFrame([("b", "z")], "bucket string, object_key string")
    merged = {(r[0], r[1]): r[2] for r in prog.merge_progress(stored, updates, removed).collect()}
    assert merged == {("b", "x"): 9, ("b", "y"): 7, ("c", "x"): 2}


def test_processed_objects_are_left_out(spark):
    objects = spark.createDataFrame([(k,) for k in "abcdef"], "object_key string")
    processed = spark.createDataFrame([("a", 1), ("c", 2), ("d", 3), ("d", 4)], "object_key string, seq bigint")
    assert sorted(r[0] for r in prog.drop_processed(objects, processed).collect()) == ["b", "e", "f"]


@pytest.mark.parametrize(
    "line, bad",
    [("{'a':1}", True), ('{"b":2} trailing', True), ('{"a":1}{"b":2}', True), ("1,2", True), ("1],[2", True), ("[1,2", True),
     ('{"a":NaN}', True), ('{"a":01}', True), ("nul", True), ('"a"b', True), ('{"a":1}', False), ("null", False), ("[]", False),
     ('"x"', False), ("-1.5e3", False), ('{"a":1,"a":2}', False), ('{"a":{"b":[1,{"c":null}]}}', False)],
)
def test_json_is_strict(spark, line, bad):
    assert spark.createDataFrame([(line,)], "l string").select(obj.is_bad_json(F.col("l"))).first()[0] is bad


def test_records_are_numbered_across_blocks(spark):
    rows = [("o", b, i, f"{b}/{i}") for b in (0, 100, 200) for i in range(5)] + [("p", 0, 9, "x")]
    df = spark.createDataFrame(rows, "object_key string, block bigint, row bigint, value string")
    numbered = prog.record_numbers(df, position="row", slice_by="block").orderBy("object_key", "record_no")
    assert [(r["record_no"], r["value"]) for r in numbered.collect()] == [
        *[(i + 1, v) for i, (_, _, _, v) in enumerate(rows[:15])], (1, "x"),
    ]


def test_resume_with_slices(spark):
    rows = [("o", i, str(i)) for i in range(20)] + [("p", 3, "x")]
    df = spark.createDataFrame(rows, "object_key string, position bigint, value string")
    progress = spark.createDataFrame([("o", 13)], "object_key string, record_count bigint")
    for width in (1, 4, 100):
        rest = prog.resume(df, progress, slice_width=width)
        assert sorted((r["object_key"], r["record_no"], r["value"]) for r in rest.collect()) == [
            *[("o", i + 1, str(i)) for i in range(13, 20)], ("p", 1, "x"),
        ]


def test_log_records(spark):
    log = spark.sql(
        "select 'k' as key, cast('v' as binary) as value, 't' as topic, 3 as partition, 9L as offset,"
        " timestamp '2024-01-01 00:00:00.5Z' as timestamp, 0 as timestampType,"
        " array(named_struct('key', 'h', 'value', cast('x' as binary))) as headers"
    )
    row = log_records(log).first()
    assert (row["topic"], row["partition"], row["offset"], row["timestamp_ms"]) == ("t", 3, 9, 1704067200500)
    assert bytes(row["headers"][0]["value"]) == b"x"
    assert log_records(log.drop("headers")).first()["headers"] == []
    assert log_records(log.withColumn("headers", F.lit(None).cast("array<struct<key:string,value:binary>>"))).first()["headers"] == []


def test_a_log_needs_its_package(spark):
    with pytest.raises(PySparkException, match="(?i)kafka"):
        read_log(spark, "host:1", "t")


def test_conversation_offsets_rise_with_turns(spark, sf_dir):
    records = conversation_records(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    assert records.select("topic", "partition", "offset").distinct().count() == records.count()
    ranges = records.groupBy("batch_id").agg(F.min("offset").alias("low"), F.max("offset").alias("high")).orderBy("batch_id").collect()
    assert all(a["high"] < b["low"] for a, b in zip(ranges, ranges[1:]))


def test_typed_values(spark, tmp_path):
    put(str(tmp_path), "t-1", '{"a":1,"b":[true]}\n\'x\'\n{"a":2}\n7\n')
    read = obj.read_objects(spark, str(tmp_path), "jsonl", value_schema="a int, b array<boolean>")
    rows = sorted(str(r["value"].asDict() if r["value"] else None) for r in read.collect())
    assert rows == sorted(map(str, [{"a": 1, "b": [True]}, {"a": 2, "b": None}, {"a": None, "b": None}]))
    variant = obj.read_objects(spark, str(tmp_path), "jsonl", value_schema="variant")
    found = variant.select(F.try_variant_get("value", "$.a", "int"), F.schema_of_variant("value")).collect()
    assert sorted(map(str, (r[0] for r in found))) == ["1", "2", "None"] and "BIGINT" in {r[1] for r in found}


def test_records_of_objects_are_never_broadcast(spark, tmp_path):
    """To Spark they look as small as their listing; only tables of slices may go through the driver."""
    for name in "abc":
        put(str(tmp_path), name, jsonl(300, bad=(250,)))
    good = obj.read_objects(spark, str(tmp_path), "jsonl")
    done = prog.object_progress(good).withColumn("record_count", F.call_function("div", "record_count", F.lit(3)))
    resumed = obj.read_objects(spark, str(tmp_path), "jsonl", progress=done)
    cut = obj.read_objects(spark, str(tmp_path), "jsonl", on_error="truncate")
    lines = obj.clean_lines(obj.read_lines(spark, str(tmp_path)))
    records = lines.select(F.col("object_key").alias("topic"), F.lit(0).alias("partition"), F.col("row").alias("offset"), F.col("line").alias("key"))
    grouped = group_records(records, "{{topic}}-{{partition}}-{{start_offset}}")
    for found, n in ((resumed, 3 * (299 - 99)), (cut, 3 * 250), (grouped, 3 * 300)):
        assert len(found.collect()) == n
        assert "BuildLeft" not in found._jdf.queryExecution().executedPlan().toString()
    ids = [i for i in range(300) if i != 250][99:]
    assert {k: sorted(json.loads(v)["id"] for v in vs) for k, vs in values(resumed).items()} == dict.fromkeys("abc", ids)
