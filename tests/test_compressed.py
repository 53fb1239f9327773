"""Compressed objects read in ranges of streams, and work dealt by bytes."""

import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from sluice.sinks.codecs import encode
from sluice.sources import compressed, objects, streams
from sluice.sources.connector import read_records

CODECS = ["gzip", "snappy", "zstd"]


def pieces(seed: int, n: int = 20) -> list[bytes]:
    """Plain pieces of one object; lines go over their ends, some are empty, some have no line end."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lines = [f'{{"id":{i},"v":"{rng.random()}é"}}' for _ in range(rng.randrange(0, 60))]
        text = rng.choice(["\n", "\r\n"]).join(lines)
        out.append((text + rng.choice(["\n", "", "\r"])).encode())
    out[3] = b""
    out[5] = b"no line end here " * 40
    return out


def listing(spark, tmp_path, contents: dict[str, bytes]):
    rows = []
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
        rows.append((name, f"{tmp_path}/{name}", len(data)))
    return spark.createDataFrame(rows, "object_key string, path string, length bigint")


def text_lines(plain: bytes) -> list[str]:
    return [line.removesuffix("\n") for line in io.TextIOWrapper(io.BytesIO(plain), encoding="utf-8", errors="replace")]


@pytest.mark.parametrize("compression", CODECS)
def test_one_object_of_many_streams(spark, tmp_path, compression, monkeypatch):
    monkeypatch.setattr(streams, "RANGE_BYTES", 700)
    plain = pieces(1)
    whole = b"".join(plain)
    # The second object is one large stream, which cannot be divided.
    contents = {"a": b"".join(encode(p, compression) for p in plain), "b": encode(whole, compression), "c": encode(b"1\n2", compression)}
    listed = listing(spark, tmp_path, contents)
    ranges = compressed.stream_ranges(listed.where("object_key = 'a'"), compression).orderBy("start").collect()
    assert len(ranges) > 3 and ranges[0]["start"] == 0 and ranges[-1]["end"] == len(contents["a"])
    assert [r["end"] for r in ranges[:-1]] == [r["start"] for r in ranges[1:]]

    found = compressed.compressed_lines(listed, compression).withColumn("task", F.spark_partition_id()).collect()
    for key in "ab":
        mine = sorted((r["block"], r["row"], r["line"]) for r in found if r["object_key"] == key)
        assert [line for _, _, line in mine] == text_lines(whole)
        assert len({(b, n) for b, n, _ in mine}) == len(mine)
    assert len({r["task"] for r in found if r["object_key"] == "a"}) > 1
    again = compressed.compressed_lines(listed, compression)
    assert sorted(r[:3] for r in again.select("object_key", "block", "row").collect()) == sorted(
        (r["object_key"], r["block"], r["row"]) for r in found
    )

    for size, done in ((64, 0), (1000, 3), (10**6, 0)):
        chunks = compressed.compressed_chunks(listed.withColumn("done", F.lit(done)), compression, size).collect()
        expected = [whole[i : i + size] for i in range(0, len(whole), size)]
        for key in "ab":
            mine = sorted((r["record_no"], bytes(r["value"])) for r in chunks if r["object_key"] == key)
            assert mine == list(enumerate(expected, 1))[done:]


def test_what_only_looks_like_a_stream(spark, tmp_path, monkeypatch):
    """Streams stored inside of others, broken beginnings, and zeros between streams."""
    monkeypatch.setattr(streams, "RANGE_BYTES", 300)
    inner = gzip.compress(b"not a line of its own\n" * 9, mtime=0)
    stored = [gzip.compress(b"x" * 40 + b"\n" + inner * 3 + b"\x1f\x8b\x08\x00 broken\n", compresslevel=0, mtime=0) for _ in range(6)]
    data = (b"\0" * 7).join(stored)
    listed = listing(spark, tmp_path, {"a": data})
    found = compressed.compressed_lines(listed, "gzip").orderBy("block", "row").collect()
    assert [r["line"] for r in found] == text_lines(gzip.decompress(data))
    assert len({r["block"] for r in found}) > 1


def test_a_cut_object_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "RANGE_BYTES", 300)
    data = b"".join(encode(p, "gzip") for p in pieces(2))
    listed = listing(spark, tmp_path, {"a": data[:-9]})
    with pytest.raises(Exception, match="EOFError"):
        compressed.compressed_lines(listed, "gzip").collect()


@pytest.mark.parametrize("compression", ["none", *CODECS])
def test_names_are_taken_apart_once(spark, tmp_path, compression, monkeypatch):
    monkeypatch.setattr(streams, "RANGE_BYTES", 200)
    for partition in (0, 3):
        body = [encode(f'{{"id":{i}}}\n'.encode() * 9, compression) for i in range(20)]
        (tmp_path / f"t-{partition}-40").write_bytes(b"".join(body))
    for fmt, n in (("jsonl", 180), ("bytes", 19)):
        read = read_records(spark, str(tmp_path), "{{topic}}-{{partition}}-{{start_offset}}", fmt, compression=compression, chunk_size=90)
        got = {tuple(r)[:3]: r["n"] for r in read.groupBy("topic", "partition", "start_offset").agg(F.count("*").alias("n")).collect()}
        assert set(got) == {("t", 0, 40), ("t", 3, 40)} and all(v >= n for v in got.values())


def test_tasks_get_equal_bytes(spark):
    """One object has a third of all bytes."""
    rows = [("big", i * 1000, 1000) for i in range(400)] + [(f"o{i}", 0, (i * 37) % 1000 + 1) for i in range(1600)]
    ranges = spark.createDataFrame(rows, "path string, start bigint, bytes bigint")
    dealt = streams.dealt_by_bytes(ranges, "bytes", "path", "start", tasks=16)
    assert dealt.rdd.getNumPartitions() == 16
    loads = dealt.groupBy(F.spark_partition_id().alias("t")).agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()
    total = sum(r[2] for r in rows)
    assert sum(r["b"] for r in loads) == total and sum(r["n"] for r in loads) == len(rows)
    assert max(r["b"] for r in loads) < 1.1 * total / 16 + 1000
    assert streams.dealt_by_bytes(ranges.limit(0), "bytes", "path", "start").count() == 0
