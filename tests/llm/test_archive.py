"""The archive: exact records back, payloads once, copies as revisits."""

import base64
import hashlib

import pytest

from sluice.llm import archive


def build(spark, tmp_path, pages, **options):
    df = spark.createDataFrame(pages, "page_id long, url string, html string, digest string")
    path = f"file://{tmp_path}/warc"
    archive.write_archive(df, path, **options)
    return path, archive.read_archive(spark, path).collect()


PAGES = [
    (1, "http://a/1", "same", "x"),
    (5, "http://a/5", "same", "x"),
    (3, "http://a/\r\n3", "same", "x"),
    (2, None, None, None),
    (4, "u", "", None),
    (None, "n", "only null", None),
    (None, "n", "same", None),
    (6, "u", "ünï " * 50_000, None),
    (7, "u", "twice", None),
    (7, "u", "twice", None),
]


def test_records(spark, tmp_path):
    path, rows = build(spark, tmp_path, PAGES)
    assert len(rows) == len(PAGES)
    top = {}
    for page_id, _, html, _ in PAGES:
        top[html or ""] = max(top.get(html or "", -1), -1 if page_id is None else page_id)
    want = []
    for page_id, _, html, _ in PAGES:
        data = (html or "").encode()
        whole = (-1 if page_id is None else page_id) == top[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append(str((page_id, len(data), digest, "response" if whole else "revisit", None if whole else top[html or ""])))
    found = [str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in rows]
    assert sorted(found) == sorted(want)
    for r in rows:
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and block.endswith(b"\r\n\r\n")
        assert int(fields["Content-Length"]) == len(block) - 4
        http, _, body = block[:-4].partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK") and http.endswith(str(r.payload_bytes).encode())
        assert body == (b"" if r.record_type == "revisit" else bytes(r.payload))
        assert hashlib.sha1(bytes(r.payload)).digest() == base64.b32decode(r.payload_digest)
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == len({p[2] or "" for p in PAGES})


def test_summary_of_rebuilt_records(spark, tmp_path):
    """Payloads that look like headers change nothing; the whole record is read."""
    odd = [(8, "u", "\r\n\r\nWARC-Type: revisit\r\nWARC-Refers-To: <urn:page:9>\r\n", None)]
    path, rows = build(spark, tmp_path, PAGES + odd)
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    short = archive.summary(archive.read_archive(spark, path))
    assert sorted(str(tuple(r)) for r in short.collect()) == sorted(str(tuple(r[n] for n in names)) for r in rows)
    assert "concat" in short._jdf.queryExecution().optimizedPlan().toString()


def test_small_payloads_are_responses(spark, tmp_path):
    _, rows = build(spark, tmp_path, PAGES, min_bytes=5)
    assert {r.record_type for r in rows if r.payload_bytes < 5} == {"response"}


def test_damage_is_found(spark, tmp_path):
    path, _ = build(spark, tmp_path, PAGES[:1])
    spark.createDataFrame([(hashlib.sha256(b"same").hexdigest(), b"other")], "digest string, payload binary").write.mode(
        "overwrite"
    ).parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="payload is not"):
        archive.read_archive(spark, path).select("payload_bytes").collect()


def test_empty(spark, tmp_path):
    assert build(spark, tmp_path, [])[1] == []
