"""Content-addressed WARC archive: payload bytes once, exact record headers apart.

``write_archive`` stores two tables. ``payloads`` has each distinct payload
once under its SHA-256; ``headers`` has one row per record with the exact bytes
that stand before the payload, and that digest. ``read_archive`` joins them
back into whole records and checks every payload against its digest.

Of the records with one payload, the one with the largest page id is the
response and the others are revisits of it; payloads below ``min_bytes`` are
all responses. Rows that share the largest id (repeated rows) are all
responses; the smallest id is null. A null payload is empty, a null url is left
out of the header, and line breaks in a url are percent-encoded. A payload is
one value however long it is; an empty table gives an archive without records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import keep

HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
TAIL = "\r\n\r\n"


def base32_sha1(data: Column) -> Column:
    """The bare upper-case base32 SHA-1: each five hex digits are four letters."""
    digits = F.sha1(data)
    letters = []
    for i in range(8):
        group = F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(group, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(ALPHABET), at, F.lit(1)))
    return F.concat(*letters)


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _headers(date: str) -> Column:
    """The bytes of a record before its payload, HTTP headers included."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(HTTP), F.col("payload_bytes").cast("string"), F.lit(TAIL))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _urn(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", _urn(F.col("top"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        http,
    ).cast("binary")


def write_archive(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Writes ``path/payloads`` and ``path/headers``; other columns are left out.

    Digests, types and headers are worked out on narrow rows. Payload bytes
    are shuffled once, by (digest, page id), which no group of copies shares;
    only the row that holds the largest id goes on into the store.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long")
    )
    narrow = keep(rows.select("page_id", "url", "digest", "payload_bytes", base32_sha1(F.col("payload")).alias("sha1")), "warc")
    tops = narrow.groupBy("digest").agg(F.max("page_id").alias("top"))

    whole = (F.col("payload_bytes") < min_bytes) | F.col("page_id").eqNullSafe(F.col("top"))
    records = narrow.join(tops, "digest").withColumn("record_type", F.when(whole, "response").otherwise("revisit"))
    records.select("digest", "payload_bytes", _headers(date).alias("header")).write.option("compression", "zstd").parquet(
        f"{path}/headers"
    )

    def slot(page_id: str) -> Column:  # a null id is a slot too; the aggregate reuses the join's partitioning
        return F.coalesce(F.col(page_id).cast("string"), F.lit("null")).alias("slot")

    stored = rows.select("digest", slot("page_id"), "payload").join(tops.select("digest", slot("top")), ["digest", "slot"])
    stored.groupBy("digest", "slot").agg(F.first("payload").alias("payload")).select(
        "digest", "payload"
    ).write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, with what its header says and its whole payload.

    Columns: page_id, url, record_type, refers_to, payload_digest (as the
    header has it), payload_bytes and payload (of the full payload, revisits
    too), record (the bytes of the record as written: a revisit's has no
    payload). A payload that does not match its digests fails the job.

    Digests are checked before the join, so a reader that does not select the
    payload moves narrow rows only.
    """
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    right = F.sha2("payload", 256) == F.col("digest")
    payloads = payloads.select(
        F.when(right, F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("payload is not "), "digest"))).alias("digest"),
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("sha1"),
    )
    headers = spark.read.schema("digest string, header binary").parquet(f"{path}/headers")
    text = F.decode("header", "UTF-8")

    def said(name: str) -> Column:
        return F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1)

    number = r"^<urn:page:(-?\d+)>$"
    parsed = headers.select(
        "digest",
        "header",
        F.nullif(F.regexp_extract(said("WARC-Record-ID"), number, 1), F.lit("")).cast("long").alias("page_id"),
        F.nullif(said("WARC-Target-URI"), F.lit("")).alias("url"),
        said("WARC-Type").alias("record_type"),
        F.nullif(F.regexp_extract(said("WARC-Refers-To"), number, 1), F.lit("")).cast("long").alias("refers_to"),
        F.regexp_extract(said("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("payload_digest"),
    )
    joined = parsed.join(payloads, "digest")
    agrees = F.col("payload_digest") == F.col("sha1")
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.select(
        "page_id",
        "url",
        "record_type",
        "refers_to",
        F.when(agrees, F.col("payload_digest")).otherwise(F.raise_error(F.lit("header and payload differ"))).alias("payload_digest"),
        "payload_bytes",
        "payload",
        F.concat("header", body, F.lit(TAIL.encode())).alias("record"),
    )


def summary(records: DataFrame) -> DataFrame:
    """What the rebuilt bytes of each record say: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Types and ids are parsed from ``record`` (its header ends at the first empty
    line), length and digest are worked out anew from the joined ``payload``.
    """
    text = F.col("record").cast("string")

    def said(name: str, value: str) -> Column:
        return F.regexp_extract(text, rf"^WARC/1\.1\r\n(?:[^\r]+\r\n)*?{name}: {value}\r\n", 1)

    number = r"<urn:page:(-?\d+)>"
    return records.select(
        F.nullif(said("WARC-Record-ID", number), F.lit("")).cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        said("WARC-Type", r"([^\r]*)").alias("record_type"),
        F.nullif(said("WARC-Refers-To", number), F.lit("")).cast("long").alias("refers_to"),
    )
