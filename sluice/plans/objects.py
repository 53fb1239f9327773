"""Queries that list, match and split objects, and track progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.hashing import shard_by_object, shard_by_partition, utf16_hash
from sluice.plans.catalogue import query, table
from sluice.sources import objects as obj
from sluice.sources import progress as prog

# Fixed values of the rule below: which events are followed by a blank line,
# which by a bad one, and the bad lines in turn.
_BLANK_EVERY, _BAD_EVERY, _BAD_AT = 97, 1009, 500
_BAD_LINES = ["invalid-json", "{'a':1}", '{"b":2} trailing']

DOCS = """
docs AS (SELECT source || '/' || lang || '/' || doc_id || '.txt' AS object_key,
                octet_length(encode(text)) AS size, text, doc_id, n_chars, lang, source
         FROM documents)
"""
NAMES = """
names AS (SELECT lang || '/' || source || '-' || (doc_id * 300000007) || '-' || n_chars
                 || CASE WHEN lang = 'es' THEN '.bin' ELSE '.txt' END AS object_key
          FROM documents),
matched AS (
  SELECT object_key, regexp_extract(object_key, '([a-zA-Z0-9\\-_.]+)-(\\d+)-(\\d+)\\.txt', 1) AS topic,
         TRY_CAST(regexp_extract(object_key, '([a-zA-Z0-9\\-_.]+)-(\\d+)-(\\d+)\\.txt', 2) AS INTEGER)
           AS "partition",
         TRY_CAST(regexp_extract(object_key, '([a-zA-Z0-9\\-_.]+)-(\\d+)-(\\d+)\\.txt', 3) AS BIGINT)
           AS start_offset
  FROM names WHERE regexp_matches(object_key, '([a-zA-Z0-9\\-_.]+)-(\\d+)-(\\d+)\\.txt'))
"""
SOURCE_PATTERN = r"{{topic}}-{{partition}}-{{start_offset}}\.txt"
LINES = f"""
base AS (SELECT *, event_type || '/' || (user_id % 4) || '/' || strftime(ts, '%Y-%m-%d') || '.jsonl'
                AS object_key,
              '{{"event_id":' || event_id || ',"user_id":' || user_id || ',"props":' || props || '}}'
                AS json
         FROM events),
lines AS (
  SELECT object_key, event_id * 4 AS position, '  ' || json || ' ' AS line FROM base
  UNION ALL SELECT object_key, event_id * 4 + 1, '   ' FROM base WHERE event_id % {_BLANK_EVERY} = 0
  UNION ALL SELECT object_key, event_id * 4 + 2,
                   [{", ".join("'" + b.replace("'", "''") + "'" for b in _BAD_LINES)}][1 + event_id % 3] FROM base
            WHERE event_id % {_BAD_EVERY} = {_BAD_AT}),
clean AS (SELECT object_key, position, trim(line) AS value FROM lines WHERE trim(line) <> ''),
good AS (SELECT * FROM clean WHERE json_valid(value))
"""


def documents_as_objects(documents: DataFrame) -> DataFrame:
    content = F.encode("text", "UTF-8")
    return documents.select(
        F.concat_ws(
            "/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
        ).alias("object_key"),
        F.octet_length(content).cast("bigint").alias("size"),
        content.alias("content"),
        "doc_id",
    )


def documents_as_names(documents: DataFrame) -> DataFrame:
    """Names with a partition that outgrows its type, and some that do not fit."""
    suffix = F.when(F.col("lang") == "es", ".bin").otherwise(".txt")
    return documents.select(
        F.concat(
            "lang",
            F.lit("/"),
            "source",
            F.lit("-"),
            (F.col("doc_id") * 300000007).cast("string"),
            F.lit("-"),
            F.col("n_chars").cast("string"),
            suffix,
        ).alias("object_key")
    )


def event_lines(events: DataFrame) -> DataFrame:
    """One JSON-lines object per type, partition and day, with blank and bad lines."""
    key = F.concat(
        "event_type",
        F.lit("/"),
        F.pmod("user_id", F.lit(4)).cast("string"),
        F.lit("/"),
        F.to_date("ts").cast("string"),
        F.lit(".jsonl"),
    )
    json = F.concat(
        F.lit('  {"event_id":'),
        F.col("event_id").cast("string"),
        F.lit(',"user_id":'),
        F.col("user_id").cast("string"),
        F.lit(',"props":'),
        "props",
        F.lit("} "),
    )
    event = F.col("event_id")
    lines = F.array(
        F.struct(F.lit(0).alias("at"), json.alias("line")),
        F.when(
            F.pmod(event, F.lit(_BLANK_EVERY)) == 0,
            F.struct(F.lit(1).alias("at"), F.lit("   ").alias("line")),
        ),
        F.when(
            F.pmod(event, F.lit(_BAD_EVERY)) == _BAD_AT,
            F.struct(F.lit(2).alias("at"), F.array(*map(F.lit, _BAD_LINES))[F.pmod(event, F.lit(3)).cast("int")].alias("line")),
        ),
    )
    return (
        events.select(key.alias("object_key"), event, F.explode(F.array_compact(lines)).alias("l"))
        .select("object_key", (event * 4 + F.col("l.at")).alias("position"), "l.line")
    )


def _docs(spark, sf_dir) -> DataFrame:
    return documents_as_objects(table(spark, sf_dir, "documents"))


def _matched(spark, sf_dir, **options) -> DataFrame:
    names = documents_as_names(table(spark, sf_dir, "documents"))
    return obj.match_names(names, SOURCE_PATTERN, **options)


def _lines(spark, sf_dir) -> DataFrame:
    return event_lines(table(spark, sf_dir, "events"))


def _good(spark, sf_dir) -> DataFrame:
    return obj.jsonl_records(_lines(spark, sf_dir), on_error="drop")


@query(
    f"""WITH {DOCS} SELECT object_key, CAST(size AS BIGINT) AS size FROM docs
        WHERE starts_with(object_key, 'src1') AND object_key > 'src1/en/3'"""
)
def list_objects_after(spark, sf_dir):
    listed = obj.list_after(_docs(spark, sf_dir), prefix="src1", after="src1/en/3")
    return listed.select("object_key", "size")


@query(
    """WITH objects AS (SELECT conv_id || '/' || turn AS object_key,
            CASE WHEN role = 'system' THEN 0 ELSE octet_length(encode(text)) END AS size
          FROM conversations)
       SELECT object_key, CAST(size AS BIGINT) AS size FROM objects WHERE size > 0"""
)
def skip_empty_objects(spark, sf_dir):
    """Conversation turns as objects; what the system says is left empty."""
    size = F.when(F.col("role") == "system", 0).otherwise(F.octet_length("text"))
    objects = table(spark, sf_dir, "conversations").select(
        F.concat_ws("/", "conv_id", "turn").alias("object_key"), size.cast("bigint").alias("size")
    )
    return obj.skip_empty(objects)


@query(f"WITH {LINES} SELECT object_key, position, value FROM good")
def jsonl_records(spark, sf_dir):
    return _good(spark, sf_dir)


@query(
    f"""WITH {LINES} SELECT object_key, position, CAST(json_extract_string(value, '$.event_id') AS BIGINT) AS event_id,
          CAST(json_extract_string(value, '$.props.k') AS INTEGER) AS k FROM good"""
)
def jsonl_typed(spark, sf_dir):
    """Values parsed by a schema; all of them objects here."""
    schema = "event_id bigint, user_id bigint, props struct<k int>"
    records = obj.jsonl_records(_lines(spark, sf_dir), on_error="drop", value_schema=schema)
    return records.select("object_key", "position", "value.event_id", "value.props.k")


@query(
    f"""WITH {LINES}, cuts AS (SELECT object_key, min(position) AS cut FROM clean
             WHERE NOT json_valid(value) GROUP BY object_key)
        SELECT c.object_key, c.position, c.value FROM clean c LEFT JOIN cuts USING (object_key)
        WHERE cut IS NULL OR position < cut"""
)
def jsonl_truncate_at_error(spark, sf_dir):
    return obj.jsonl_records(_lines(spark, sf_dir), on_error="truncate")


@query(
    f"""WITH {LINES} SELECT object_key, position, value AS text, NOT json_valid(value) AS rejected,
               count(*) OVER () AS n_lines, sum(CAST(NOT json_valid(value) AS BIGINT)) OVER ()::BIGINT AS n_rejects
        FROM clean"""
)
def rejects_one_pass(spark, sf_dir):
    """Records and rejects of one job, with its counts."""
    split = obj.split_lines(_lines(spark, sf_dir))
    good = split.records.select("object_key", "position", F.col("value").alias("text"), F.lit(False).alias("rejected"))
    bad = split.rejects.select("object_key", "position", F.col("line").alias("text"), F.lit(True).alias("rejected"))
    counts = {"n_lines": F.lit(split.n_lines).cast("bigint"), "n_rejects": F.lit(split.n_rejects).cast("bigint")}
    return good.unionByName(bad).withColumns(counts)


@query(
    f"WITH {LINES} SELECT object_key, position, value AS line FROM clean WHERE NOT json_valid(value)"
)
def rejects(spark, sf_dir):
    return obj.rejects(_lines(spark, sf_dir))


@query(
    """SELECT 'events.parquet' AS object_key, event_id, user_id, event_type, props FROM events"""
)
def parquet_records(spark, sf_dir):
    records = obj.read_objects(spark, sf_dir, "parquet", glob="events.parquet")
    return records.select("object_key", "event_id", "user_id", "event_type", "props")


@query(
    f"""WITH {DOCS}, hexed AS (SELECT object_key, hex(encode(text)) AS h FROM docs),
        numbered AS (SELECT object_key, h, unnest(range(1, CAST(ceil(length(h) / 8192.0) AS BIGINT) + 1))
                       AS n FROM hexed)
        SELECT object_key, CAST(n AS INTEGER) AS record_no,
               length(substring(h, (n - 1) * 8192 + 1, 8192)) // 2 AS size,
               md5(substring(h, (n - 1) * 8192 + 1, 8192)) AS digest FROM numbered"""
)
def bytes_chunks(spark, sf_dir):
    chunks = obj.bytes_chunks(_docs(spark, sf_dir).select("object_key", "content"))
    return chunks.select(
        "object_key",
        "record_no",
        F.octet_length("value").cast("bigint").alias("size"),
        F.md5(F.hex("value").cast("binary")).alias("digest"),
    )


@query(
    """SELECT 'pages' AS topic, CAST(page_id % 8 AS INTEGER) AS "partition",
              hex(encode('pages/' || page_id % 8 || '/' || page_id || '.html')) AS key_hex,
              md5(html) AS digest FROM pages"""
)
def object_envelope(spark, sf_dir):
    part = F.pmod("page_id", F.lit(8)).cast("string")
    pages = table(spark, sf_dir, "pages").select(
        F.concat(
            F.lit("pages/"), part, F.lit("/"), F.col("page_id").cast("string"), F.lit(".html")
        ).alias("object_key"),
        F.encode("html", "UTF-8").alias("value"),
    )
    records = obj.envelope(obj.match_names(pages, "{{topic}}/{{partition}}/"))
    return records.select(
        "topic", "partition", F.hex("key").alias("key_hex"), F.md5("value").alias("digest")
    )


@query(f'WITH {NAMES} SELECT object_key, topic, "partition", start_offset FROM matched')
def source_pattern_match(spark, sf_dir):
    return _matched(spark, sf_dir)


@query(
    f"""WITH {NAMES} SELECT object_key, 'target' AS topic, "partition", start_offset FROM matched"""
)
def topic_override(spark, sf_dir):
    return _matched(spark, sf_dir, target_topic="target")


@query(
    """SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
              CAST(floor(epoch_us(ts) / 1000.0) AS BIGINT) AS timestamp_ms,
              CASE WHEN user_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS key,
              props AS value, 2 AS n_headers FROM events"""
)
def records_envelope(spark, sf_dir):
    from sluice.sources.records import event_records

    return event_records(table(spark, sf_dir, "events")).select(
        "topic",
        "partition",
        "offset",
        "timestamp_ms",
        "key",
        "value",
        F.size("headers").alias("n_headers"),
    )


@query(
    f"""WITH {DOCS} SELECT object_key FROM docs
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)"""
)
def drop_processed_objects(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    processed = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return prog.drop_processed(docs.select("object_key"), processed)


@query(
    f"""WITH {LINES}, done AS (SELECT object_key, count(*) // 2 AS record_count FROM good
             WHERE NOT starts_with(object_key, 'error') GROUP BY object_key),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY object_key ORDER BY position)
                       AS record_no FROM good)
        SELECT n.object_key, n.position, n.value, n.record_no
        FROM numbered n LEFT JOIN done USING (object_key)
        WHERE record_no > coalesce(record_count, 0)"""
)
def resume_skip(spark, sf_dir):
    """Half of each object has been read, nothing of the ``error`` objects."""
    good = _good(spark, sf_dir)
    half = F.call_function("div", F.col("record_count"), F.lit(2))
    progress = (
        prog.object_progress(good)
        .filter(~F.col("object_key").startswith("error"))
        .withColumn("record_count", half)
    )
    return prog.resume(good, progress)


@query(f"WITH {LINES} SELECT object_key, count(*) AS record_count FROM good GROUP BY object_key")
def object_progress(spark, sf_dir):
    return prog.object_progress(_good(spark, sf_dir))


@query(
    f"""WITH {LINES}, good_b AS (SELECT *, split_part(object_key, '/', 1) AS bucket FROM good),
        stored AS (SELECT bucket, object_key, count(*) AS record_count, CAST(NULL AS BIGINT) AS seq
                   FROM good_b GROUP BY ALL),
        updates AS (SELECT bucket, object_key, count(*) AS record_count, position // 8000 AS seq
                    FROM good_b WHERE bucket <> 'view' GROUP BY bucket, object_key, position // 8000),
        removed AS (SELECT DISTINCT bucket, object_key FROM good_b WHERE bucket = 'error'),
        both_ AS (SELECT * FROM stored UNION ALL SELECT * FROM updates)
        SELECT bucket, object_key, record_count FROM (
          SELECT *, row_number() OVER (PARTITION BY bucket, object_key
                                       ORDER BY seq DESC NULLS LAST) AS rn FROM both_)
        WHERE rn = 1 AND (bucket, object_key) NOT IN (SELECT (bucket, object_key) FROM removed)"""
)
def progress_merge(spark, sf_dir):
    good = _good(spark, sf_dir).withColumn("bucket", F.split_part("object_key", F.lit("/"), F.lit(1)))
    stored = prog.object_progress(good, "bucket")
    seq = F.call_function("div", F.col("position"), F.lit(8000))
    updates = prog.object_progress(good.filter("bucket <> 'view'").withColumn("seq", seq), "bucket", "seq")
    return prog.merge_progress(stored, updates, good.filter("bucket = 'error'"))


_HASH = """list_reduce(list_prepend(CAST(0 AS BIGINT),
             list_transform(string_split(object_key, ''), lambda c: CAST(ascii(c) AS BIGINT))),
             lambda h, u: (h * 31 + u) & 4294967295)"""


@query(
    f"""WITH {DOCS}, hashed AS (SELECT object_key, {_HASH} AS u FROM docs),
        signed AS (SELECT object_key, CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS h
                   FROM hashed)
        SELECT object_key, h AS hash, CAST(((h % 10) + 10) % 10 AS INTEGER) AS task FROM signed"""
)
def shard_object_hash(spark, sf_dir):
    key = F.col("object_key")
    return _docs(spark, sf_dir).select(
        key, utf16_hash(key).alias("hash"), shard_by_object(key, 10).alias("task")
    )


@query(
    f"""WITH {NAMES} SELECT object_key, "partition", CAST("partition" % 7 AS INTEGER) AS task
        FROM matched WHERE "partition" IS NOT NULL"""
)
def shard_partition(spark, sf_dir):
    """Objects without a usable partition belong to no task and are left out."""
    sharded = _matched(spark, sf_dir).withColumn("task", shard_by_partition(F.col("partition"), 7))
    return sharded.filter(F.col("task").isNotNull()).select("object_key", "partition", "task")


@query(
    f"""WITH {NAMES} SELECT object_key, topic, "partition", start_offset FROM matched
        WHERE NOT contains(object_key, '/src3-')"""
)
def errors_tolerance_all(spark, sf_dir):
    """Records that cannot be converted are dropped, those without a partition are not."""
    failed = F.contains(F.col("object_key"), F.lit("/src3-"))
    return obj.tolerate(_matched(spark, sf_dir), failed, tolerance="all")
