"""Objects in, records out: listing, matching and splitting.

An object table has ``object_key`` and, where the bytes are at hand,
``content``. Lines of an object carry a ``position`` that rises through it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from sluice.functions.naming import match_source_name
from sluice.operators.slices import SLICE_WIDTH, cut_at_first
from sluice.session import scratch_path
from sluice.sinks.store import local_path
from sluice.sources.listing import list_files

# Chunk size of the bytes format, and the formats there are.
DEFAULT_CHUNK = 4096
INPUT_FORMATS = ("avro", "bytes", "jsonl", "parquet")
# What is trimmed off a line, and the spaces beyond those that
# make up a blank line (the Unicode spaces that may break a line).
_TRIMMED = "".join(map(chr, range(0x21)))
_WIDE_BLANK = (
    "^[\\x09-\\x0d\\x1c-\\x20\\u1680\\u2000-\\u2006\\u2008-\\u200a"
    "\\u2028\\u2029\\u205f\\u3000]*$"
)


def list_after(
    names: DataFrame, *, prefix: str = "", after: str | None = None, key: str = "object_key"
) -> DataFrame:
    """Names under a prefix and strictly after a start key, in byte order."""
    out = names
    if prefix:
        out = out.filter(F.col(key).startswith(prefix))
    if after is not None:
        out = out.filter(F.col(key) > after)
    return out.orderBy(key)


def skip_empty(objects: DataFrame, size: str = "size") -> DataFrame:
    return objects.filter(F.col(size) > 0)


def match_names(
    objects: DataFrame, pattern: str, *, target_topic: str | None = None
) -> DataFrame:
    """Objects whose name fits, with topic, partition and offset from the name.

    A configured target topic wins over the one in the name.
    """
    found = match_source_name(F.col("object_key"), pattern)
    topic = F.lit(target_topic) if target_topic is not None else found.topic
    return objects.filter(found.matches).select(
        "*",
        topic.alias("topic"),
        found.partition.alias("partition"),
        found.offset.alias("start_offset"),
    )


def object_key_of(path: Column, root: str) -> Column:
    """Path below ``root``; schemes may differ, as ``s3`` and ``s3a`` do."""
    scheme, sep, rest = root.partition("://")
    if sep and scheme != "file":
        below = f"//{rest.rstrip('/')}/"
    else:
        below = f"{local_path(root)}/".replace("//", "/")
    at = F.instr(path, F.lit(below))
    key = F.substring(path, at + F.lit(len(below)), F.lit(2**31 - 1))
    return F.when(at > 0, key).otherwise(path)


def _decoded(path: Column) -> Column:
    """A path as ``_metadata`` has it, without its escapes."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(path, F.lit("%")), plain).otherwise(path)


def list_objects(
    spark: SparkSession,
    root: str,
    *,
    prefix: str = "",
    after: str | None = None,
) -> DataFrame:
    """Non-empty objects below ``root`` without their bytes, in key order."""
    found = list_files(spark, root).select("object_key", "path", F.col("length").alias("size"), "modified")
    return list_after(skip_empty(found), prefix=prefix, after=after)


def java_trim(text: Column) -> Column:
    """Removes everything up to the space character from both ends."""
    return F.btrim(text, F.lit(_TRIMMED))


def clean_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Drops blank lines and trims the others."""
    trimmed = lines.withColumn(line, java_trim(F.col(line)))
    # Only a line that begins beyond ASCII can still be blank; the rest skip the pattern.
    wide_blank = (F.ascii(line) > 127) & F.col(line).rlike(_WIDE_BLANK)
    return trimmed.filter((F.col(line) != "") & ~wide_blank)


def is_bad_json(line: Column) -> Column:
    """Whether a line is anything but one JSON value.

    It is parsed in full, as the first of two elements: the line's own hash
    comes second. So single quotes fail, as does whatever follows the value.
    """
    mark = F.xxhash64(line).cast("string")
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    pair = F.from_json(F.concat(F.lit("["), line, F.lit(","), mark, F.lit("]")), "array<string>", strict)
    return ~F.coalesce((F.size(pair) == 2) & (F.get(pair, F.lit(1)) == mark), F.lit(False))


def jsonl_records(
    lines: DataFrame,
    *,
    on_error: str = "drop",
    by: tuple[str, ...] = ("object_key",),
    position: str = "position",
    slice_width: int = SLICE_WIDTH,
    slice_by: str | None = None,
    value_schema: str | None = None,
) -> DataFrame:
    """Lines of JSON-lines objects as records with a ``value``.

    The value is the line's text, a ``variant`` with that as ``value_schema``,
    or of any other schema given, with nulls for what does not fit it.

    ``drop`` leaves out the bad lines, which ``rejects`` lists; ``truncate``
    ends an object silently at its first bad line and takes a second pass
    over the lines; ``fail`` stops the job.
    """
    clean = clean_lines(lines)
    bad = is_bad_json(F.col("line"))
    if on_error == "truncate":
        kept = cut_at_first(clean, by, position, bad, width=slice_width, slice_by=slice_by)
    elif on_error == "drop":
        kept = clean.filter(~bad)
    elif on_error == "fail":
        error = F.raise_error(F.concat(F.lit("not JSON: "), F.col("line")))
        kept = clean.withColumn("line", F.when(~bad, F.col("line")).otherwise(error.cast("string")))
    else:
        raise ValueError("on_error must be truncate, drop or fail")
    return kept.withColumn("line", parsed(F.col("line"), value_schema)).withColumnRenamed("line", "value")


def parsed(line: Column, value_schema: str | None) -> Column:
    """A line known to be JSON, as text, as a variant or by a schema."""
    if value_schema is None:
        return line
    return F.parse_json(line) if value_schema.lower() == "variant" else F.from_json(line, value_schema)


def rejects(lines: DataFrame) -> DataFrame:
    """The lines that are not JSON."""
    return clean_lines(lines).filter(is_bad_json(F.col("line")))


@dataclass
class Split:
    """Lines parted into records and rejects, and how many there were."""

    records: DataFrame
    rejects: DataFrame
    n_lines: int
    n_rejects: int


def split_lines(lines: DataFrame, *, tolerance: str = "all", value_schema: str | None = None) -> Split:
    """Good and bad JSON lines in one pass over the objects.

    Every line is read and parsed once; one job writes both tables to the
    shared scratch folder and counts as it goes. ``records`` have a ``value``
    as in :func:`jsonl_records`, ``rejects`` their ``line``. With tolerance
    ``none`` a bad line is an error, which names the first one.
    """
    if tolerance not in ("none", "all"):
        raise ValueError("errors tolerance must be none or all")
    spark = lines.sparkSession
    marked = clean_lines(lines).withColumn("_bad", is_bad_json(F.col("line")))
    value = F.when(~F.col("_bad"), parsed(F.when(~F.col("_bad"), F.col("line")), value_schema))
    seen = Observation()
    first = F.min(F.when(F.col("_bad"), F.col("line")))
    counted = marked.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if("_bad").alias("bad"), first.alias("first"))
    path = scratch_path(spark, "lines")
    parted = counted.withColumn("value", value).withColumn("line", F.when(F.col("_bad"), F.col("line")))
    parted.write.partitionBy("_bad").parquet(path)
    told = seen.get
    if told["bad"] and tolerance == "none":
        raise ValueError(f"{told['bad']} of {told['n']} lines are not JSON, such as {told['first'][:200]!r}")
    both = spark.read.schema(StructType([*parted.drop("_bad").schema.fields, StructField("_bad", BooleanType())])).parquet(path)
    good = both.where(~F.col("_bad")).drop("_bad", "line")
    return Split(good, both.where("_bad").drop("_bad", "value"), told["n"], told["bad"])


def bytes_chunks(objects: DataFrame, chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """Fixed-size chunks of ``content``; the last may be short, empty gives none."""
    if chunk_size < 1:
        raise ValueError("chunk size must be at least 1")
    size = F.octet_length("content")
    n_chunks = F.call_function("div", size + F.lit(chunk_size - 1), F.lit(chunk_size)).cast("int")
    numbers = F.when(n_chunks > 0, F.sequence(F.lit(1), n_chunks)).otherwise(
        F.array().cast("array<int>")
    )
    keep = [c for c in objects.columns if c != "content"]
    numbered = objects.select(*keep, "content", F.explode(numbers).alias("record_no"))
    start = (F.col("record_no") - 1) * chunk_size + 1
    return numbered.select(
        *keep, "record_no", F.substring(F.col("content"), start, F.lit(chunk_size)).alias("value")
    )


def envelope(records: DataFrame, *keep: str) -> DataFrame:
    """Records of objects as envelopes; the key is the object key in UTF-8."""
    return records.select(
        "topic",
        "partition",
        F.encode("object_key", "UTF-8").alias("key"),
        "value",
        *keep,
    )


def tolerate(records: DataFrame, error: Column, *, tolerance: str = "none") -> DataFrame:
    """Records whose conversion failed (``error`` holds): fail, or drop them.

    A record without a partition or offset is no such case: it is built with
    nulls.
    """
    if tolerance == "all":
        return records.filter(~F.coalesce(error, F.lit(False)))
    if tolerance != "none":
        raise ValueError("errors tolerance must be none or all")
    first = records.columns[0]
    failing = F.raise_error(F.lit("data error in a record")).cast(records.schema[first].dataType)
    return records.withColumn(
        first, F.when(F.coalesce(error, F.lit(False)), failing).otherwise(F.col(first))
    )


Keep = Callable[[Column], Column]


def _file_key(root: str) -> Column:
    return object_key_of(_decoded(F.col("_metadata.file_path")), root)


def _listed(
    spark: SparkSession, root: str, keep: Keep | None, glob: str | None, listing: DataFrame | None
) -> DataFrame:
    """Objects to open; the others are told by name and not opened."""
    if listing is None:
        return list_files(spark, root, keep=keep, glob=glob)
    return (listing.where(keep(F.col("object_key"))) if keep else listing).select("object_key", "path", "length")


Tag = Callable[[DataFrame], DataFrame]


def _tagged(listed: DataFrame, tag: Tag | None) -> tuple[DataFrame, list[str]]:
    """The listing with the columns that ``tag`` adds, once for each object, and their names."""
    with_tags = tag(listed) if tag else listed
    return with_tags, [c for c in with_tags.columns if c not in listed.columns]


def read_lines(
    spark: SparkSession,
    root: str,
    *,
    compression: str = "none",
    keep: Keep | None = None,
    glob: str | None = None,
    listing: DataFrame | None = None,
    tag: Tag | None = None,
) -> DataFrame:
    """Lines of every object below ``root`` with their place in it.

    Uncompressed objects are read in ranges of bytes: ``block`` is where the
    range starts, ``row`` rises within it, and both are the same in every
    scan. So are compressed ones, in ranges of whole streams; a range of many
    lines has several blocks. What ``tag`` adds to the listing every line has.
    """
    from sluice.sources import compressed, streams

    listed, tags = _tagged(_listed(spark, root, keep, glob, listing), tag)
    if compression == "none":
        return streams.range_lines(listed, tags)
    return compressed.compressed_lines(listed, compression, tags)


def read_objects(
    spark: SparkSession,
    root: str,
    fmt: str = "bytes",
    *,
    compression: str = "none",
    chunk_size: int = DEFAULT_CHUNK,
    on_error: str = "drop",
    progress: DataFrame | None = None,
    keep: Keep | None = None,
    glob: str | None = None,
    listing: DataFrame | None = None,
    value_schema: str | None = None,
    tag: Tag | None = None,
) -> DataFrame:
    """Records of the objects below ``root``: ``object_key`` and ``value``.

    Parquet and Avro give their own columns in place of ``value``. ``keep``
    tells from the object key whether to read an object. With ``progress``
    (``object_key, record_count``, one row each) the records an object has
    already given are skipped; for Parquet that is by the file's row order.
    ``listing`` (``object_key, path, length``), such as a store's inventory,
    takes the place of listing ``root``; not for Avro, which Spark lists.
    ``tag`` adds columns to the listing that all records of an object get; not
    for Parquet and Avro, whose files Spark reads.
    """
    if fmt not in INPUT_FORMATS:
        raise ValueError(f"input format must be one of {INPUT_FORMATS}, got {fmt!r}")
    if tag and fmt in ("avro", "parquet"):
        raise ValueError(f"{fmt} objects take no tags")
    if fmt == "avro":
        if listing is not None or progress is not None:
            raise ValueError("avro objects take neither a listing nor progress")
        reader = spark.read.option("recursiveFileLookup", "true")
        loaded = (reader.option("pathGlobFilter", glob) if glob else reader).format(fmt).load(root)
        rows = loaded.where(keep(_file_key(root))) if keep else loaded
        return rows.select(_file_key(root).alias("object_key"), *[F.col(f"`{c}`") for c in loaded.columns])
    if fmt == "parquet":
        from sluice.sources.listing import is_hidden
        from sluice.sources.tables import ROW_INDEX, read_tables

        reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")

        def scanned(rows: DataFrame, kept: DataFrame) -> DataFrame:
            at = F.col("_metadata.row_index").alias(ROW_INDEX)
            return kept.select(_file_key(root).alias("object_key"), at, *[F.col(f"`{c}`") for c in rows.columns])

        def below_root(seen: DataFrame) -> DataFrame:
            """The filter is on the scan's files, so unwanted objects are not opened."""
            rows = (reader.option("pathGlobFilter", glob) if glob else reader).parquet(root)
            return scanned(rows, rows.where(keep(_file_key(root))) if keep else rows)

        def of_listing(seen: DataFrame) -> DataFrame:
            """Spark's index of the files keeps their paths on the driver in any case."""
            rows = reader.parquet(*[r["path"] for r in seen.select("path").toLocalIterator()])
            return scanned(rows, rows)

        listed = _listed(spark, root, keep, glob, listing)
        if listing is None:
            return read_tables(spark, listed, below_root, progress)
        # A path that looks like a pattern would be taken as one.
        return read_tables(spark, listed, of_listing, progress, lambda key: is_hidden(key) | key.rlike(r"[\[\]{}*?\\]"))

    from sluice.sources import progress as prog
    from sluice.sources import compressed, streams

    if fmt == "jsonl":
        lines = read_lines(
            spark, root, compression=compression, keep=keep, glob=glob, listing=listing, tag=tag
        )
        records = jsonl_records(
            lines, on_error=on_error, position="row", slice_by="block", value_schema=value_schema
        )
        if progress is not None:
            records = prog.resume(records, progress, position="row", slice_by="block")
        return records.drop("block", "row", "record_no")
    listed, tags = _tagged(streams.with_done(_listed(spark, root, keep, glob, listing), progress), tag)
    if compression == "none":
        return streams.range_chunks(listed, chunk_size, tags)
    return compressed.compressed_chunks(listed, compression, chunk_size, tags)
