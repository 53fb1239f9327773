"""A record stream written as objects: one micro-batch is one flush, or part of one.

Grouping state never outlives a flush, so each micro-batch is grouped with
the batch operators. Names follow from the records and from the time of the
batch, which Spark keeps with its offsets, so a batch replayed after a failure,
hours later even, puts the same objects in the same places. Spark commits the offsets
of a batch only after ``write_files`` has published all of it.

With a threshold a flush spans micro-batches (``streaming.flushes``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sluice.functions.naming import default_template
from sluice.operators.grouping import FLUSH_TIME, group_records, placed_width
from sluice.sinks.files import write_files
from sluice.streaming.flushes import Flushes

# Fixed value: how often buffers are written.
FLUSH_INTERVAL = "10 seconds"


def record_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    *,
    bytes_per_flush: int | None = None,
    **options: str,
) -> DataFrame:
    """Records from a growing folder; a flush takes all that is new.

    ``bytes_per_flush`` bounds a flush of the whole application, and so cuts
    files; the tasks' memory needs no bound.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true")
    if bytes_per_flush is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_flush)
    return reader.options(**options).load(path)


def write_stream(
    records: DataFrame,
    path: str,
    template: str | None,
    checkpoint: str,
    *,
    fmt: str = "csv",
    fields: Sequence[str] = ("value",),
    max_records: int = 0,
    ts_source: str = "wallclock",
    tz: str = "UTC",
    envelope: bool = True,
    compression: str = "none",
    interval: str = FLUSH_INTERVAL,
    available_now: bool = False,
    persist: bool = False,
    on_flush: Callable[[DataFrame, int], None] | None = None,
    pending: str | None = None,
    flush_bytes: int = 0,
    flush_records: int = 0,
    flush_seconds: float = 0,
    **options,
) -> StreamingQuery:
    """Starts the sink. ``on_flush`` gets each flush's manifest.

    With ``pending``, a folder on shared storage that is kept with the
    checkpoint, a flush goes on until one of its files has ``flush_bytes``
    (as ``operators.sizing`` estimates them) or ``flush_records``, or it has
    been open for ``flush_seconds``. ``flushes.Flushes.close`` publishes what
    is open when the query has ended for good.

    Grouping reads a batch more than once, mostly a few narrow columns.
    ``persist`` keeps it for the flush, for sources where reading again is
    dear, such as a log.
    """
    template = template or default_template(fmt, compression)
    limits = {"flush_bytes": flush_bytes, "flush_records": flush_records, "flush_seconds": flush_seconds}
    if any(limits.values()) and pending is None:
        raise ValueError("thresholds need a folder for what is pending")
    if pending is not None:
        how = {"fmt": fmt, "fields": fields, "max_records": max_records, "ts_source": ts_source, "tz": tz}
        how |= {"envelope": envelope, "compression": compression, **limits, **options}
        flushes = Flushes(records.sparkSession, path, template, pending, **how)

    def write(batch: DataFrame, batch_id: int) -> DataFrame | None:
        if pending is not None:
            return flushes.add(batch, batch_id)
        how = {"fmt": fmt, "fields": fields, "max_records": max_records, "ts_source": ts_source, "tz": tz}
        return flush_batch(batch, batch_id, path, template, envelope=envelope, compression=compression, **how, **options)

    def flush(batch: DataFrame, batch_id: int) -> None:
        if persist:
            batch = batch.persist()
        try:
            written = write(batch, batch_id)
            if on_flush and written is not None:
                on_flush(written, batch_id)
        finally:
            if persist:
                batch.unpersist()

    timed = records.withColumn(FLUSH_TIME, F.current_timestamp())
    writer = timed.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def flush_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    template: str,
    *,
    fmt: str,
    max_records: int = 0,
    ts_source: str = "wallclock",
    tz: str = "UTC",
    prefix: str = "",
    **options,
) -> DataFrame:
    """Groups and writes one flush; schema rotation goes with columnar formats."""
    rotation = fmt == "parquet"
    grouped = group_records(
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")),
        template,
        max_records=max_records,
        ts_source=ts_source,
        tz=tz,
        prefix=prefix,
        schema_rotation=rotation,
    )
    placed = placed_width(template, max_records=max_records, schema_rotation=rotation)
    return write_files(grouped, path, fmt, placed=placed, guard=rotation, **options)
