"""Flushes that span micro-batches.

Each micro-batch stages its records as pieces of the flush that is open; the
flush is published, all of its files at once, when a file has reached a number
of bytes or records or when the flush has been open for a time. Unlimited files
go on from batch to batch: the *heads* of the open flush, one row per group with
the start offset and the schemas of its current file, take part in the next
grouping as records that are then left out. A limited grouping starts new files
in every micro-batch, since its buffers were written out; key-based names keep
the record that came last.

Everything between batches is kept below ``pending``: manifests of the pieces,
heads and sizes per file as tables, and a journal of one small object per batch.
What a batch does follows from its records and from the time that Spark keeps
with its offsets, so a batch run again either finds its entry in the journal,
and does nothing, or does the same again. Publishing may be repeated: moved
pieces are told by their size. ``pending`` belongs to the checkpoint of the query
and is of no use without it.

The time is looked at when records arrive. What is still open when a query ends
is published by :meth:`Flushes.close`, or goes on in its next run.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.functions.naming import check_grouping, key_string, upgrade_template
from sluice.operators.grouping import FLUSH_TIME, group_records, placed_width
from sluice.operators.sizing import record_size
from sluice.sinks import store
from sluice.sinks.files import PIECE, publish_files, stage_files, written

_HEAD = "_is_head"
# What the next batch has to know of the file that goes on.
_KNOWN = ("topic", "partition", "key", "start_offset", "key_schema_id", "value_schema_id")


class Flushes:
    """The flushes of one stream into the objects below ``path``.

    ``options`` are those of ``write_files``. A limit of 0 is no limit.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        template: str,
        pending: str,
        *,
        fmt: str = "csv",
        max_records: int = 0,
        ts_source: str = "wallclock",
        tz: str = "UTC",
        prefix: str = "",
        compression: str = "none",
        flush_bytes: int = 0,
        flush_records: int = 0,
        flush_seconds: float = 0,
        options: dict[str, str] | None = None,
        **how,
    ):
        self.spark, self.template, self.fmt = spark, upgrade_template(template), fmt
        self.path, self.pending = (store.qualified(spark, p).rstrip("/") for p in (path, pending))
        self.limits = (flush_bytes, flush_records, flush_seconds)
        rotation = fmt == "parquet"
        self.grouping = {"max_records": max_records, "ts_source": ts_source, "tz": tz, "prefix": prefix}
        self.grouping["schema_rotation"] = rotation
        self.placed = placed_width(self.template, max_records=max_records, schema_rotation=rotation)
        self.writing = {"compression": compression, "options": options}
        self.staged = {"guard": rotation, **self.writing, **how}
        mode = check_grouping(self.template, max_records)
        self.keyed = mode.startswith("key")
        # Files go on over batches where nothing limits them.
        self.by = None if self.keyed or max_records else ["topic", "partition"]
        if self.by and mode == "topic_partition_key":
            self.by.append("_key_string")

    # --- what a batch does -----------------------------------------------------------

    def add(self, batch: DataFrame, batch_id: int) -> DataFrame | None:
        """Stages a micro-batch; the written files if it ended the flush."""
        last, entry = self._journal(batch_id)
        if entry is not None:  # run again after its entry was made
            return None
        now = batch.select(F.unix_millis(FLUSH_TIME)).limit(1).collect()
        if not now:
            return None
        now = now[0][0]
        open_ = last if last and not last["published"] else {"first": batch_id, "opened": now, "batches": []}
        entry = {"batch": batch_id, "first": open_["first"], "opened": open_["opened"], "published": False}
        entry["batches"] = [*open_["batches"], batch_id]
        grouped = self._grouped(batch, open_["batches"])
        records = grouped.where(~F.col(_HEAD)).drop(_HEAD)
        self._measure(grouped, batch_id)
        staging = self._staging(entry)
        stage_files(records, staging, self._table("manifest", batch_id), self.fmt, placed=self.placed, **self.staged)
        done = None
        if self._due(entry, now):
            done = self._publish(entry)
            entry["published"] = True
        self._note(entry)
        if entry["published"]:
            self._clear(entry)
        return done

    def close(self) -> DataFrame | None:
        """Publishes what is open; for a query that has ended."""
        last, _ = self._journal(1 << 62)
        if not last or last["published"]:
            return None
        done = self._publish(last)
        self._note({**last, "published": True})
        self._clear(last)
        return done

    def _grouped(self, batch: DataFrame, earlier: Sequence[int]) -> DataFrame:
        batch = batch.withColumn(_HEAD, F.lit(False))
        if self.by and earlier:
            heads = self.spark.read.parquet(self._table("files", earlier[-1])).where("head")
            shown = {c: F.col(c) if c in _KNOWN and c in heads.columns else F.lit(None) for c in batch.columns}
            shown |= {"offset": F.col("start_offset"), _HEAD: F.lit(True), FLUSH_TIME: F.current_timestamp()}
            kinds = batch.schema
            batch = batch.unionByName(heads.select(*[shown[c].cast(kinds[c].dataType).alias(c) for c in batch.columns]))
        return group_records(batch, self.template, **self.grouping)

    def _measure(self, grouped: DataFrame, batch_id: int) -> None:
        """Records and bytes of each file of the batch; and which file of each group goes on, with its schemas."""
        known = [c for c in _KNOWN if c in grouped.columns]
        new = ~F.col(_HEAD)
        files = grouped.groupBy("file_name").agg(
            F.sum(new.cast("bigint")).alias("n_records"),
            F.sum(F.when(new, record_size(F.col("key"), F.col("value"))).otherwise(0)).alias("n_bytes"),
            F.max("offset").alias("_last"),
            *[F.max_by(c, "offset").alias(c) for c in known],
        )
        head = F.lit(False)
        if self.by:
            files = files.withColumn("_key_string", key_string(F.col("key")))
            head = F.row_number().over(W.partitionBy(*self.by).orderBy(F.desc("_last"))) == 1
        files.withColumn("head", head).write.mode("overwrite").parquet(self._table("files", batch_id))

    def _due(self, entry: dict, now: int) -> bool:
        most_bytes, most_records, seconds = self.limits
        if seconds and now - entry["opened"] >= seconds * 1000:
            return True
        if not most_bytes and not most_records:
            return False
        files = self.spark.read.parquet(*[self._table("files", b) for b in entry["batches"]])
        total = files.groupBy("file_name").agg(F.sum("n_bytes").alias("b"), F.sum("n_records").alias("n"))
        top = total.agg(F.max("b"), F.max("n")).first()
        return bool((most_bytes and (top[0] or 0) >= most_bytes) or (most_records and (top[1] or 0) >= most_records))

    def _publish(self, entry: dict) -> DataFrame:
        paths = [self._table("manifest", b) for b in entry["batches"]]
        manifest = self.spark.read.schema(PIECE).parquet(*paths)
        if self.keyed:
            batch = F.regexp_extract(F.col("_metadata.file_path"), r"/manifest-(\d+)/", 1).cast("bigint")
            newest = F.max("_batch").over(W.partitionBy("file_name"))
            manifest = manifest.withColumn("_batch", batch).withColumn("_newest", newest)
            manifest = manifest.where("_batch = _newest").drop("_batch", "_newest")
        publish_files(manifest, self.path, self._staging(entry), self.fmt, **self.writing)
        return written(manifest)

    # --- what is kept ------------------------------------------------------------------

    def _table(self, kind: str, batch_id: int) -> str:
        return f"{self.pending}/{kind}-{batch_id:012d}"

    def _staging(self, entry: dict) -> str:
        name = hashlib.md5(f"{self.pending}/{entry['first']}".encode()).hexdigest()
        return f"{self.path}/{store.STAGING}/{name}"

    def _journal(self, batch_id: int) -> tuple[dict | None, dict | None]:
        """The entry before a batch's own, and its own."""
        numbers = sorted(int(n) for n, *_ in store.children(f"{self.pending}/journal") if n.isdigit())
        before = [n for n in numbers if n < batch_id]
        return (self._entry(before[-1]) if before else None), (self._entry(batch_id) if batch_id in numbers else None)

    def _entry(self, number: int) -> dict:
        return json.loads(store.read_bytes(f"{self.pending}/journal/{number:012d}"))

    def _note(self, entry: dict) -> None:
        store.write_bytes(f"{self.pending}/journal/{entry['batch']:012d}", json.dumps(entry).encode())

    def _clear(self, entry: dict) -> None:
        """Pieces go with their flush; tables and entries of the flush before it, which nothing can ask for now."""
        store.remove_tree(self._staging(entry))
        store.remove_if_empty(f"{self.path}/{store.STAGING}")
        for folder in (self.pending, f"{self.pending}/journal"):
            for name in [n for n, *_ in store.children(folder)]:
                number = name.rpartition("-")[2]
                if number.isdigit() and int(number) < entry["first"]:
                    store.remove_tree(f"{folder}/{name}")
