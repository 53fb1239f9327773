"""What was written where, and whether it keeps the rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.operators.sizing import record_size
from sluice.operators.slices import SLICE, SLICE_WIDTH, with_slice, within


def _file_key(grouped: DataFrame) -> list[str]:
    return [c for c in ("batch_id",) if c in grouped.columns] + ["file_name"]


def file_manifest(grouped: DataFrame) -> DataFrame:
    """One row per file: records, first and last offset, estimated bytes."""
    return grouped.groupBy(*_file_key(grouped)).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        F.sum(record_size(F.col("key"), F.col("value"))).alias("n_bytes"),
    )


def file_audit(
    grouped: DataFrame,
    *,
    max_records: int = 0,
    position: str = "offset",
    slice_width: int = SLICE_WIDTH,
) -> DataFrame:
    """Per file: does its name carry its first offset, are offsets rising in
    order of ``position``, is it within the limit."""
    by = _file_key(grouped)
    sliced = with_slice(grouped, position, slice_width)
    previous = F.lag("offset").over(within(by, position))
    per_slice = (
        sliced.withColumn("_falls", (previous >= F.col("offset")).cast("int"))
        .groupBy(*by, SLICE)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("offset").alias("_min"),
            F.min("start_offset").alias("_start"),
            F.sum(F.coalesce("_falls", F.lit(0))).alias("_falls"),
            F.min_by("offset", position).alias("_first"),
            F.max_by("offset", position).alias("_last"),
        )
    )
    edge = F.lag("_last").over(W.partitionBy(*by).orderBy(SLICE))
    files = (
        per_slice.withColumn("_edge_fall", F.coalesce((edge >= F.col("_first")).cast("int"), F.lit(0)))
        .groupBy(*by)
        .agg(
            F.sum("_n").alias("n_records"),
            F.min("_min").alias("min_offset"),
            F.min("_start").alias("start_offset"),
            (F.sum("_falls") + F.sum("_edge_fall")).alias("n_falls"),
        )
    )
    within_limit = F.col("n_records") <= max_records if max_records else F.lit(True)
    return files.select(
        *by,
        "n_records",
        (F.col("min_offset") == F.col("start_offset")).alias("starts_at_first"),
        (F.col("n_falls") == 0).alias("rising"),
        within_limit.alias("within_limit"),
    )


def schema_guard(grouped: DataFrame) -> DataFrame:
    """Per file, whether it holds one key schema and one value schema."""
    ids = ("key_schema_id", "value_schema_id")
    one = F.lit(True)
    for c in ids:
        known = F.col(f"_known_{c}")
        one = one & (
            (known == 0) | ((known == F.col("_n")) & (F.col(f"_low_{c}") == F.col(f"_high_{c}")))
        )
    return (
        grouped.groupBy(*_file_key(grouped))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.count(c).alias(f"_known_{c}") for c in ids],
            *[F.min(c).alias(f"_low_{c}") for c in ids],
            *[F.max(c).alias(f"_high_{c}") for c in ids],
        )
        .select(*_file_key(grouped), one.alias("one_schema"))
    )


def require_one_schema(grouped: DataFrame) -> DataFrame:
    """The records, failing where a file would mix schemas."""
    mixed = schema_guard(grouped).filter(~F.col("one_schema"))
    error = F.raise_error(F.lit("schema changed inside a file"))
    checked = grouped.join(
        mixed.withColumn("_mixed", F.lit(True)).drop("one_schema"), _file_key(grouped), "left"
    )
    return checked.withColumn(
        "file_name",
        F.when(F.col("_mixed").isNull(), F.col("file_name")).otherwise(error.cast("string")),
    ).drop("_mixed")
