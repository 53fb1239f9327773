"""Parquet objects, whatever their names.

Spark reads the objects whose names its readers accept, with its own column
pruning and filters; the others, such as those that start with ``_`` or ``.``
somewhere, are read by row groups in tasks. Every object is read in one of the
two ways. Schemas are merged, as for one table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from sluice.session import ship_package
from sluice.sinks import store
from sluice.sources.listing import is_hidden

ROW_INDEX = "_row_index"


def read_tables(
    spark: SparkSession,
    listed: DataFrame,
    rows_of_visible: Callable[[DataFrame], DataFrame],
    progress: DataFrame | None = None,
    hidden: Callable[[Column], Column] = is_hidden,
) -> DataFrame:
    """``object_key`` and the objects' own columns, less the rows already read.

    ``rows_of_visible`` gives what Spark's reader makes of the listed objects
    that are not ``hidden`` to it, with ``object_key`` and ``_row_index``.
    """
    ship_package(spark)
    listed = listed.select("object_key", "path", "length")
    unseen = listed.where(hidden(F.col("object_key")))
    seen = listed.where(~hidden(F.col("object_key")))
    parts = []
    if not unseen.isEmpty():
        parts.append(_row_groups(spark, unseen))
    if not seen.isEmpty():
        parts.append(rows_of_visible(seen))
    if not parts:
        return spark.createDataFrame([], "object_key string")
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    if progress is not None:
        rows = rows.join(progress.select("object_key", "record_count"), "object_key", "left")
        rows = rows.where(F.col(ROW_INDEX) >= F.coalesce("record_count", F.lit(0))).drop("record_count")
    return rows.drop(ROW_INDEX)


def _unified(schemas: list[bytes]) -> pa.Schema:
    return pa.unify_schemas([pa.ipc.read_schema(pa.py_buffer(s)) for s in schemas], promote_options="permissive")


def _merged_schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    merged = None
    for batch in batches:
        for plain in batch.column(0).to_pylist():
            merged = _unified([plain] if merged is None else [merged, plain]).serialize().to_pybytes()
    if merged is not None:
        yield pa.RecordBatch.from_pydict({"schema": pa.array([merged], pa.binary())})


def _row_groups(spark: SparkSession, listed: DataFrame) -> DataFrame:
    groups = row_groups(listed)
    # Tasks merge what they have seen: one schema a task comes back, however many objects there are.
    seen = groups.select("schema").distinct().mapInArrow(_merged_schemas, "schema binary").collect()
    return rows_of(groups, from_arrow_schema(_unified([r[0] for r in seen])))


def row_groups(listed: DataFrame) -> DataFrame:
    """``object_key, path, number, first, schema`` of the objects' row groups; ``first`` is the row it starts with."""

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_random(row["path"]) as source:
                    meta = pq.ParquetFile(source)
                    n = meta.num_row_groups
                    sizes = [meta.metadata.row_group(i).num_rows for i in range(n)]
                    plain = meta.schema_arrow.remove_metadata().serialize().to_pybytes()
                columns = {
                    "object_key": [row["object_key"]] * max(n, 1),
                    "path": [row["path"]] * max(n, 1),
                    "number": list(range(n)) or [None],
                    "first": [sum(sizes[:i]) for i in range(n)] or [0],
                    "schema": [plain] * max(n, 1),
                }
                yield pa.RecordBatch.from_pydict(
                    columns,
                    pa.schema(
                        [("object_key", pa.string()), ("path", pa.string()), ("number", pa.int32()), ("first", pa.int64()), ("schema", pa.binary())]
                    ),
                )

    return listed.select("object_key", "path").repartition("path").mapInArrow(
        footers, "object_key string, path string, number int, first long, schema binary"
    )


def rows_of(groups: DataFrame, schema: StructType) -> DataFrame:
    """``object_key``, the row's number, and the columns of ``schema``; those an object has not are null."""
    schema = StructType([*StructType.fromDDL(f"object_key string, {ROW_INDEX} long").fields, *schema.fields])
    target = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_random(row["path"]) as source:
                    table = pq.ParquetFile(source).read_row_group(row["number"], [f.name for f in list(target)[2:]])
                n = table.num_rows
                columns = [pa.array([row["object_key"]] * n, pa.string()), pa.array(range(row["first"], row["first"] + n), pa.int64())]
                for field in list(target)[2:]:
                    there = table.column(field.name) if field.name in table.column_names else pa.nulls(n, field.type)
                    columns.append(there.cast(field.type))
                yield from pa.Table.from_arrays(columns, schema=target).to_batches(max_chunksize=10_000)

    found = groups.where("number IS NOT NULL").select("object_key", "path", "number", "first")
    return found.repartition("path", "number").mapInArrow(rows, schema)
