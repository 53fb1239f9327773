"""Log against objects, schemas against files, good lines beside bad ones."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.operators.reconcile import differing_records, reconcile
from sluice.settings import source_arguments
from sluice.sinks.files import write_files
from sluice.sources.connector import read_records
from sluice.sources.objects import read_lines, split_lines

SCHEMA = "topic string, partition int, offset bigint, key string, value string"
ROWS = [("t", o % 2, o, f"k{o}" if o % 3 else None, f"v{o}") for o in range(300)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def found(log, objects):
    return {(r.topic, r.partition, r.slice, r.n_log, r.n_objects, r.state) for r in reconcile(log, objects, slice_width=50).collect()}


def test_equal_sides_do_not_differ(spark):
    assert found(frame(spark, ROWS), frame(spark, ROWS[::-1])) == set()
    assert found(frame(spark, []), frame(spark, [])) == set()


def test_one_lost_one_doubled_one_changed(spark):
    log = frame(spark, ROWS)
    assert found(log, frame(spark, [r for r in ROWS if r[2] != 60])) == {("t", 0, 1, 25, 24, "missing")}
    assert found(log, frame(spark, [*ROWS, ROWS[101]])) == {("t", 1, 2, 25, 26, "extra")}
    for row in (("t", 0, 3, "", "v3"), ("t", 0, 3, None, "v3 "), ("t", 0, 4, None, "v3")):
        changed = [row if r[2] == 3 else r for r in [("t", 0, *r[2:]) for r in ROWS[:10]]]
        assert {s[-1] for s in found(frame(spark, [("t", 0, *r[2:]) for r in ROWS[:10]]), frame(spark, changed))} == {"changed"}
    swapped = [("t", 0, 1, "k", "a"), ("t", 0, 2, "k", "b")], [("t", 0, 1, "k", "b"), ("t", 0, 2, "k", "a")]
    assert len(found(*(frame(spark, s) for s in swapped))) == 1
    nothing = found(log, frame(spark, []))
    assert len(nothing) == 12 and {s[-1] for s in nothing} == {"missing"}


def test_names_without_partition_are_compared_too(spark):
    rows = [(None, None, 1, "k", "v")]
    assert found(frame(spark, rows), frame(spark, rows)) == set()
    assert found(frame(spark, rows), frame(spark, rows * 2)) == {(None, None, 0, 1, 2, "extra")}


def test_differing_records_are_named(spark):
    log, objects = frame(spark, ROWS), frame(spark, [r for r in ROWS if r[2] != 60] + [ROWS[101]])
    rows = differing_records(log, objects, reconcile(log, objects, slice_width=50), slice_width=50).collect()
    assert {(r.offset, r.n_log, r.n_objects) for r in rows} == {(60, 1, 0), (101, 1, 2)}


def test_checksums_shuffle_no_records(spark):
    plan = reconcile(frame(spark, ROWS), frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_xor" in plan  # sums come before the exchange


def guarded(spark, changes):
    rows = [("f", o, f"v{o}", 1, int(o >= changes), []) for o in range(10)]
    return spark.createDataFrame(rows, "file_name string, offset long, value string, key_schema_id int, value_schema_id int, headers array<struct<key: string, value: string>>")


@pytest.mark.parametrize("how", [{"fmt": "parquet"}, {"fmt": "jsonl"}, {"fmt": "parquet", "part_offsets": 5}])
def test_a_file_of_two_schemas_publishes_nothing(spark, tmp_path, how):
    """With pieces of five offsets each piece has one schema, and the file two."""
    with pytest.raises(ValueError, match="schema changes inside f"):
        write_files(guarded(spark, 5), f"{tmp_path}/out", guard=True, **how)
    assert [f for _, _, files in os.walk(f"{tmp_path}/out") for f in files] == []
    assert write_files(guarded(spark, 99), f"{tmp_path}/out", guard=True, **how).first().n_records == 10


def test_headers_are_part_of_the_schema(spark, tmp_path):
    header = F.array(F.struct(F.lit("h").alias("key"), F.lit("x").alias("value")))
    none = F.array().cast("array<struct<key: string, value: string>>")
    some = guarded(spark, 99).withColumn("headers", F.when(F.col("offset") > 3, header).otherwise(none))
    with pytest.raises(ValueError, match="schema changes"):
        write_files(some, f"{tmp_path}/a", "parquet", fields=["value", "headers"], guard=True)
    assert write_files(some, f"{tmp_path}/b", "parquet", fields=["value"], guard=True).count() == 1


def put(tmp_path, name, text):
    os.makedirs(tmp_path, exist_ok=True)
    with open(f"{tmp_path}/{name}", "w") as out:
        out.write(text)


def test_records_and_rejects_in_one_pass(spark, tmp_path):
    put(f"{tmp_path}/in", "t-0-0", '{"a":1}\n\nbad\n {"a":2}\n')
    put(f"{tmp_path}/in", "t-1-0", "{'a':3}\n[4]\n")
    reads = spark.sparkContext.accumulator(0)
    lines = read_lines(spark, f"{tmp_path}/in")

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    split = split_lines(lines.mapInArrow(counted, lines.schema), value_schema="struct<a: int>")
    assert (split.n_lines, split.n_rejects) == (5, 2)
    assert sorted((r.object_key, r.line) for r in split.rejects.collect()) == [("t-0-0", "bad"), ("t-1-0", "{'a':3}")]
    assert sorted((r.object_key, r.value.a if r.value else None) for r in split.records.collect())[:2] == [("t-0-0", 1), ("t-0-0", 2)]
    assert reads.value == 6  # each line once, for all three
    with pytest.raises(ValueError, match="2 of 5 lines"):
        split_lines(lines, tolerance="none")


def test_tolerance_in_readers_and_settings(spark, tmp_path):
    put(f"{tmp_path}/in", "t-0-0", '{"a":1}\nbad\n')
    pattern = "{{topic}}-{{partition}}-{{start_offset}}"
    how = source_arguments({"file.name.template": pattern, "input.format": "jsonl", "errors.tolerance": "ALL"})
    assert read_records(spark, f"{tmp_path}/in", **how).count() == 1
    with pytest.raises(Exception, match="not JSON"):
        read_records(spark, f"{tmp_path}/in", pattern, "jsonl", tolerance="none").collect()
    with pytest.raises(ValueError, match="tolerance"):
        read_records(spark, f"{tmp_path}/in", pattern, "jsonl", tolerance="some")
