"""Grouping: known cases, and random batches against record-by-record replay."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.functions.naming import check_grouping, resolve_mode
from sluice.operators.audit import file_audit, file_manifest, require_one_schema, schema_guard
from sluice.operators.compaction import compact_records
from sluice.operators.grouping import group_records
from sluice.operators.sizing import group_with_flags, record_size, threshold_flags
from sluice.operators.slices import cut_at_first, row_numbers, running_totals

SCHEMA = (
    "batch_id bigint, topic string, partition int, offset bigint, timestamp_ms bigint,"
    " key string, value string, key_schema_id int, value_schema_id int"
)
CHANGELOG = "{{topic}}-{{partition}}-{{start_offset}}"
HOURLY = "{{topic}}/{{timestamp:unit=yyyy}}{{timestamp:unit=HH}}/{{partition}}-{{start_offset}}"
HOUR = 3_600_000


def rec(topic, partition, offset, ms=0, key=None, value="v", ks=1, vs=1, batch=0):
    return (batch, topic, partition, offset, ms, key, value, ks, vs)


def files(df):
    out = {}
    for r in df.select("file_name", "offset").collect():
        out.setdefault(r["file_name"], []).append(r["offset"])
    return {name: sorted(offsets) for name, offsets in out.items()}


# Three partitions with gaps, their records dealt out in turn.
INTERLEAVED = [
    rec(topic, partition, offset)
    for offsets in zip([3, 4, 8, 9, 15, 16, 17], [70, 72, 74, 76, 78, 80, 82], [0, 5, 500, 501, 502, 900, 901])
    for (topic, partition), offset in zip([("clicks", 2), ("clicks", 7), ("views", 2)], offsets)
]


@pytest.mark.parametrize("width", [1, 3, 1 << 18])
def test_unlimited(spark, width):
    df = spark.createDataFrame(INTERLEAVED, SCHEMA)
    assert files(group_records(df, CHANGELOG, slice_width=width)) == {
        "clicks-2-3": [3, 4, 8, 9, 15, 16, 17],
        "clicks-7-70": [70, 72, 74, 76, 78, 80, 82],
        "views-2-0": [0, 5, 500, 501, 502, 900, 901],
    }


@pytest.mark.parametrize("width", [1, 3, 1 << 18])
def test_limited(spark, width):
    df = spark.createDataFrame(INTERLEAVED, SCHEMA)
    assert files(group_records(df, CHANGELOG, max_records=3, slice_width=width)) == {
        "clicks-2-3": [3, 4, 8],
        "clicks-2-9": [9, 15, 16],
        "clicks-2-17": [17],
        "clicks-7-70": [70, 72, 74],
        "clicks-7-76": [76, 78, 80],
        "clicks-7-82": [82],
        "views-2-0": [0, 5, 500],
        "views-2-501": [501, 502, 900],
        "views-2-901": [901],
    }


def test_hours_share_the_start_offset(spark):
    rows = [rec("clicks", 5, o, ms=HOUR * (o // 30)) for o in (12, 20, 29, 31, 65)]
    template = CHANGELOG + "-{{timestamp:unit=HH}}"
    df = spark.createDataFrame(rows, SCHEMA)
    assert files(group_records(df, template, ts_source="event")) == {
        "clicks-5-12-00": [12, 20, 29],
        "clicks-5-12-01": [31],
        "clicks-5-12-02": [65],
    }


def test_late_record_goes_to_its_own_hour(spark):
    rows = [rec("t", 0, 1, HOUR), rec("t", 0, 2, 2 * HOUR), rec("t", 0, 3, HOUR)]
    template = CHANGELOG + "-{{timestamp:unit=HH}}"
    df = spark.createDataFrame(rows, SCHEMA)
    assert files(group_records(df, template, ts_source="event")) == {
        "t-0-1-01": [1, 3],
        "t-0-1-02": [2],
    }


def test_schema_rotation(spark):
    # the key's schema changes once, the value's there and back
    rows = [rec("views", 3, o, ks=1 if o < 40 else 5) for o in (30, 33, 39, 40, 48)]
    rows += [rec("views", 4, o, vs=v) for o, v in zip((1, 2, 6, 7, 9, 11), (8, 8, 9, 9, 9, 8))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert files(group_records(df, CHANGELOG, schema_rotation=True)) == {
        "views-3-30": [30, 33, 39],
        "views-3-40": [40, 48],
        "views-4-1": [1, 2],
        "views-4-6": [6, 7, 9],
        "views-4-11": [11],
    }


def test_schema_rotation_limited(spark):
    rows = [rec("clicks", 0, o, vs=o // 25) for o in (20, 21, 22, 23, 24, 25, 26, 27, 50)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert files(group_records(df, CHANGELOG, schema_rotation=True, max_records=3)) == {
        "clicks-0-20": [20, 21, 22],
        "clicks-0-23": [23, 24],
        "clicks-0-25": [25, 26, 27],
        "clicks-0-50": [50],
    }


def test_rotation_needs_schemas(spark):
    df = spark.createDataFrame([rec("t", 0, 0, vs=None)], SCHEMA)
    with pytest.raises(PySparkException, match="schemas for key and value"):
        group_records(df, CHANGELOG, schema_rotation=True).collect()


def test_wallclock_is_one_hour_per_batch(spark):
    df = spark.createDataFrame(INTERLEAVED, SCHEMA)
    template = CHANGELOG + "-{{timestamp:unit=yyyy}}"
    names = {r[0][-4:] for r in group_records(df, template).select("file_name").collect()}
    year = spark.sql("select cast(year(current_timestamp()) as string)").first()[0]
    assert names == {year}


def replay(rows, template_time, limit, schemas, keyed):
    """Record after record, as a sink would: {(batch, offset...): file name}."""
    names = {}
    heads, buffers, known = {}, {}, {}
    batch = None
    for r in rows:
        b, topic, partition, offset, ms, key, _, ks, vs = r
        if b != batch:
            heads, buffers, known, batch = {}, {}, {}, b
        key_text = "null" if key is None else key
        group = (topic, partition, key_text) if keyed else (topic, partition)
        hour = f"{ms // HOUR % 24:02d}" if template_time else None

        def name(head):
            parts = [topic, str(partition), *([key_text] if keyed else []), str(head)]
            return "-".join(parts + ([hour] if hour else []))

        if schemas and known.setdefault(group, (ks, vs)) != (ks, vs):
            known[group] = (ks, vs)
            heads[group] = offset
            file = name(offset)
        else:
            file = name(heads.setdefault(group, offset))
            if limit and len(buffers.get(file, [])) in (0, *range(limit, limit + 9)):
                heads[group] = offset
                file = name(offset)
        buffers.setdefault(file, []).append(offset)
        names[(b, topic, partition, offset)] = file
    return names


def random_rows(seed, batches=60):
    """Batches of a few partitions with gaps in the offsets and unordered times."""
    rnd = random.Random(seed)
    rows = []
    for b in range(batches):
        at = {(t, p): rnd.randrange(20_000) for t in ("a", "b") for p in (0, 7)}
        schema = dict.fromkeys(at, (1, 1))
        for _ in range(rnd.randrange(1, 40)):
            tp = rnd.choice(list(at))
            at[tp] += rnd.randrange(1, 5)
            if rnd.random() < 0.2:
                schema[tp] = (rnd.randrange(1, 3), rnd.randrange(1, 3))
            rows.append(
                rec(
                    *tp,
                    at[tp],
                    ms=HOUR * rnd.randrange(3) if rnd.random() < 0.5 else HOUR,
                    key=rnd.choice(["k0", "k1", "null", None]),
                    ks=schema[tp][0],
                    vs=schema[tp][1],
                    batch=b,
                )
            )
    return rows


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("schemas", [False, True])
@pytest.mark.parametrize("timed", [False, True])
@pytest.mark.parametrize("limit", [0, 1, 2, 5])
def test_random_batches(spark, keyed, schemas, timed, limit):
    rows = random_rows(seed=limit + 10 * timed + 20 * schemas + 40 * keyed)
    template = "{{topic}}-{{partition}}-" + ("{{key}}-" if keyed else "") + "{{start_offset}}"
    if timed:
        template += "-{{timestamp:unit=HH}}"
    grouped = group_records(
        spark.createDataFrame(rows, SCHEMA),
        template,
        max_records=limit,
        ts_source="event",
        schema_rotation=schemas,
        slice_width=3,
    )
    found = {
        (r["batch_id"], r["topic"], r["partition"], r["offset"]): r["file_name"]
        for r in grouped.collect()
    }
    assert found == replay(rows, timed, limit, schemas, keyed)


def test_random_batches_keep_the_rules(spark):
    df = spark.createDataFrame(random_rows(7, batches=200), SCHEMA)
    grouped = group_records(df, CHANGELOG, max_records=3, slice_width=4)
    audit = file_audit(grouped, max_records=3, slice_width=4)
    assert audit.filter("not (starts_at_first and rising and within_limit)").count() == 0
    assert file_manifest(grouped).agg(F.sum("n_records")).first()[0] == df.count()


def test_audit_sees_falling_offsets(spark):
    rows = [("f", 1, 1, 1), ("f", 3, 1, 2), ("f", 2, 1, 3), ("g", 5, 5, 1), ("g", 6, 5, 9)]
    df = spark.createDataFrame(rows, "file_name string, offset bigint, start_offset bigint, pos bigint")
    for width in (1, 2, 100):
        audit = {r["file_name"]: r["rising"] for r in file_audit(df, position="pos", slice_width=width).collect()}
        assert audit == {"f": False, "g": True}


def test_compaction_per_flush_and_across(spark):
    rows = [rec("t", 0, i, key=str(i % 2), value=str(i)) for i in range(4)]
    rows.append(rec("t", 0, 4, key="0", value="4", batch=1))
    df = spark.createDataFrame(rows, SCHEMA)
    per_flush = {(r["batch_id"], r["file_name"]): r["value"] for r in group_records(df, "k{{key}}").collect()}
    assert per_flush == {(0, "k0"): "2", (0, "k1"): "3", (1, "k0"): "4"}
    whole = compact_records(df, "k{{key}}", across_flushes=True)
    assert {r["file_name"]: r["value"] for r in whole.collect()} == {"k0": "4", "k1": "3"}


def test_null_key_and_the_word_null_share_a_file(spark):
    df = spark.createDataFrame([rec("t", 0, 0), rec("t", 0, 1, key="null", value="w")], SCHEMA)
    assert [(r["file_name"], r["value"]) for r in group_records(df, "{{key}}").collect()] == [("null", "w")]


@pytest.mark.parametrize(
    "template, mode",
    [
        (CHANGELOG, "topic_partition"),
        (CHANGELOG + "{{timestamp:unit=HH}}", "topic_partition"),
        (CHANGELOG + "{{timestamp:unit=HH}}{{other}}", "topic_partition"),
        (CHANGELOG + "-{{key}}", "topic_partition_key"),
        ("{{key}}", "key"),
        ("{{key}}-{{topic}}", "key_topic_partition"),
        ("{{topic}}/{{partition}}/{{key}}", "key_topic_partition"),
    ],
)
def test_mode(template, mode):
    assert resolve_mode(template) == mode


@pytest.mark.parametrize("template", ["plain", "{{topic}}", "{{topic}}-{{partition}}", CHANGELOG + "{{other}}"])
def test_mode_refused(template):
    with pytest.raises(ValueError):
        resolve_mode(template)


def test_keyed_names_hold_one_record():
    assert check_grouping("{{key}}", 1) == "key"
    with pytest.raises(ValueError):
        check_grouping("{{key}}", 2)


def test_thresholds_do_not_split(spark):
    rows = [rec("t", 0, o, key="ab", value="é") for o in range(4)]
    grouped = group_records(spark.createDataFrame(rows, SCHEMA), CHANGELOG)
    for width in (1, 100):
        flags = threshold_flags(grouped, max_bytes=48, slice_width=width).orderBy("offset").collect()
        assert [r["file_bytes"] for r in flags] == [24, 48, 72, 96]
        assert [r["threshold_reached"] for r in flags] == [False, True, True, True]
        assert {r["file_name"] for r in flags} == {"t-0-0"}


def test_record_size_of_other_types(spark):
    df = spark.createDataFrame([(None, 12345)], "key string, value bigint")
    assert df.select(record_size(F.col("key"), F.col("value").cast("string"))).first()[0] == 25


def test_schema_guard(spark):
    rows = [rec("t", 0, 0, vs=1), rec("t", 0, 1, vs=2), rec("t", 1, 0), rec("t", 1, 1)]
    grouped = group_records(spark.createDataFrame(rows, SCHEMA), CHANGELOG)
    guard = {r["file_name"]: r["one_schema"] for r in schema_guard(grouped).collect()}
    assert guard == {"t-0-0": False, "t-1-0": True}
    nulls = [rec("t", 0, 0, vs=None), rec("t", 0, 1), rec("t", 1, 0, vs=None), rec("t", 1, 1, vs=None)]
    grouped_nulls = group_records(spark.createDataFrame(nulls, SCHEMA), CHANGELOG)
    guard = {r["file_name"]: r["one_schema"] for r in schema_guard(grouped_nulls).collect()}
    assert guard == {"t-0-0": False, "t-1-0": True}
    with pytest.raises(PySparkException, match="schema changed"):
        require_one_schema(grouped).collect()
    assert require_one_schema(grouped.filter("partition = 1")).count() == 2


def test_slices_against_plain_windows(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.7 else rnd.choice("xyz"), i * 3 + rnd.randrange(3), rnd.randrange(9)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, at bigint, v bigint")
    expected, sums, seen = {}, {}, {}
    for g, at, v in sorted(rows, key=lambda r: r[1]):
        seen[g], sums[g] = seen.get(g, 0) + 1, sums.get(g, 0) + v
        expected[(g, at)] = (seen[g], sums[g])
    for width in (1, 7, 1000):
        out = running_totals(row_numbers(df, ["g"], "at", width=width), ["g"], "at", {"total": F.col("v")}, width=width)
        assert {(r["g"], r["at"]): (r["row_no"], r["total"]) for r in out.collect()} == expected
        kept = cut_at_first(df, ["g"], "at", F.col("v") == 8, width=width)
        stop = {}
        for g, at, v in sorted(rows, key=lambda r: r[1]):
            if v == 8:
                stop.setdefault(g, at)
        assert {(r["g"], r["at"]) for r in kept.collect()} == {(g, at) for g, at, _ in rows if at < stop.get(g, 10**9)}


def test_flags_come_with_the_groups(spark):
    """The same flags as in two steps, and three shuffles in place of seven."""
    df = spark.createDataFrame(random_rows(11, batches=30), SCHEMA)
    limits = {"max_bytes": 48, "max_records": 3}
    for template, how in ((CHANGELOG, {}), (CHANGELOG, {"schema_rotation": False, "prefix": "p/"}), (HOURLY, {"ts_source": "event"})):
        for width in (1, 3, 1 << 16):
            apart = threshold_flags(group_records(df, template, slice_width=width, **how), slice_width=width, **limits)
            once = group_with_flags(df, template, slice_width=width, **limits, **how)
            assert sorted(once.columns) == sorted(apart.columns)
            assert once.select(apart.columns).exceptAll(apart).isEmpty() and once.count() == apart.count()
    plan = group_with_flags(df, CHANGELOG, **limits)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3
