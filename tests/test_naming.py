"""Names: template grammar, rendering, reading back, source patterns, shards."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.functions import hashing
from sluice.functions.naming import (
    default_template,
    extract_variables,
    legacy_name,
    match_source_name,
    parse_template,
    record_bindings,
    record_time,
    render,
    template_variables,
    timestamp_units,
    upgrade_template,
)
from sluice.functions.timestamps import iso_instant, local_time, millis_from_ntz, time_unit

AWKWARD = [
    "", " ", "a.b*c+d?", "(x)[y]{z}", "^$|\\", "\\E.\\Q", "tab\there", "naïve ☃", "😀/😀", "{{", "}}",
    "%00", "'; drop table x; --", "<script>", "../../etc", "nul", "１２３", "‮abc",
]


def one(spark, column, **values):
    columns = [F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*columns).select(column).first()[0]


@pytest.mark.parametrize(
    "template, variables",
    [
        ("", []),
        ("plain", []),
        ("{{a}}", ["a"]),
        ("{{ a }}-{{b:x=y}}-{{  c  }}", ["a", "b", "c"]),
        ("{{a}}{{a}}", ["a", "a"]),
        ("{ {a}}", []),
        ("{{a-b}}", []),
        ("{{{a}}}", ["a"]),
        ("{{ {{a}} }}", ["a"]),
        ("{{a}}}}{{b", ["a"]),
        ("{{é}}{{a b}}{{a:b=é}}{{_1}}", ["_1"]),
        ("{{a:x=y=z}}", ["a"]),
    ],
)
def test_variables(template, variables):
    assert template_variables(template) == variables


@pytest.mark.parametrize("template", ["{{}}", "{{ }}", "{{:x=y}}", "{{a:}}", "{{a:=y}}", "{{a:x=}}", "{{a:x}}"])
def test_bad_placeholders(template):
    with pytest.raises(ValueError):
        parse_template(template)


def test_parts_make_up_the_template():
    for template in ("x{{ a }}y{{{b:c=d}}}", "}}{{", "{{a}} {{ b", "a}}b{{c}}"):
        assert "".join(p.text for p in parse_template(template)) == template
    assert parse_template("{{a:x=y=z}}")[0].value == "y"


def test_unbound_variables_stay(spark):
    name = render("{{a}}-{{ b:c=d }}", {"a": lambda p: F.lit("x")})
    assert one(spark, name, z=1) == "x-{{ b:c=d }}"


def test_padding(spark):
    bindings = record_bindings(topic=F.col("t"), partition=F.col("p"), start_offset=F.col("o"))
    template = "{{topic}}-{{partition:padding=TRUE}}-{{start_offset:padding=true}}-{{partition:padding=false}}"
    assert one(spark, render(template, bindings), t="x", p=7, o=2**40) == "x-0000000007-00000001099511627776-7"


@pytest.mark.parametrize(
    "tz, expected",
    [
        ("UTC", "2024-03-10-06"),
        ("America/New_York", "2024-03-10-01"),
        ("Asia/Kolkata", "2024-03-10-12"),
        ("+14:00", "2024-03-10-20"),
    ],
)
def test_time_zones_do_not_follow_the_session(spark, tz, expected):
    # 06:59 UTC, one minute before the clocks change in New York
    units = [time_unit(local_time(F.col("ms"), tz), u) for u in ("yyyy", "MM", "dd", "HH")]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", session)
            assert one(spark, F.concat_ws("-", *units), ms=1710053940000) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_after_the_clocks_change(spark):
    hour = time_unit(local_time(F.col("ms"), "America/New_York"), "HH")
    assert one(spark, hour, ms=1710054000000) == "03"


@pytest.mark.parametrize(
    "ms, text",
    [
        (0, "1970-01-01T00:00:00Z"),
        (1, "1970-01-01T00:00:00.001Z"),
        (1704067207100, "2024-01-01T00:00:07.100Z"),
        (-1, "1969-12-31T23:59:59.999Z"),
    ],
)
def test_iso_instant(spark, ms, text):
    assert one(spark, iso_instant(F.col("ms")), ms=ms) == text


def test_millis_round_down(spark):
    df = spark.sql("select timestamp_ntz'1969-12-31 23:59:59.9995' as ts")
    assert df.select(millis_from_ntz(F.col("ts"))).first()[0] == -1


def test_units_and_sources():
    assert timestamp_units("{{timestamp:unit=dd}}{{timestamp:unit=HH}}{{timestamp:unit=dd}}") == ["dd", "HH"]
    with pytest.raises(ValueError):
        timestamp_units("{{timestamp:unit=mm}}")
    with pytest.raises(ValueError):
        timestamp_units("{{timestamp}}")
    with pytest.raises(ValueError):
        record_time("clock", "UTC")


def test_legacy_unit():
    assert upgrade_template("a{{ timestamp : unit = YYYY }}{{YYYY}}") == "a{{ timestamp : unit = yyyy }}{{YYYY}}"


def test_default_names():
    assert default_template() == "{{topic}}-{{partition}}-{{start_offset}}"
    assert default_template("avro", "zstd").endswith("{{start_offset}}.avro.zst")
    assert default_template("json", "gzip").endswith("}}.gz")


def test_legacy_name(spark):
    name = legacy_name(
        "p/{{utc_date}}/{{partition:padding=true}}/",
        topic=F.col("t"), partition=F.col("p"), start_offset=F.col("o"),
        local=local_time(F.lit(0).cast("bigint")),
    )
    today = spark.sql("select cast(to_date(convert_timezone('UTC', localtimestamp())) as string)").first()[0]
    assert one(spark, name, t="x", p=7, o=5) == f"p/{today}/7/x-7-00000000000000000005"


@pytest.mark.parametrize("text", AWKWARD)
def test_awkward_text_round_trips(spark, text):
    template = text.replace("{{", "").replace("}}", "") + "<{{a}}>|{{b}}|" + "{{a}}"
    bindings = {"a": lambda p: F.col("a"), "b": lambda p: F.col("b")}
    named = spark.createDataFrame([(text, "b")], "a string, b string").withColumn("n", render(template, bindings))
    found = extract_variables(F.col("n"), template)
    row = named.select(*[c.alias(v) for v, c in found.items()]).first()
    assert row["a"] == text and row["b"] == "b"


def test_repeated_variable_must_repeat(spark):
    found = extract_variables(F.col("n"), "{{a}}-{{a}}1", on_mismatch="null")["a"]
    assert one(spark, found, n="x-x1") == "x"
    assert one(spark, found, n="x-y1") is None


def test_mismatch_is_an_error(spark):
    for name in ("a-1x", "xa-1", "a1"):
        with pytest.raises(PySparkException, match="does not match"):
            one(spark, extract_variables(F.col("n"), "a-{{v}}1")["v"], n=name[::-1] + "z")


# By kind: (pattern, object name, topic, partition, offset).
CASES = [
    # a greedy topic takes separators and digits as long as the rest still fits
    ("{{topic}}_{{partition}}_{{start_offset}}", "clicks_v2_11_900", "clicks_v2", 11, 900),
    ("{{topic}}/{{start_offset}}", "eu.web-clicks/77", "eu.web-clicks", None, 77),
    # zeros in front, and the largest numbers
    ("{{partition}}={{start_offset}}={{topic}}", "0042=0000=z", "z", 42, 0),
    ("{{start_offset}}@{{topic}}", f"{2**63 - 1}@m", "m", None, 2**63 - 1),
    # numbers beyond their types
    ("{{start_offset}}@{{topic}}", f"{2**63}@m", "m", None, None),
    ("{{topic}}%{{partition}}", f"q%{2**31}", "q", None, None),
    # found anywhere, with text around it
    ("in/{{topic}}/p{{partition}}/", "backup/in/t9/p3/part.bin", "t9", 3, None),
    ("{{topic}}-{{partition}}", "2031-05-x", "2031", 5, None),
    # a timestamp is digits and gives nothing; no variable that is a number
    ("{{timestamp}}!{{topic}}!{{start_offset}}", "170!t!8", "t", None, 8),
    ("(x|y)/{{topic}}", "y/t", "t", None, None),
    ("{{topic}}", "found☃", "found", None, None),
]


@pytest.mark.parametrize("pattern, name, topic, partition, offset", CASES)
def test_source_pattern(spark, pattern, name, topic, partition, offset):
    found = match_source_name(F.col("n"), pattern)
    df = spark.range(1).select(F.lit(name).alias("n"))
    row = df.select(found.matches, found.topic, found.partition, found.offset).first()
    assert tuple(row) == (True, topic, partition, offset)


def test_source_pattern_no_match(spark):
    found = match_source_name(F.col("n"), "{{topic}}-{{partition}}")
    assert one(spark, found.matches, n="nothing") is False
    assert one(spark, found.topic, n="nothing") is None
    for bad in ("{{topic}}{{topic}}", "({{topic}}"):
        with pytest.raises(ValueError):
            match_source_name(F.col("n"), bad)


def polynomial(text):
    data = text.encode("utf-16-be")
    h = 0
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i : i + 2], "big")) & 0xFFFFFFFF
    return h - 2**32 if h >= 2**31 else h


@pytest.mark.parametrize("text", AWKWARD + ["a" * 5000, "topic/1/0001.txt"])
def test_hash(spark, text):
    h, task = (
        spark.createDataFrame([(text,)], "k string")
        .select(hashing.utf16_hash(F.col("k")), hashing.shard_by_object(F.col("k"), 10))
        .first()
    )
    assert h == polynomial(text)
    assert task == polynomial(text) % 10


def test_every_object_has_one_task(spark):
    keys = spark.range(500).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    for shard in (hashing.shard_by_object, hashing.shard_balanced):
        tasks = {r[0] for r in keys.select(shard(F.col("k"), 4)).collect()}
        assert tasks == {0, 1, 2, 3}
    assert one(spark, hashing.shard_by_partition(F.lit(None).cast("int"), 4), z=1) is None
    with pytest.raises(ValueError):
        hashing.shard_by_object(F.col("k"), 0)
