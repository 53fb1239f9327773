"""Formatting: golden lines and columns."""

import base64
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.functions import formats as fmt

SCHEMA = (
    "topic string, partition int, offset bigint, timestamp_ms bigint, key string, value binary,"
    " headers array<struct<key:string,value:string>>"
)


def b64(text):
    return base64.b64encode(text.encode()).decode()


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        ("topic0", 0, 10, 1000, "key0", b"value0", [("h1", "a"), ("h2", "b")]),
        ("topic0", 0, 11, None, None, None, []),
        ("topic0", 0, 12, 1005, "ké,y", b'v,"5"\n', [("h1", "a"), ("h1", "c")]),
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


def lines(df, column):
    return [r[0] for r in df.orderBy("offset").select(column).collect()]


def test_csv(records):
    assert lines(records, fmt.csv_line(records, ["key", "value", "timestamp", "offset"])) == [
        f"{b64('key0')},{b64('value0')},1000,10",
        ",,,11",
        f"{b64('ké,y')},{b64(chr(118) + ',' + chr(34) + '5' + chr(34) + chr(10))},1005,12",
    ]


def test_csv_raw_value_is_not_quoted(records):
    assert lines(records, fmt.csv_line(records, ["value"], value_encoding="none")) == [
        "value0", "", 'v,"5"\n',
    ]


def test_csv_headers(records):
    assert lines(records, fmt.csv_line(records, ["headers", "offset"])) == [
        f"{b64('h1')}:{b64('a')};{b64('h2')}:{b64('b')};,10",
        ",11",
        f"{b64('h1')}:{b64('a')};{b64('h1')}:{b64('c')};,12",
    ]


def test_long_values_stay_on_one_line(spark):
    df = spark.createDataFrame([(0, "x" * 500)], "offset bigint, value string")
    assert lines(df, fmt.csv_line(df, ["value"])) == [b64("x" * 500)]


def test_csv_takes_bytes_only(spark):
    df = spark.createDataFrame([(1, 2)], "key string, value bigint")
    with pytest.raises(TypeError):
        fmt.csv_line(df, ["value"])


def test_json_lines(spark):
    df = spark.createDataFrame(
        [(17, 86_400_250, "sku-9", ("teapot",)), (18, None, None, None)],
        "offset bigint, timestamp_ms bigint, key string, value struct<item:string>",
    )
    assert lines(df, fmt.json_line(["value"])) == ['{"value":{"item":"teapot"}}', '{"value":null}']
    assert lines(df, fmt.json_line(["value"], envelope=False)) == ['{"item":"teapot"}', "null"]
    assert lines(df, fmt.json_line(["offset"], envelope=False)) == ["17", "18"]
    whole = [json.loads(line) for line in lines(df, fmt.json_line(["key", "value", "timestamp", "offset"]))]
    assert whole == [
        {"key": "sku-9", "value": {"item": "teapot"}, "timestamp": "1970-01-02T00:00:00.250Z", "offset": 17},
        {"key": None, "value": None, "timestamp": None, "offset": 18},
    ]


def test_json_headers(records):
    found = [json.loads(line)["headers"] for line in lines(records, fmt.json_line(["headers"]))]
    assert found[0] == [{"key": "h1", "value": "a"}, {"key": "h2", "value": "b"}]
    assert found[1] == []


def test_json_keeps_exact_decimals(spark):
    df = spark.sql("select 0L as offset, cast('1.10' as decimal(20,2)) as value")
    assert lines(df, fmt.json_line(["value"])) == ['{"value":1.10}']


def test_json_array(spark):
    df = spark.createDataFrame([(0, ['{"a":1}', '{"a":2}'])], "offset bigint, l array<string>")
    assert lines(df, fmt.json_array(F.col("l"))) == ['[\n{"a":1},\n{"a":2}\n]']


def test_fields_are_checked():
    for fields in ([], ["nope"]):
        with pytest.raises(ValueError):
            fmt.json_line(fields)
    with pytest.raises(ValueError):
        fmt.json_line(["key", "value"], envelope=False)


def test_header_map_last_wins(records):
    assert lines(records, fmt.header_map(F.col("headers"))) == [
        {"h1": "a", "h2": "b"}, {}, {"h1": "c"},
    ]


def test_header_types(spark):
    df = spark.createDataFrame([(0, ["STRING", "STRING"]), (1, []), (2, ["STRING", "INT"])], "offset bigint, types array<string>")
    assert lines(df, fmt.check_header_types(F.col("types"))) == [True, True, False]
    assert fmt.require_header_types(df.filter("offset < 2"), "types").count() == 2
    with pytest.raises(PySparkException, match="share one type"):
        fmt.require_header_types(df, "types").collect()


def test_envelope_columns(records):
    row = fmt.envelope_columns(records, ["key", "offset", "timestamp", "headers"]).filter("offset = 12").first()
    assert row.asDict() == {"key": "ké,y", "offset": 12, "timestamp": 1005, "headers": {"h1": "c"}}


def test_unwrap(spark, records):
    structs = spark.sql("select 0L as offset, named_struct('a', 1, 'b', 'x') as value")
    assert fmt.unwrap(structs, "value").first().asDict() == {"a": 1, "b": "x"}
    assert fmt.unwrap(records, "timestamp").columns == ["timestamp"]
    maps = spark.sql("select * from values (0L, map('a', 1)), (1L, map('b', 2, 'a', 3)) t(offset, value)")
    first = fmt.first_record_keys(maps, "offset")
    assert first == ["a"]
    loose = fmt.unwrap(maps, "value", "offset", map_keys=first, strict=False).orderBy("offset")
    assert [r.asDict() for r in loose.collect()] == [{"offset": 0, "a": 1}, {"offset": 1, "a": 3}]
    with pytest.raises(PySparkException, match="no column for b"):
        fmt.unwrap(maps, "value", map_keys=first).collect()
    whole = fmt.unwrap(maps, "value", "offset", map_keys=["a", "b"]).orderBy("offset")
    assert [tuple(r) for r in whole.collect()] == [(0, 1, None), (1, 3, 2)]
    assert lines(maps, fmt.unknown_keys(maps, first)) == [[], ["b"]]
