"""Stored states of progress."""

import os

from sluice.sources.progress import load_progress, store_progress


def state(spark, n):
    return spark.createDataFrame([("a", n)], "object_key string, record_count bigint")


def test_two_states_are_kept(spark, tmp_path):
    path = f"{tmp_path}/progress"
    assert load_progress(spark, path).count() == 0
    for n in range(1, 5):
        store_progress(state(spark, n), path)
        assert load_progress(spark, path).first()["record_count"] == n
    assert sorted(x for x in os.listdir(path) if not x.endswith(".whole")) == ["state-000000000003", "state-000000000004"]


def test_states_without_spark_marks_count(spark, tmp_path):
    key = "spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs"
    name = key.removeprefix("spark.hadoop.")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = f"{tmp_path}/progress"
    conf.set(name, "false")
    try:
        store_progress(state(spark, 7), path)
    finally:
        conf.unset(name)
    assert not os.path.exists(f"{path}/state-000000000001/_SUCCESS")
    assert load_progress(spark, path).first()["record_count"] == 7


def test_an_unfinished_state_does_not_count(spark, tmp_path):
    path = f"{tmp_path}/progress"
    store_progress(state(spark, 1), path)
    os.makedirs(f"{path}/state-000000000002/_temporary")
    assert load_progress(spark, path).first()["record_count"] == 1
    store_progress(state(spark, 2), path)
    assert load_progress(spark, path).first()["record_count"] == 2


def test_states_marked_by_spark_alone_count(spark, tmp_path):
    path = f"{tmp_path}/progress"
    state(spark, 9).write.parquet(f"{path}/state-000000000005")
    assert load_progress(spark, path).first()["record_count"] == 9
