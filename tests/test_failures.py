"""Tasks that are lost and run again, in a session of their own that allows it."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import os, sys
from pyspark import TaskContext
from pyspark.sql import functions as F
from sluice.operators.grouping import group_records, placed_width
from sluice.session import local_session
from sluice.sinks import files

out = sys.argv[1]
spark = local_session("2,4", shuffle_partitions=3)

def flaky(name):
    plain = getattr(files, name)
    def task_of(*args):
        task = plain(*args)
        def lost_once(batches):
            seen = 0
            for result in task(batches):
                seen += 1
                yield result
            # The work is done, and then the executor is lost.
            if seen and TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("executor lost")
        return lost_once
    setattr(files, name, task_of)

for name in ("_text_stage", "_placer", "_finisher"):
    flaky(name)

rows = spark.range(1000).select(
    F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
    F.lit("k").alias("key"), F.col("id").cast("string").alias("value"),
    F.lit(0).cast("bigint").alias("timestamp_ms"),
)
template = "{{topic}}-{{partition}}-{{start_offset}}"
limited = group_records(rows, template, max_records=90, slice_width=64)
width = placed_width(template, max_records=90, slice_width=64)
how = {"fields": ["value"], "value_encoding": "none"}
files.write_files(limited, out + "/limited", "csv", placed=width, **how).collect()
whole = group_records(rows, template)
files.write_files(whole, out + "/whole", "csv", compression="gzip", part_offsets=77, **how).collect()
spark.stop()
"""


def test_lost_tasks_leave_the_same_files(tmp_path):
    import gzip

    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path)],
        env={**os.environ, "PYTHONPATH": ROOT},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert "executor lost" in done.stderr
    names = sorted(n for n in os.listdir(tmp_path / "limited") if not n.startswith((".", "_")))
    assert names == sorted(f"t-0-{i}" for i in range(0, 1000, 90))
    for i in range(0, 1000, 90):
        text = (tmp_path / "limited" / f"t-0-{i}").read_text()
        assert text.split("\n") == [str(o) for o in range(i, min(i + 90, 1000))]
    with gzip.open(tmp_path / "whole" / "t-0-0", "rt") as whole:
        assert whole.read().split("\n") == [str(o) for o in range(1000)]
