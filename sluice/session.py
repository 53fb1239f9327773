"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sluice")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # A slice fits: windows need not copy their rows to a spillable buffer.
        .config("spark.sql.windowExec.buffer.in.memory.threshold", str(1 << 16))
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``.

    Only a local session may go without that setting; a machine-local folder
    would not be visible to the executors of a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="sluice-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in Python workers, once per application."""
    context = spark.sparkContext
    if getattr(context, "_sluice_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    package = os.path.basename(here)
    archive = os.path.join(tempfile.mkdtemp(prefix="sluice-"), f"{package}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(here):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join(package, os.path.relpath(full, here)))
    context.addPyFile(archive)
    context._sluice_shipped = True
