"""What several operators share: tables read and kept, salted groups, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a table below the cluster's shared folder and reads it back.

    It cuts lineage: a lost executor costs the tasks it ran, nothing before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ready(df: DataFrame) -> SparkSession:
    """The session, with this package importable in its Python workers."""
    ship_package(df.sparkSession)
    return df.sparkSession


def held_out(id_col: str | Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id is not held out."""
    crc = F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """``node, component`` (the smallest node reachable) for the nodes of ``a, b``.

    Large-star and small-star in turn: every node hands its smallest neighbour
    to its other neighbours, so the number of rounds grows with the logarithm
    of the longest chain. Minima are partial aggregates and the joins are
    plain equi-joins, so a hub is neither collected nor kept in one task.
    """
    links = keep(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    for _ in range(rounds):
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            both.where("v > u")
            .join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        large = keep(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        links = keep(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
        # Stars are done: each node has one link, and none links to a node that has one.
        ends = links.groupBy("u").agg(F.count("*").alias("n"))
        chained = links.select(F.col("v").alias("u")).join(links.select("u"), "u", "left_semi")
        if ends.where("n > 1").isEmpty() and chained.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    centres = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        centres.select("node", F.col("node").alias("component"))
    )
