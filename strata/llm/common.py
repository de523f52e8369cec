"""What several operators share: reading, cutting lineage, connected components."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_dir

# Shuffle files of a finished step are of no use once its rows are in the shared folder.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(frame: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back.

    This cuts the lineage: losing an executor later repeats nothing from before this point.
    """
    spark = frame.sparkSession
    path, before = scratch_dir(spark, label), spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def own_column(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet, whatever the case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> str:
    return "`" + re.sub("`", "``", name) + "`"


def components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node it is connected to.

    ``edges`` has long columns (a, b). Alternating large-star and small-star rounds rewire
    every edge to the smallest known neighbour until nothing changes. The rows never exceed
    the edges there were, each round is one aggregation and one join on the node, and
    a node with very many neighbours meets a side with one row per node, which Spark's skew
    handling may split.
    """
    down = lambda a, b: (F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = keep(edges.where("a <> b").select(*down("a", "b")).distinct(), label)
    before = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        current = keep(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct(),
            label,
        )
        state = current.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, because a single text may be very long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > 512:
        spark.conf.set(key, "512")
