"""Layout and history: files, bytes and rows per table, operations per table, reads as of a time."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

# Commits that maintain a table rather than build it, and the commit of an append.
MAINTENANCE = (
    "OPTIMIZE",
    "VACUUM START",
    "VACUUM END",
    "RESTORE",
    "SET TBLPROPERTIES",
    "ADD COLUMNS",
    "CHANGE COLUMN",
)
APPEND = "WRITE"


def layout_profile(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> DataFrame:
    """(table_name, files, bytes, rows, error): what a scan of each table's rows says about its files.

    Tables are frames over files or the folders of Parquet tables. Rows carry the path and the size of their file, so one
    pass that reads no column counts all three; a file without rows does not show. An unmeasurable table stays in the report: it
    must not read as an empty one.
    """
    if not tables:
        raise ValueError("no tables to measure: wrong place, or no access to it")
    parts = []
    for name, place in tables.items():
        try:
            rows = spark.read.parquet(place) if isinstance(place, str) else place
            per_file = rows.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
            measured = per_file.agg(
                F.count(F.lit(1)).alias("files"),
                F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            )
            error = F.when(F.col("files") == 0, "no data files")
        except AnalysisException as failure:
            measured = spark.range(1).select(
                *[F.lit(None).cast("bigint").alias(c) for c in ("files", "bytes", "rows")]
            )
            error = F.lit(failure.getCondition() or "unreadable")
        parts.append(measured.select(F.lit(name).alias("table_name"), "files", "bytes", "rows", error.alias("error")))
    return reduce(DataFrame.unionByName, parts)


def totals(profile: DataFrame) -> DataFrame:
    """Overall files, bytes and rows; tables that could not be measured are counted apart."""
    good = F.col("error").isNull()
    return profile.agg(
        F.sum(F.when(good, F.col("files"))).alias("files"),
        F.sum(F.when(good, F.col("bytes"))).alias("bytes"),
        F.sum(F.when(good, F.col("rows"))).alias("rows"),
        F.count_if(~good).alias("unmeasured"),
    )


def operation_mix(log: DataFrame) -> DataFrame:
    """Commits per table and operation."""
    return log.groupBy("table_name", "operation").agg(F.count(F.lit(1)).alias("commits"))


def growth(log: DataFrame, maintenance=MAINTENANCE, append: str = APPEND) -> DataFrame:
    """Per table: versions, the oldest one, and whether the latest build was an append.

    Maintenance commits say nothing about how a table is built and are skipped. The
    latest build is the maximum of (version, operation), which tasks combine before the
    shuffle; no table's history is gathered or sorted in one place.
    """
    build = F.when(~F.col("operation").isin(*maintenance), F.struct("version", "operation"))
    per_table = log.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("versions"),
        F.min("version").alias("oldest_version"),
        F.max(build).alias("latest"),
    )
    return per_table.select(
        "table_name",
        "versions",
        "oldest_version",
        F.col("latest.operation").alias("last_build_op"),
        F.coalesce(F.col("latest.operation") == append, F.lit(False)).alias("accumulates_files"),
    )


def subset_of_today(rows: DataFrame, moment, at: str = "_processed_timestamp") -> DataFrame:
    """Rows reachable as of a moment and rows today, counted in one pass."""
    return rows.agg(
        F.count_if(F.col(at) <= F.lit(moment)).alias("rows_as_of"), F.count(F.lit(1)).alias("rows_today")
    ).withColumn("subset", F.col("rows_as_of") <= F.col("rows_today"))
