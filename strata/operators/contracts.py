"""Delivery contracts: what the sidecars declare against what arrived and was loaded.

Every function returns the failing rows. Comparisons are three-valued, so each NULL that
must fail has a branch of its own.

Files are matched by directory and name, since one name may be delivered on several
dates. ``by_name=True`` matches on the bare name instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import directory
from strata.sources.feeds import RESCUED, Feed

# The reasons a report gives.
UNDECLARED = "delivered, but no .ctrl declares it"
MISSING = "declared by a .ctrl, but not on disk"
NO_SIDECAR = "bronze rows with no .ctrl"
NULL_COUNT = "declared count is NULL"
COUNT_DIFFERS = "declared <> loaded"
# Additions: one file declared more than once, alike or not.
REPEATED = "declared more than once"
CONTRADICTED = "declared with different counts"


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _place(by_name: bool):
    return F.lit("").alias("directory") if by_name else directory(F.col("_file_path")).alias("directory")


def presence(files: DataFrame, sidecars: Sequence[DataFrame], by_name: bool = False) -> DataFrame:
    """Files nobody declared and declared files that are not there, in one join.

    Both sides are reduced to distinct files first, so no name can multiply another.
    """
    delivered = files.select(_place(by_name), "file_name").distinct()
    declared = _union([s.select(_place(by_name), "file_name") for s in sidecars]).distinct()
    key = ["directory", "file_name"]
    both = delivered.withColumn("on_disk", F.lit(True)).join(
        declared.withColumn("in_sidecar", F.lit(True)), key, "full_outer"
    )
    reason = F.when(F.col("in_sidecar").isNull(), UNDECLARED).when(F.col("on_disk").isNull(), MISSING)
    return both.select(*key, reason.alias("reason")).filter(F.col("reason").isNotNull())


def record_counts(model: str, sidecar: DataFrame, bronze: DataFrame, by_name: bool = False) -> DataFrame:
    """Declared row counts against loaded ones, in both directions, one row per file at most."""
    declared = (
        sidecar.select(_place(by_name), "file_name", "record_count")
        .groupBy("directory", "file_name")
        .agg(
            F.min("record_count").alias("declared"),
            F.max("record_count").alias("most"),
            F.count(F.lit(1)).alias("times"),
            F.count_if(F.col("record_count").isNull()).alias("unsaid"),
        )
        .withColumn("in_sidecar", F.lit(True))
    )
    # Rows are counted per file as it stands; its directory is worked out once per file.
    per_file = bronze.groupBy(*([] if by_name else ["_file_path"]), "_file_name").agg(F.count(F.lit(1)).alias("loaded"))
    loaded = per_file.select(_place(by_name), F.col("_file_name").alias("file_name"), "loaded")
    reason = (
        F.when(F.col("in_sidecar").isNull(), NO_SIDECAR)
        .when(F.col("unsaid") > 0, NULL_COUNT)
        .when(F.col("declared") != F.col("most"), CONTRADICTED)
        .when(F.col("times") > 1, REPEATED)
        .when(F.coalesce("loaded", F.lit(0)) != F.col("declared"), COUNT_DIFFERS)
    )
    return (
        declared.join(loaded, ["directory", "file_name"], "full_outer")
        .select(
            F.lit(model).alias("model"),
            "directory",
            "file_name",
            "declared",
            "loaded",
            reason.alias("reason"),
        )
        .filter(F.col("reason").isNotNull())
    )


def digests(actual: DataFrame, sidecars: Sequence[DataFrame]) -> DataFrame:
    """Declared md5 against the bytes on disk; a missing declaration fails too.

    A file that is absent is the business of ``presence``.
    """
    declared = _union(
        [s.select(_place(False), "file_name", F.lower("md5").alias("declared_md5")) for s in sidecars]
    )
    on_disk = actual.select(_place(False), "file_name", F.lower("actual_md5").alias("actual_md5"))
    both = declared.join(on_disk, ["directory", "file_name"])
    wrong = F.col("declared_md5").isNull() | (F.col("declared_md5") != F.col("actual_md5"))
    return both.filter(wrong)


def rescued(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows that did not fit the declared shape. Ask the stored table: a pruned scan cannot tell."""
    return _union(
        [
            rows.filter(F.col(RESCUED).isNotNull()).select(F.lit(name).alias("model"), "_file_name", RESCUED)
            for name, rows in tables.items()
        ]
    )


def disagreeing(check: str, rows: DataFrame, left: str, right: str, op: str = "<>") -> DataFrame:
    """Rows where two columns that state the same thing differ; a NULL on either side passes."""
    return rows.filter(F.expr(f"{left} {op} {right}")).select(
        F.lit(check).alias("check_name"),
        "_file_name",
        F.expr(left).cast("string").alias("a"),
        F.expr(right).cast("string").alias("b"),
    )


def headers(lines: DataFrame, feed: Feed) -> DataFrame:
    """Files whose first line does not name the declared columns in the declared order.

    The declared schema binds by position, so a reorder of same-typed columns shows up
    only here. Addition: the original describes this check without having it.
    """
    expected = ",".join(feed.column_names)
    return lines.filter(F.col("header") != expected).select(
        "file_name", "header", F.lit(expected).alias("expected")
    )
