"""Silver: one current row per key. May select, filter and window; never joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# What makes a delivered row more recent than another, most significant
# first. The processing time is equal for all rows of one build, so the file's own time
# has to come before it; the path makes the order total.
RECENCY = ("snapshot_date", "_file_last_modified", "_processed_timestamp", "_file_path")


def current_rows(
    rows: DataFrame, key: str | Sequence[str], recency: Sequence[str] = RECENCY
) -> DataFrame:
    """The most recent row of every key.

    Spark turns the rank filter into a per-task limit before the shuffle, so a task sends
    at most one row per key, however many rows one key has.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in recency])
    ranked = rows.withColumn("_recency", F.row_number().over(order))
    return ranked.filter(F.col("_recency") == 1).drop("_recency")


def merge_current(
    current: DataFrame, fresh: DataFrame, key: str | Sequence[str], recency: Sequence[str] = RECENCY
) -> DataFrame:
    """Current rows after fresh ones arrived.

    The most recent of all rows is the most recent of the earlier winner and the fresh rows,
    so history does not have to be read again. Holds as long as rows are only ever added.
    """
    return current_rows(current.unionByName(fresh.select(*current.columns)), key, recency)
