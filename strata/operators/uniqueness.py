"""Uniqueness of keys over all batches, by looking at the new ones only.

Digests of the keys that were seen are kept by hash bucket and batch. A batch is checked against the buckets its keys
fall into, in one semi join; the rows of earlier batches are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.ingest import build_log
from strata.session import scratch_dir
from strata.sources.feeds import Feed
from strata.sources.target import BATCH, Target

BUCKETS = 64
_STORED = "digest binary"
_PARTITIONS = {"bucket": "int", "batch": "bigint"}


@dataclass(frozen=True)
class SeenKeys:
    """The digests of a table's keys. A NULL in a single key is no value; in a combination it is one like any other."""

    target: Target
    table: str
    columns: tuple[str, ...]
    buckets: int = BUCKETS

    @property
    def store(self) -> str:
        return f"seen_keys_{self.table}_{'_'.join(self.columns)}".lower()

    def setup(self) -> SeenKeys:
        if not self.target.exists("governance", self.store):
            self.target.create("governance", self.store, T._parse_datatype_string(_STORED), _PARTITIONS)
        return self

    def _digest(self) -> Column:
        text = F.to_json(F.struct(*self.columns), {"ignoreNullFields": "false"})
        return F.unhex(F.md5(text)).alias("digest")

    def _keys(self, rows: DataFrame) -> DataFrame:
        """Each key once, with how often it comes, its digest and its bucket."""
        keyed = rows.where(F.col(self.columns[0]).isNotNull()) if len(self.columns) == 1 else rows
        per_key = keyed.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("n"))
        return per_key.withColumn("digest", self._digest()).withColumn(
            "bucket", F.pmod(F.xxhash64("digest"), F.lit(self.buckets)).cast("int")
        )

    def seen(self, buckets: Sequence[int] | None = None, but: int | None = None) -> DataFrame:
        """(bucket, digest) of earlier batches, of all buckets or some."""
        rows = self.target.table("governance", self.store)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(list(buckets)))
        return (rows if but is None else rows.where(F.col("batch") != but)).select("bucket", "digest")

    def check(self, rows: DataFrame, batch: int) -> DataFrame:
        """(columns, n, loaded_before) of the batch's keys that come more than once in it, or came before."""
        keys = self._keys(rows)
        touched = sorted(r.bucket for r in keys.select("bucket").distinct().collect())  # as many as buckets at most
        before = self.seen(touched, but=batch).distinct().withColumn("loaded_before", F.lit(True))
        both = keys.join(before, ["bucket", "digest"], "left")
        return both.select(*self.columns, "n", F.coalesce("loaded_before", F.lit(False)).alias("loaded_before")).where(
            "n > 1 OR loaded_before"
        )

    def remember(self, rows: DataFrame, batch: int) -> None:
        """Keep the batch's digests. Doing it again replaces them."""
        self.forget([p for p in self.parts() if p[1] == batch])
        keys = self._keys(rows).select("digest", "bucket", F.lit(batch).cast("bigint").alias("batch"))
        self.target.append("governance", self.store, keys.hint("rebalance", "bucket"))

    def parts(self) -> list[tuple[int, int]]:
        """(bucket, batch) of all there is."""
        stored = self.target.table("governance", self.store).select("bucket", "batch").distinct()
        return [tuple(r) for r in stored.collect()]

    def forget(self, parts: Sequence[tuple[int, int]]) -> None:
        name = self.target.name("governance", self.store)
        for bucket, batch in parts:
            self.target.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (bucket = {bucket}, batch = {batch})")


def check_new_batches(target: Target, feed: Feed, columns: Sequence[str]) -> DataFrame:
    """Findings of ``SeenKeys.check`` in every bronze batch that was not looked at before, with the batch.

    After a full refresh the digests of the batches it replaced are dropped, and all new ones are looked at.
    """
    keys = SeenKeys(target, feed.table, tuple(columns)).setup()
    loaded = {r[0] for r in target.table("bronze", feed.table).select(BATCH).distinct().collect()}
    committed = {r.batch for r in build_log(target, feed.table).where("batch IS NOT NULL").select("batch").collect()}
    stored = keys.parts()
    keys.forget([p for p in stored if p[1] not in loaded])
    found = []
    for batch in sorted((loaded & committed) - {batch for _, batch in stored}):
        rows = target.table("bronze", feed.table).where(F.col(BATCH) == batch)
        place = scratch_dir(target.spark, "unique")
        keys.check(rows, batch).withColumn("batch", F.lit(batch).cast("bigint")).write.parquet(place)
        keys.remember(rows, batch)
        found.append(target.spark.read.parquet(place))
    if found:
        return reduce(DataFrame.unionByName, found)
    shape = target.table("bronze", feed.table).select(*columns)
    return target.spark.createDataFrame([], shape.schema).selectExpr(
        "*", "0L AS n", "false AS loaded_before", "0L AS batch"
    )
