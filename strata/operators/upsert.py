"""Current rows kept by hash bucket of their key: a merge rewrites the buckets it touches.

The stored table is partitioned by bucket and version. Which version of each bucket counts is part of the view that
publishes the table, so a merge takes effect in one step, and readers of the versions before may finish.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.current import current_rows
from strata.sources.target import Target

BUCKET, VERSION = "_bucket", "_version"
# Fewest buckets of a table, and the rows that one is meant to hold in a large table.
LEAST_BUCKETS = 16
ROWS_PER_BUCKET = 1_000_000


@dataclass(frozen=True)
class Snapshot:
    """What a keyed table shows: its generation, and the version of every bucket that has rows."""

    generation: int
    buckets: int
    versions: Mapping[int, int]

    def note(self) -> str:
        """The snapshot as text: the buckets of each version."""
        held: dict[int, list[int]] = {}
        for bucket, version in sorted(self.versions.items()):
            held.setdefault(version, []).append(bucket)
        return json.dumps([self.generation, self.buckets, list(held.items())], separators=(",", ":"))

    @staticmethod
    def read(note: str) -> Snapshot:
        generation, buckets, held = json.loads(note)
        return Snapshot(generation, buckets, {b: v for v, of in held for b in of})


def _chosen(versions: Mapping[int, int]) -> str:
    held: dict[int, list[int]] = {}
    for bucket, version in versions.items():
        held.setdefault(version, []).append(bucket)
    parts = [f"({VERSION} = {v} AND {BUCKET} IN ({', '.join(map(str, sorted(of)))}))" for v, of in sorted(held.items())]
    return " OR ".join(parts) or "false"


def bucket_count(rows: int) -> int:
    return max(LEAST_BUCKETS, -(-rows // ROWS_PER_BUCKET))


@dataclass(frozen=True)
class Keyed:
    """A table with one current row per key."""

    target: Target
    layer: str
    table: str
    key: tuple[str, ...]
    recency: tuple[str, ...]

    def snapshot(self) -> Snapshot | None:
        note = self.target.properties(self.layer, self.table).get("snapshot")
        return None if note is None else Snapshot.read(note)

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(buckets)).cast("int")

    def _stored(self, generation: int) -> str:
        return self.target.stored(self.table, generation)

    def of(self, snapshot: Snapshot, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows a snapshot shows, of all its buckets or of some; no other partition is read."""
        wanted = snapshot.versions if buckets is None else {b: snapshot.versions[b] for b in buckets if b in snapshot.versions}
        rows = self.target.table(self.layer, self._stored(snapshot.generation))
        return rows.where(_chosen(wanted)).drop(BUCKET, VERSION)

    def _write(self, generation: int, rows: DataFrame, buckets: int, version: int) -> None:
        stamped = rows.withColumn(BUCKET, self._bucket(buckets)).withColumn(VERSION, F.lit(version).cast("bigint"))
        self.target.append(self.layer, self._stored(generation), stamped.hint("rebalance", BUCKET))

    def _publish(self, snapshot: Snapshot, notes: Mapping[str, str]) -> DataFrame:
        return self.target.publish(
            self.layer,
            self.table,
            snapshot.generation,
            {**notes, "snapshot": snapshot.note()},
            where=_chosen(snapshot.versions),
            leave_out=(BUCKET, VERSION),
        )

    def _buckets_of(self, rows: DataFrame, buckets: int) -> list[int]:
        """As many numbers as there are buckets at most."""
        return sorted(r.b for r in rows.select(self._bucket(buckets).alias("b")).distinct().collect())

    def start(self, rows: DataFrame, notes: Mapping[str, str], buckets: int) -> DataFrame:
        """A new generation from all rows there are, several per key or one."""
        self.target.sweep(self.layer, self.table, self.target.generation(self.layer, self.table))
        generation = self.target.next_generation(self.layer, self.table)
        schema = T.StructType([f for f in rows.schema if f.name not in (BUCKET, VERSION)])
        self.target.create(self.layer, self._stored(generation), schema, {BUCKET: "int", VERSION: "bigint"})
        self._write(generation, current_rows(rows, self.key, self.recency), buckets, 0)
        stored = self.target.table(self.layer, self._stored(generation))
        present = {r[0]: 0 for r in stored.select(BUCKET).distinct().collect()}
        return self._publish(Snapshot(generation, buckets, present), notes)

    def merge(self, fresh: DataFrame, notes: Mapping[str, str]) -> list[int]:
        """Take in further rows; returns the buckets that were rewritten.

        The most recent of all rows of a key is the most recent of the row that is there and the fresh
        ones. A merge that dies is not seen, and doing it again gives the same.
        """
        shown = self.snapshot()
        touched = self._buckets_of(fresh, shown.buckets)
        if touched:
            there = self.of(shown, touched)
            merged = current_rows(there.unionByName(fresh.select(*there.columns)), self.key, self.recency)
            # A number that no merge has used, not even one that died.
            stored = self.target.table(self.layer, self._stored(shown.generation)).select(VERSION).distinct().collect()
            version = max((r[0] for r in stored), default=-1) + 1
            self._write(shown.generation, merged, shown.buckets, version)
            shown = Snapshot(shown.generation, shown.buckets, {**shown.versions, **dict.fromkeys(touched, version)})
        self._publish(shown, notes)
        return touched

    def forget(self, needed: Sequence[Snapshot]) -> int:
        """Drop versions that none of the snapshots shows; returns how many partitions went."""
        shown = self.snapshot()
        keep = {(b, v) for s in needed if s.generation == shown.generation for b, v in s.versions.items()}
        name = self.target.name(self.layer, self._stored(shown.generation))
        stored = self.target.spark.table(name).select(BUCKET, VERSION).distinct().collect()
        gone = [tuple(r) for r in stored if tuple(r) not in keep]
        for bucket, version in gone:
            self.target.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({BUCKET} = {bucket}, {VERSION} = {version})")
        return len(gone)
