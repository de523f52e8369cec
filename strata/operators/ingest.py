"""Bronze: each delivered file is loaded once, 1:1, typed, with provenance.

A file is identified by path AND modification time. What was seen is kept in a small
ledger table, not looked up in bronze, so a run costs in proportion to the files that
are new, and a file without rows is remembered as well. The ledger is partitioned by the month of the business
date in the path; a run reads the months it has files of.

A run first writes what it is going to load into the ledger, with a batch number per
file, then loads batch after batch. A batch is a partition of the bronze table: loading
it again replaces it. The build log records finished batches. A run that died is
therefore completed by the next one, with no row lost and none loaded twice.

Bronze rows, ledger and log of a feed belong to one generation. The view that carries the feed's name says which
generation counts, so a full refresh, which fills a new one, publishes all three in one step.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import path_date
from strata.sources.feeds import PROVENANCE, RESCUED, Feed
from strata.sources.landing import landing_files, literal_path, read_landing, same_version, settled
from strata.sources.target import BATCH, Target

LEDGER = "file_ledger"
# How the log names an append and a rewrite.
APPEND, REPLACE = "WRITE", "CREATE OR REPLACE"
LOG = "build_log"  # one per table, so that feeds may be loaded side by side
# Bounds the path list one read is given; more files than this make more batches.
FILES_PER_BATCH = 20_000

# Parts of one month in the ledger before a run puts them together.
PARTS_PER_MONTH = 16

# ``part`` is the batch of rows that wait to be loaded or were loaded lately; negative parts hold older ones together.
_LEDGER_SCHEMA = (
    "path string, _file_path string, _file_last_modified timestamp, length bigint, listed_at timestamp, batch bigint"
)
_LEDGER_PARTITIONS = {"file_month": "date", "part": "bigint"}
_LOG_SCHEMA = "table_name string, version bigint, operation string, logged_at timestamp, batch bigint"


@dataclass(frozen=True)
class Loaded:
    """What one run did."""

    files: int
    batches: int


@dataclass(frozen=True)
class Generation:
    """The stored tables of a feed that take effect together."""

    target: Target
    feed: Feed
    number: int

    @property
    def rows(self) -> str:
        return self.target.stored(self.feed.table, self.number)

    @property
    def ledger(self) -> str:
        return self.target.stored(f"{LEDGER}_{self.feed.table}", self.number)

    @property
    def log(self) -> str:
        return self.target.stored(f"{LOG}_{self.feed.table}", self.number)

    def create(self) -> Generation:
        schema = lambda text: T._parse_datatype_string(text)
        self.target.create("governance", self.log, schema(_LOG_SCHEMA), {})
        self.target.create("governance", self.ledger, schema(_LEDGER_SCHEMA), _LEDGER_PARTITIONS)
        self.target.create("bronze", self.rows, _bronze_schema(self.target, self.feed), {BATCH: "bigint"})
        return self

    def publish(self) -> None:
        self.target.publish("bronze", self.feed.table, self.number)


def current(target: Target, feed: Feed) -> Generation | None:
    number = target.generation("bronze", feed.table)
    return None if number is None else Generation(target, feed, number)


def _sweep(target: Target, feed: Feed, keep: int | None) -> None:
    """Drop generations of a feed that a dead run left, or that a refresh replaced."""
    for layer, table in (
        ("bronze", feed.table), ("governance", f"{LEDGER}_{feed.table}"), ("governance", f"{LOG}_{feed.table}")
    ):
        target.sweep(layer, table, keep)


def _next(target: Target, feed: Feed) -> Generation:
    tables = (("bronze", feed.table), ("governance", f"{LEDGER}_{feed.table}"), ("governance", f"{LOG}_{feed.table}"))
    return Generation(target, feed, max(target.next_generation(*t) for t in tables))


def unloaded(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose (path, mtime) is not in the ledger. NULLs in the ledger match nothing."""
    return files.join(ledger, same_version(files, ledger), "left_anti")


def ledger(target: Target, feed: Feed) -> DataFrame:
    store = current(target, feed)
    if store is None:
        return target.spark.createDataFrame([], f"{_LEDGER_SCHEMA}, file_month date, part bigint")
    return target.table("governance", store.ledger)


def build_log(target: Target, table: str) -> DataFrame:
    """Commits of one table: version, operation, time and, for bronze, the batch."""
    generation = target.generation("bronze", table)
    name = f"{LOG}_{table}" if generation is None else target.stored(f"{LOG}_{table}", generation)
    if not target.exists("governance", name):
        return target.spark.createDataFrame([], _LOG_SCHEMA)
    return target.table("governance", name)


def _entry(log: DataFrame, table: str, operation: str, batch: int | None) -> DataFrame:
    last = log.agg(F.coalesce(F.max("version") + 1, F.lit(0)).alias("version"))
    return last.select(
        F.lit(table).alias("table_name"),
        F.col("version").cast("bigint"),
        F.lit(operation).alias("operation"),
        F.current_timestamp().alias("logged_at"),
        F.lit(batch).cast("bigint").alias("batch"),
    )


def log_build(target: Target, table: str, operation: str, batch: int | None = None) -> None:
    """Record a build of a table above bronze."""
    entry = _entry(build_log(target, table), table, operation, batch)
    entry.write.mode("append").saveAsTable(target.name("governance", f"{LOG}_{table}"))


def log_batch(store: Generation, operation: str, batch: int) -> None:
    """Record that a batch is complete."""
    log = store.target.table("governance", store.log)
    store.target.append("governance", store.log, _entry(log, store.feed.table, operation, batch))


def _commits(store: Generation) -> DataFrame:
    return store.target.table("governance", store.log).where("batch IS NOT NULL").select("batch")


def _unfinished(store: Generation) -> list[int]:
    """Batches in the ledger with no commit in the log: planned now, or left by a dead run."""
    planned = store.target.table("governance", store.ledger).where("part >= 0").select(F.col("part").alias("batch"))
    todo = planned.distinct().join(_commits(store), "batch", "left_anti")
    return sorted(r.batch for r in todo.collect())


def _of_months(files: DataFrame, column: Column) -> Column:
    """Whether ``column`` is one of the months of some files. There are few of them, however many the files."""
    dates = [r.file_month for r in files.select("file_month").distinct().collect()]
    known = [d for d in dates if d is not None]
    return column.isin(known) | column.isNull() if None in dates else column.isin(known)


def _plan(store: Generation, files: DataFrame, per_batch: int, listed_at: datetime) -> int:
    """Write the new files to the ledger with their batch numbers; returns how many."""
    files = files.withColumn("file_month", F.trunc(path_date(F.col("_file_path"), store.feed.date_pattern), "month"))
    seen = store.target.table("governance", store.ledger)
    new = unloaded(files, seen.where(_of_months(files, F.col("file_month"))))
    count = new.count()
    if not count:
        return 0
    numbers = seen.where("part >= 0").select(F.col("part").alias("batch")).unionByName(_commits(store))
    base = numbers.agg(F.coalesce(F.max("batch") + 1, F.lit(0))).first()[0]
    spread = F.pmod(F.xxhash64("_file_path"), F.lit(-(-count // per_batch)))
    batch = (F.lit(base) + spread).cast("bigint")
    numbered = new.select(
        "path",
        "_file_path",
        "_file_last_modified",
        "length",
        F.lit(listed_at).cast("timestamp").alias("listed_at"),
        batch.alias("batch"),
        "file_month",
        batch.alias("part"),
    )
    store.target.append("governance", store.ledger, numbered.hint("rebalance", "file_month", "part"))
    return count


def _load(store: Generation, batch: int, operation: str) -> None:
    target, feed = store.target, store.feed
    planned = target.table("governance", store.ledger).where(F.col("part") == batch)
    paths = [literal_path(r.path) for r in planned.select("path").collect()]
    raw = read_landing(target.spark, feed, paths)
    # A file rewritten since it was listed is another version, which its own listing brings.
    versions = planned.select("_file_path", "_file_last_modified")
    as_listed = raw.join(versions, same_version(raw, versions), "left_semi")
    target.put_batch("bronze", store.rows, batch, feed.project(as_listed))
    log_batch(store, operation, batch)


def compact(store: Generation, parts: int = PARTS_PER_MONTH) -> list:
    """Put the finished parts of months that have many together; returns these months.

    The rows are first written once more, then the single parts are dropped. A run that dies between the two
    leaves rows twice, which say the same to the next run.
    """
    target = store.target
    rows = target.table("governance", store.ledger)
    done = rows.select("file_month", "part").distinct()
    done = done.join(_commits(store).select(F.col("batch").alias("part")).distinct(), "part", "left_semi").unionByName(
        done.where("part < 0")
    )
    many = done.groupBy("file_month").agg(F.collect_set("part").alias("parts"), F.min("part").alias("least"))
    many = many.where(F.size("parts") > parts).collect()
    if many:
        fresh = min(-1, min(r.least for r in many) - 1)
        chosen = target.spark.createDataFrame(
            [(r.file_month, p) for r in many for p in r.parts], "file_month date, part bigint"
        )
        same = rows["file_month"].eqNullSafe(chosen["file_month"]) & (rows["part"] == chosen["part"])
        together = rows.where(_of_months(chosen, F.col("file_month"))).join(F.broadcast(chosen), same, "left_semi")
        together = together.dropDuplicates(["_file_path", "_file_last_modified"]).withColumn("part", F.lit(fresh).cast("bigint"))
        name = target.name("governance", store.ledger)
        target.append("governance", store.ledger, together.hint("rebalance", "file_month"))
        drop = lambda d: "NULL" if d is None else f"DATE'{d}'"
        for r in many:
            for part in r.parts:
                target.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (file_month = {drop(r.file_month)}, part = {part})")
    return [r.file_month for r in many]


def _bronze_schema(target: Target, feed: Feed) -> T.StructType:
    provenance = {
        "_file_size": "bigint",
        "_file_last_modified": "timestamp",
        "_file_date": "date",
        "_processed_timestamp": "timestamp",
    }
    columns = [f"`{n}` {t}" for n, t in feed.columns]
    columns += [f"`{n}` {provenance.get(n, 'string')}" for n in (*PROVENANCE, RESCUED)]
    return target.spark.createDataFrame([], ", ".join(columns)).schema


def ingest(
    target: Target,
    feed: Feed,
    landing: str,
    *,
    full_refresh: bool = False,
    quiet_seconds: int = 0,
    files_per_batch: int = FILES_PER_BATCH,
    files: DataFrame | None = None,
) -> Loaded:
    """Load the files of a feed that were not loaded yet. One writer per table at a time.

    ``files`` names the candidates (path, _file_path, _file_last_modified, length) instead of a listing. A full
    refresh fills a generation of its own, which is published when it is complete.
    """
    if not 0 < files_per_batch <= FILES_PER_BATCH:
        raise ValueError(f"files_per_batch is 1 to {FILES_PER_BATCH}")
    store = current(target, feed)
    _sweep(target, feed, store.number if store else None)
    if full_refresh:
        store, earlier, operation = _refreshing(target, feed, store), store, REPLACE
    elif store is None:
        store, earlier, operation = _next(target, feed).create(), None, APPEND
        store.publish()
    else:
        earlier, operation = store, APPEND
    listed_at = datetime.now(timezone.utc)
    if files is None:
        files = landing_files(target.spark, f"{landing.rstrip('/')}/{feed.name}", feed.glob)
    # An object without a byte holds nothing yet; when it grows it has another time.
    files = settled(files.where("length > 0"), F.lit(listed_at).cast("timestamp"), quiet_seconds)
    planned = _plan(store, files, files_per_batch, listed_at)
    todo = _unfinished(store)
    for batch in todo:
        _load(store, batch, operation)
    if todo:
        compact(store)
    if store != earlier or target.table("bronze", store.rows).columns != target.table("bronze", feed.table).columns:
        store.publish()
    return Loaded(planned, len(todo))


def _refreshing(target: Target, feed: Feed, earlier: Generation | None) -> Generation:
    """A generation that nobody sees yet, with the log of the one before.

    New batches get numbers behind all that were used, so that what was built from older ones can tell.
    """
    store = _next(target, feed).create()
    if earlier is not None:
        target.append("governance", store.log, target.table("governance", earlier.log).coalesce(1))
    return store


def bronze(target: Target, feed: Feed, after_batch: int | None = None) -> DataFrame:
    """A feed's bronze rows as delivered, without the storage partition column.

    ``after_batch`` leaves out earlier batches; their partitions are not even listed.
    """
    rows = target.table("bronze", feed.table)
    if after_batch is not None:
        rows = rows.filter(F.col(BATCH) > after_batch)
    return rows.drop(BATCH)


def newest_batch(target: Target, feed: Feed, moment: datetime) -> int:
    """The last batch that was complete at ``moment``, -1 before the first.

    Batches are completed in the order of their numbers. A refresh replaced all batches before it, so what was there earlier
    cannot be read any more.
    """
    log = build_log(target, feed.table).where("batch IS NOT NULL")
    found = log.agg(
        F.max(F.when(F.col("logged_at") <= F.lit(moment), F.col("batch"))).alias("newest"),
        F.max(F.when(F.col("operation") == REPLACE, F.col("batch"))).alias("first_kept"),
    ).first()
    newest = -1 if found.newest is None else found.newest
    if found.first_kept is not None and newest < found.first_kept:
        raise RewrittenSince(f"{feed.table} was loaded anew after {moment}")
    return newest


class RewrittenSince(ValueError):
    """The moment asked for lies before the last full refresh."""


def as_of_batches(target: Target, feed: Feed, moment: datetime) -> DataFrame:
    """Bronze rows as of a moment: the batches complete by then; no other partition is read."""
    rows = target.table("bronze", feed.table)
    return rows.filter(F.col(BATCH) <= newest_batch(target, feed, moment)).drop(BATCH)


@dataclass(frozen=True)
class Progress:
    """How far a table built from a feed has come."""

    last: int | None  # newest batch of the feed
    merged: int | None  # newest batch the built table holds; None: build it from all rows


def progress(target: Target, feed: Feed, table: str) -> Progress:
    """Compare the commits of a feed with what a table built from it recorded."""
    commits = build_log(target, feed.table)
    last = commits.agg(F.max("batch")).first()[0]
    if not target.exists("silver", table):
        return Progress(last, None)
    merged = target.properties("silver", table).get("merged")
    if merged is None:
        return Progress(last, None)
    merged = int(merged)
    restarted = commits.filter((F.col("batch") > merged) & (F.col("operation") == REPLACE)).limit(1).count()
    return Progress(last, None if restarted else merged)
