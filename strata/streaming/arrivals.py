"""File arrival as a stream: new files wake the ingest when they have been quiet long enough.

The file source hands over a path once, when it first sees it. From then on the path is state of its own: a timer looks
at the file again until it has not changed for the quiet period, and only then lets it go. No batch waits for that,
and a file that still grows is not lost to the stream. Which files are loaded is decided by the ledger. A
file rewritten in place after it was loaded is left to the next batch run.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strata.operators.ingest import Loaded, ingest
from strata.session import scratch_dir
from strata.sources.feeds import Feed
from strata.sources.landing import look_at
from strata.sources.target import Target

# Seconds between two runs, and without a change before a file counts as whole.
MIN_SECONDS_BETWEEN_RUNS = 60
QUIET_SECONDS = 90
_ARRIVED = "path string, _file_path string, _file_last_modified timestamp, length bigint"


def quiet_files(arrived: DataFrame, quiet_seconds: int) -> DataFrame:
    """Each arrived file once, as soon as it has been quiet for so long; one that is removed before never comes out."""

    def look(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        path, uri = key
        for _ in frames:
            pass
        found = look_at(uri)
        if found is None:
            if state.exists:
                state.remove()
            return
        changed, size = found
        wait = quiet_seconds - (time.time() - changed)
        if wait <= 0:
            if state.exists:
                state.remove()
            when = datetime.fromtimestamp(changed, timezone.utc)
            yield pd.DataFrame({"path": [path], "_file_path": [uri], "_file_last_modified": [when], "length": [size]})
        else:
            state.update((size,))
            state.setTimeoutDuration(max(1, int(min(wait, quiet_seconds) * 1_000)))

    return arrived.groupBy("path", "_file_path").applyInPandasWithState(
        look, _ARRIVED, "size bigint", "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def _arrivals(target: Target, feed: Feed, landing: str):
    return (
        target.spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", feed.glob)
        .load(f"{landing.rstrip('/')}/{feed.name}")
        .select(
            "path",
            F.col("_metadata.file_path").alias("_file_path"),
            F.col("modificationTime").alias("_file_last_modified"),
            "length",
        )
    )


def watch(
    target: Target,
    feed: Feed,
    landing: str,
    checkpoint: str,
    *,
    quiet_seconds: int = QUIET_SECONDS,
    every_seconds: int | None = None,
) -> StreamingQuery:
    """Start the arrival stream: until stopped with ``every_seconds``, else once through.

    One query runs one micro-batch at a time, so runs never overlap. Once through, no timer can fire: files too
    young are left to the next batch run.
    """

    def run(arrived: DataFrame, _epoch: int) -> None:
        # The rows come out of state, so they are taken once; what is read again is their copy.
        place = scratch_dir(target.spark, "arrived")
        arrived.write.parquet(place)
        files = target.spark.read.schema(_ARRIVED).parquet(place)
        if not files.isEmpty():
            ingest(target, feed, landing, quiet_seconds=0 if every_seconds else quiet_seconds, files=files)

    files = _arrivals(target, feed, landing)
    if every_seconds:
        files = quiet_files(files, quiet_seconds)
    writer = files.writeStream.option("checkpointLocation", f"{checkpoint}/{feed.table}").foreachBatch(run)
    if every_seconds:
        return writer.trigger(processingTime=f"{every_seconds} seconds").start()
    return writer.trigger(availableNow=True).start()


def catch_up(target: Target, feed: Feed, landing: str, checkpoint: str, quiet_seconds: int = 0) -> Loaded:
    """Drain what arrived, then let the ledger pick up what a stream cannot see.

    Without new paths the stream runs no micro-batch at all, so the last word is a plain
    batch run: it loads rewritten files and files that were too young before.
    """
    watch(target, feed, landing, checkpoint, quiet_seconds=quiet_seconds).awaitTermination()
    return ingest(target, feed, landing, quiet_seconds=quiet_seconds)
