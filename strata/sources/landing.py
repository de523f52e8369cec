"""The landing zone: delivered CSV files and their control sidecars."""

from __future__ import annotations

import csv
import fnmatch
import hashlib
import re
import uuid
from collections import deque
from collections.abc import Iterator
from functools import partial, reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import decoded, path_date
from strata.session import scratch_dir
from strata.sources.feeds import RESCUED, Feed

_CHUNK = 4 * 1024 * 1024
# The longest first line that is taken for a header; a file without a line break in it has none.
HEADER_BYTES = 1024 * 1024


def provenance(date_pattern: str) -> list[Column]:
    meta = F.col("_metadata")
    return [
        meta["file_path"].alias("_file_path"),
        decoded(meta["file_name"]).alias("_file_name"),
        meta["file_size"].alias("_file_size"),
        meta["file_modification_time"].alias("_file_last_modified"),
        path_date(meta["file_path"], date_pattern).alias("_file_date"),
        F.current_timestamp().alias("_processed_timestamp"),
    ]


def literal_path(path: str) -> str:
    """The reader expands glob characters; a delivered name may contain them."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def read_landing(spark: SparkSession, feed: Feed, paths: str | list[str]) -> DataFrame:
    """Delivered rows as text with provenance. The declared schema binds by position.

    Column pruning is off: pruned in the parser, a row that does not fit the declared
    shape would no longer be noticed.
    """
    rows = (
        spark.read.schema(feed.raw_schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RESCUED)
        .option("columnPruning", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", feed.glob)
        .csv(paths)
    )
    return rows.select("*", *provenance(feed.date_pattern))


_LISTED = "path string, _file_path string, file_name string, _file_last_modified timestamp, length bigint, directory boolean"
# Entries a task lists before it hands the directories it has left back, to be spread over all tasks.
LISTED_PER_TASK = 10_000
# Characters that file metadata leaves as they are.
_PLAIN = "/+=,;@&$!()"


def _list(batches: Iterator[pa.RecordBatch], glob: str, per_task: int) -> Iterator[pa.RecordBatch]:
    """Work off directories: matching files come out, and the directories there was no room for."""
    from urllib.parse import quote

    from pyarrow import fs

    names = [n.split(" ")[0] for n in _LISTED.split(", ")]
    seen = 0
    for batch in batches:
        waiting = deque(zip(batch["path"].to_pylist(), batch["_file_path"].to_pylist()))
        while waiting:
            plain, uri = waiting.popleft()
            if seen > per_task:
                rows = [(plain, uri, "", None, 0, True)]
            else:
                filesystem, path = _open(uri)
                rows = []
                for info in filesystem.get_file_info(fs.FileSelector(path)):
                    seen += 1
                    name = info.base_name
                    if name[0] in "._":
                        continue
                    place = (f"{plain.rstrip('/')}/{name}", f"{uri.rstrip('/')}/{quote(name, safe=_PLAIN)}")
                    if info.type == fs.FileType.Directory:
                        waiting.append(place)
                    elif info.type == fs.FileType.File and fnmatch.fnmatchcase(name, glob):
                        # File metadata knows milliseconds.
                        rows.append((*place, name, info.mtime_ns // 1_000_000 * 1_000, info.size, False))
            if rows:
                types = [pa.string(), pa.string(), pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def landing_files(spark: SparkSession, root: str, glob: str = "*", per_task: int = LISTED_PER_TASK) -> DataFrame:
    """One row per delivered object below ``root``, at any depth, the empty ones included; no file is opened.

    Directories are a frontier that tasks work off until nothing is left of it. The driver knows the root and how
    many directories a round left over; what was found is in the shared scratch folder.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    # File metadata names local files with one slash.
    short = lambda text: re.sub(r"^file:/+", "file:/", text)
    start = (short(re.sub(r"^file:/+", "file:/", unquote(uri.toString()))), short(uri.toString()))
    frontier = spark.createDataFrame([start], "path string, _file_path string")
    rounds = []
    while True:
        listed = spread(frontier, "_file_path") if rounds else frontier
        place = scratch_dir(spark, "listing")
        listed.mapInArrow(partial(_list, glob=glob, per_task=per_task), _LISTED).write.parquet(place)
        found = spark.read.schema(_LISTED).parquet(place)
        rounds.append(found.where("NOT directory").drop("directory"))
        frontier = found.where("directory").select("path", "_file_path")
        if frontier.isEmpty():
            return reduce(DataFrame.unionByName, rounds)


def same_version(a: DataFrame, b: DataFrame) -> Column:
    """Whether two listings mean one version of a file: its path and its modification time.

    Some clients report whole seconds; such a time stands for any within the second.
    """
    one, other = a["_file_last_modified"], b["_file_last_modified"]
    second = lambda t: F.date_trunc("second", t)
    return (
        (a["_file_path"] == b["_file_path"])
        & (second(one) == second(other))
        & ((one == other) | (one == second(one)) | (other == second(other)))
    )


def settled(files: DataFrame, as_of: Column, quiet_seconds: int) -> DataFrame:
    """Files unchanged for ``quiet_seconds`` before ``as_of``; younger ones may still be growing."""
    cutoff = as_of - F.make_interval(secs=F.lit(quiet_seconds).cast("decimal(18,6)"))
    return files.filter(F.col("_file_last_modified") <= cutoff)


def _open(uri: str):
    """Filesystem and path of a file as Spark names it (percent-encoded URI)."""
    from pyarrow import fs

    if "://" not in uri:
        uri = re.sub(r"^file:/+", "file:///", uri if uri.startswith("file:") else f"file:{uri}")
    return fs.FileSystem.from_uri(uri)


def look_at(uri: str) -> tuple[float, int] | None:
    """Modification time (seconds, to the millisecond) and size of a file as it is now; None if it is gone."""
    from pyarrow import fs

    filesystem, path = _open(uri)
    info = filesystem.get_file_info(path)
    return (info.mtime_ns // 1_000_000 / 1_000, info.size) if info.type == fs.FileType.File else None


def _stream_md5(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for uri in batch["_file_path"].to_pylist():
            filesystem, path = _open(uri)
            digest = hashlib.md5()
            with filesystem.open_input_stream(path) as stream:
                while chunk := stream.read(_CHUNK):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield batch.append_column("actual_md5", pa.array(digests, pa.string()))


def file_md5(files: DataFrame) -> DataFrame:
    """md5 of the named files, each read in chunks by the task that holds its row, whatever its size."""
    named = spread(files.select("_file_path", "file_name"), "_file_path")
    return named.mapInArrow(_stream_md5, "_file_path string, file_name string, actual_md5 string")


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = []
        for uri in batch["_file_path"].to_pylist():
            filesystem, path = _open(uri)
            with filesystem.open_input_stream(path) as stream:
                head = stream.read(4096)
                if b"\n" not in head:
                    head += stream.read(HEADER_BYTES - len(head))
            whole = b"\n" in head or len(head) < HEADER_BYTES
            line = head.split(b"\n", 1)[0].decode("utf-8", "replace").removeprefix("﻿").rstrip("\r")
            # Quoted names are the same names.
            names = next(csv.reader([line]), []) if whole else [f"no line break in {HEADER_BYTES} bytes"]
            lines.append(",".join(names))
        yield batch.append_column("header", pa.array(lines, pa.string()))


def header_lines(files: DataFrame) -> DataFrame:
    """Line 1 of every named file. Only the head of a file is read."""
    named = files.select("_file_path", "file_name")
    return named.mapInArrow(_first_line, "_file_path string, file_name string, header string")


def spread(names: DataFrame, column: str) -> DataFrame:
    """One row stands for much work: keep such rows apart.

    The number is given, since adaptive execution would merge partitions by their few bytes.
    """
    spark = names.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return names.repartition(max(shuffle, spark.sparkContext.defaultParallelism), column)


def deliver(
    rows: DataFrame,
    root: str,
    feed: Feed,
    business_date: Column,
    domain: str,
    sidecars: str = "ctl",
) -> str:
    """Write rows as dated CSV deliveries and declare each file in a sidecar.

    A call writes a folder of its own below the feed, and in it a ``delivered=<date>`` directory
    per date. The rebalance hint lets Spark split a date that holds most of the rows and merge
    the small ones. The sidecar is computed from what this call wrote: one row per file
    with its count and md5.
    """
    spark = rows.sparkSession
    target = f"{root.rstrip('/')}/{feed.name}/call-{uuid.uuid4().hex[:12]}"
    (
        rows.select(*feed.column_names, business_date.cast("date").alias("delivered"))
        .hint("rebalance", "delivered")
        .write.partitionBy("delivered")
        .option("header", True)
        .mode("append")
        .csv(target)
    )
    counts = (
        read_landing(spark, feed, target)
        .groupBy("_file_path")
        .agg(F.count(F.lit(1)).alias("record_count"), F.first("_file_date").alias("business_date"))
    )
    digests = file_md5(landing_files(spark, target, feed.glob))
    (
        digests.join(counts, "_file_path", "left")
        .select(
            "file_name",
            F.coalesce("record_count", F.lit(0)).alias("record_count"),
            F.col("actual_md5").alias("md5"),
            "business_date",
            F.lit(feed.name).alias("feed"),
            F.lit(domain).alias("domain"),
            path_date(F.col("_file_path"), feed.date_pattern).alias("delivered"),
        )
        .write.partitionBy("delivered")
        .option("header", True)
        .option("extension", sidecars)
        .mode("append")
        .csv(target)
    )
    return target
