"""Exact dedup: counting quotient filters per partition, merged by sorted remainders, then byte verification.

Texts are equal when they are the same bytes after every run of ``[\\x20\\x09-\\x0D]`` became one space.

1. *Keys.* Each document gets a 64-bit fingerprint and the SHA-256 of its normalised text; these narrow rows are
   written to the shared folder.
2. *Filters.* Every task fills counting quotient filters with the fingerprints of its partition. A fingerprint is cut
   into a section (its leading bits), a quotient, which is the slot it wants, and a remainder, which is
   stored. Remainders of one quotient stand together in a sorted run; two bits per slot tell which quotients have a
   run and where runs end. A count above one takes further slots, marked by a third bit.
   Nothing is rounded: section, quotient and remainder give back the whole fingerprint, and counters are exact.
3. *Merge.* The filters of a section meet in one task and are merged by their sorted remainders; counts add up.
   The number of sections grows with the rows, so that a section holds about ``SECTION`` fingerprints however large the
   corpus is. A fingerprint held by a third of all rows is one entry per task.
4. *Routing.* Fingerprints with a count above one set a bit in a table of ``TABLE`` bits (16 MB, whatever the input), which
   every task gets. A document without its bit is single and its text goes nowhere.
5. *Verification.* The others are grouped by fingerprint and by the bytes of the text themselves, combined in each
   task before anything moves. Different texts with one fingerprint, or with one bit, end in different groups, so
   a full table costs time but no correctness.

Odd rows: a null text counts as empty. Of equal texts the row with the smallest doc_id stays, null ids
last; of several rows with that id exactly one stays. Repeated rows are members of their group like any other. Very
long texts are hashed and compared whole. An empty table gives no rows. Other columns do not matter and,
in ``deduplicate``, pass through under whatever names they have.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep, own_column, quoted

#: Fingerprints that one merged section is meant to hold; more rows make more sections.
SECTION = 1 << 22
#: Fingerprints that a task gathers before it closes its filters and begins new ones.
FILTER = 1 << 21
#: Part of the slots of a new filter that may be in use.
LOAD = 0.9
#: Bits of the table of repeated fingerprints.
TABLE = 1 << 27
#: Bits of a fingerprint. Fewer make more false matches for the verification, never a wrong result.
BITS = 64
_U = np.uint64
_HEAD = np.dtype([("quotient_bits", "<u1"), ("remainder_bits", "<u1"), ("slots", "<u8"), ("entries", "<u8")])


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _digits(counts: np.ndarray, base_bits: int) -> np.ndarray:
    """How many slots the counter of each entry takes: none for a count of one."""
    rest, n = counts.astype(_U) - _U(1), np.zeros(len(counts), np.int64)
    while (more := rest > 0).any():
        n += more
        rest = rest >> _U(base_bits) if base_bits < 64 else np.zeros_like(rest)
    return n


def encode(fingerprints: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """A counting quotient filter of sorted, distinct fingerprints of ``width`` bits with their counts."""
    fingerprints = fingerprints.astype(_U)
    n = len(fingerprints)
    q = min(width - 1, max(1, math.ceil(math.log2(max(2, n / LOAD)))))
    r = width - q
    if n:
        extra = _digits(counts, r)
        quotient = (fingerprints >> _U(r)).astype(np.int64)
        new = np.concatenate([[True], quotient[1:] != quotient[:-1]])
        first = np.flatnonzero(new)
        wanted, used = quotient[first], np.add.reduceat(1 + extra, first)
        # A run stands where its quotient wants it or right behind the run before.
        before = np.concatenate([[0], np.cumsum(used)[:-1]])
        start = before + np.maximum.accumulate(wanted - before)
        ends = start + used - 1
        taken = np.concatenate([[0], np.cumsum(1 + extra)[:-1]])
        run = np.cumsum(new) - 1
        at = start[run] + taken - taken[first][run]
        slots = max(1 << q, int(ends[-1]) + 1)
    else:
        slots = 1 << q
    occupied, run_end, counter = (np.zeros(size, np.uint8) for size in (1 << q, slots, slots))
    remainder = np.zeros(slots, _U)
    if n:
        mask = _U((1 << r) - 1)
        occupied[wanted], run_end[ends] = 1, 1
        remainder[at] = fingerprints & mask
        rest, place = counts.astype(_U) - _U(1), at.copy()
        for step in range(int(extra.max())):
            held = np.flatnonzero(extra > step)
            place[held] += 1
            remainder[place[held]], counter[place[held]] = rest[held] & mask, 1
            rest = rest >> _U(r)
    size = -(-r // 8)
    head = np.array([(q, r, slots, n)], _HEAD)
    stored = remainder.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]
    return b"".join(x.tobytes() for x in (head, np.packbits(occupied), np.packbits(run_end), np.packbits(counter), stored))


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of a filter in ascending order, and their counts."""
    q, r, slots, n = (int(x) for x in np.frombuffer(data, _HEAD, 1)[0])
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    at, bits = _HEAD.itemsize, []
    for size in (1 << q, slots, slots):
        held = -(-size // 8)
        bits.append(np.unpackbits(np.frombuffer(data, np.uint8, held, at), count=size))
        at += held
    wanted, ends = np.flatnonzero(bits[0]), np.flatnonzero(bits[1])
    size = -(-r // 8)
    wide = np.zeros((slots, 8), np.uint8)
    wide[:, :size] = np.frombuffer(data, np.uint8, slots * size, at).reshape(slots, size)
    remainder = wide.view("<u8").ravel()
    # The i-th run belongs to the i-th occupied quotient.
    start = np.maximum(wanted, np.concatenate([[0], ends[:-1] + 1]))
    used = ends - start + 1
    quotient = np.repeat(wanted, used)
    slot = np.repeat(start - np.concatenate([[0], np.cumsum(used)[:-1]]), used) + np.arange(used.sum())
    counting = bits[2][slot].astype(bool)
    entry = np.flatnonzero(~counting)
    fingerprints = (quotient[entry].astype(_U) << _U(r)) | remainder[slot[entry]]
    width = np.diff(np.concatenate([entry, [len(slot)]]))
    counts = np.ones(n, np.int64)
    for digit in range(int(width.max()) - 1):
        held = width > digit + 1
        counts[held] += (remainder[slot[entry[held] + digit + 1]] << _U(digit * r)).astype(np.int64)
    return fingerprints, counts


def _summed(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries in ascending order, equal ones added up; input that comes in sorted runs is merged run by run."""
    order = np.argsort(fingerprints, kind="stable")
    fingerprints, counts = fingerprints[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], fingerprints[1:] != fingerprints[:-1]])[: len(fingerprints)])
    return fingerprints[first], np.add.reduceat(counts, first) if len(first) else counts


def merge(filters: list[bytes], width: int) -> bytes:
    """One filter that holds what all the filters hold."""
    parts = [decode(f) for f in filters]
    return encode(*_summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])), width)


def section_bits(rows: int, section: int = SECTION) -> int:
    """Leading bits that tell sections apart, from the number of rows."""
    return max(0, math.ceil(math.log2(max(1, rows) / section)))


_SECTIONS = "section long, filter binary"


def filters(fingerprints: DataFrame, cut: int, bits: int = BITS, size: int = FILTER) -> DataFrame:
    """(section, filter): the counting quotient filters of every partition of a column of longs ``fp``."""

    def close(values: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        width = bits - cut
        section = (values >> _U(width)).astype(np.int64) if cut else np.zeros(len(values), np.int64)
        edges = np.concatenate([np.flatnonzero(np.concatenate([[True], section[1:] != section[:-1]])), [len(values)]])
        local = values & _U((1 << width) - 1)
        for a, b in zip(edges[:-1], edges[1:]):
            data = encode(local[a:b], counts[a:b], width)
            yield pa.RecordBatch.from_arrays([pa.array([int(section[a])]), pa.array([data], pa.binary())], ["section", "filter"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, held = [], (np.zeros(0, _U), np.zeros(0, np.int64))
        waiting = 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(_U)
            fresh.append(values)
            waiting += len(values)
            if waiting >= size:
                added = np.concatenate(fresh)
                held = _summed(np.concatenate([held[0], added]), np.concatenate([held[1], np.ones(len(added), np.int64)]))
                fresh, waiting = [], 0
                if len(held[0]) >= size:
                    yield from close(*held)
                    held = (np.zeros(0, _U), np.zeros(0, np.int64))
        added = np.concatenate([np.zeros(0, _U), *fresh])
        held = _summed(np.concatenate([held[0], added]), np.concatenate([held[1], np.ones(len(added), np.int64)]))
        if len(held[0]):
            yield from close(*held)

    return fingerprints.select("fp").mapInArrow(run, _SECTIONS)


def merged(parts: DataFrame, cut: int, bits: int = BITS) -> DataFrame:
    """(section, filter) with one filter per section. Filters of several corpora may be given together."""

    def run(group: pa.Table) -> pa.Table:
        data = merge(group.column("filter").to_pylist(), bits - cut)
        return pa.table({"section": group.column("section").slice(0, 1), "filter": pa.array([data], pa.binary())})

    return parts.groupBy("section").applyInArrow(run, _SECTIONS)


def counts(sections: DataFrame, cut: int, at_least: int = 1, bits: int = BITS) -> DataFrame:
    """(fp, n) of the fingerprints that filters hold ``at_least`` so many times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for section, data in zip(batch.column("section").to_pylist(), batch.column("filter").to_pylist()):
                local, n = decode(data)
                chosen = n >= at_least
                lead = _U(section << (bits - cut)) if cut else _U(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((local[chosen] | lead).view(np.int64)), pa.array(n[chosen])], ["fp", "n"]
                )

    return sections.mapInArrow(run, "fp long, n long")


def _fingerprint(body: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(body), 64 - bits)


def _bit(fp: Column) -> Column:
    return F.pmod(fp, F.lit(TABLE)) + 1


def _routed(frame: DataFrame, table: DataFrame, fp: str, name: str, how: str = "inner") -> DataFrame:
    """The rows, with whether the bit of their fingerprint is set; the table has at most TABLE / 32,768 rows."""
    bucket, bits = own_column(frame, "_bucket"), own_column(frame, "_bits")
    table = F.broadcast(table.toDF(bucket, bits))
    position = F.bitmap_bit_position(_bit(F.col(fp)))
    byte = F.conv(F.hex(F.substring(F.col(bits), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    found = frame.join(table, F.bitmap_bucket_number(_bit(F.col(fp))) == table[bucket], how)
    likely = F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
    return found.withColumn(name, likely).drop(bucket, bits)


def _classes(documents: DataFrame, bits: int, section: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keys of all rows, (fp, sha, keep_id, group_size) of every text that occurs more than once, and the bit table."""
    body = normalised(F.col("text"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"))
    texts = texts.withColumn("fp", _fingerprint(F.col("body"), bits))
    keys = keep(
        texts.select("doc_id", "fp", F.sha2("body", 256).alias("sha"), F.monotonically_increasing_id().alias("row")),
        "exact",
    )
    cut = min(bits - 1, section_bits(keys.count(), section))
    sections = keep(merged(filters(keys, cut, bits), cut, bits), "exact")
    bit = _bit(F.col("fp"))
    repeated = counts(sections, cut, 2, bits)
    table = repeated.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )
    table = keep(table, "exact")
    classes = (
        _routed(texts, table, "fp", "likely")
        .where("likely")
        .groupBy("fp", "body")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select("fp", F.sha2("body", 256).alias("sha"), "keep_id", "group_size")
    )
    return keys, keep(classes, "exact"), table


def report(documents: DataFrame, bits: int = BITS, section: int = SECTION) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``documents`` (doc_id, text)."""
    keys, classes, _ = _classes(documents, bits, section)
    # Several rows may have the smallest id; the first of them stays.
    first = (
        keys.join(classes, ["fp", "sha"])
        .where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("fp", "sha", "keep_id", "group_size")
        .agg(F.min("row").alias("first"))
    )
    single = F.col("group_size").isNull()
    return keys.join(first, ["fp", "sha"], "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("first"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicate(documents: DataFrame, bits: int = BITS, section: int = SECTION) -> DataFrame:
    """The documents that stay, with all their columns."""
    _, classes, table = _classes(documents, bits, section)
    fp, sha, ident, likely = (own_column(documents, c) for c in ("_fp", "_sha", "_ident", "_likely"))
    body = normalised(F.col("text"))
    marked = documents.select(
        "*", _fingerprint(body, bits).alias(fp), F.sha2(body, 256).alias(sha), F.col("doc_id").cast("long").alias(ident)
    )
    marked = _routed(marked, table, fp, likely, "left")
    classes = classes.select(F.col("fp").alias(fp), F.col("sha").alias(sha), F.col("keep_id").alias(ident))
    routed = marked.where(F.col(likely))
    single = routed.join(classes.select(fp, sha), [fp, sha], "left_anti")
    same = [routed[c].eqNullSafe(classes[c]) for c in (fp, sha, ident)]
    stays = routed.join(classes, same, "left_semi").dropDuplicates([fp, sha, ident])
    columns = [quoted(c) for c in documents.columns]
    every = (f.select(*columns) for f in (marked.where(~F.col(likely)), single, stays))
    return reduce(DataFrame.unionByName, every)
