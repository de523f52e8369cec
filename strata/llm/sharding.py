"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by a key of 32 hexadecimal digits: a hash of the text, then one of the id. Equal texts
are neighbours, and a text with very many copies is still cut where a boundary has to fall. The
splitters are found without sorting: a histogram counts the exact bytes below each of 4,096 candidate keys over
all partitions; for every boundary the cell it falls into is kept and counted again in 4,096 finer
cells, until the boundary is within the tolerance or its cell has one key. Only cell sums come to the
driver, at most 4,096 for each boundary and round. The histogram reads sizes and keys only. Then every document
knows its shard and moves once, with its text and all its columns, to the files of its shard. The digest of the
query is read back from these files.

Law ``bytes``: sizes are near equal. A row's size is the UTF-8 length of its text plus 8.

A slot is the place of a row within its shard, counted from 0. Shards are cut into sections by a hash of the id,
sections are numbered on their own and start where those before them end, so no task sees a whole shard. Slots say the
order of a shard's documents; its sections are separate files.

Nulls and odd rows: a null text counts 8 bytes and has the checksum of the empty text. Null ids and repeated
rows are rows like any other. An empty table gives no rows; fewer rows than shards leave shards empty. Columns
other than doc_id and text are carried along, also those named like one of the operator's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import keep, own_column, quoted
from strata.session import scratch_dir

SHARDS = 24
#: How far a boundary may be off, as a share of a shard's bytes.
TOLERANCE = 0.001
#: Rows of a shard that are numbered together.
SECTION = 50_000
_DIGITS, _STEP = 32, 3


def _hash_digits(*columns: Column) -> Column:
    return F.lpad(F.hex(F.xxhash64(*columns)), 16, "0")


def keyed(documents: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, sort_key) per document."""
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.concat(_hash_digits(text), _hash_digits(F.col("doc_id"))).alias("sort_key"),
    )


@dataclass
class Boundary:
    """The key below which the wanted bytes lie: in the cell ``prefix``, which starts at ``below`` bytes."""

    wanted: float
    prefix: str = ""
    below: int = 0
    settled: str | None = None

    def refine(self, cells: list[tuple[str, int]], slack: float) -> None:
        """Find the cell of the wanted byte among the finer ones, which are in order of key."""
        for prefix, size in cells:
            if self.below + size <= self.wanted:
                self.below += size
                continue
            self.prefix = prefix
            if self.wanted - self.below <= slack:
                self.settled = prefix
            elif self.below + size - self.wanted <= slack:
                self.settled = prefix + "~"
            elif len(prefix) == _DIGITS:
                nearer = self.wanted - self.below <= self.below + size - self.wanted
                self.settled = prefix if nearer else prefix + "~"
            return
        self.settled = "~"


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[str]:
    """The shards - 1 keys at which a new shard begins. "~" sorts behind every digit."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    found = [Boundary(total * i / shards) for i in range(1, shards)]
    for length in range(_STEP, _DIGITS + _STEP, _STEP):
        length = min(length, _DIGITS)
        open_cells = sorted({b.prefix for b in found if b.settled is None})
        if not open_cells:
            break
        parent = F.substring("sort_key", 1, len(open_cells[0]))
        inside = rows.where(parent.isin(open_cells)) if open_cells[0] else rows
        sums = inside.groupBy(F.substring("sort_key", 1, length).alias("cell")).agg(F.sum("size").alias("size")).collect()
        cells = sorted((r.cell, r["size"]) for r in sums)
        for b in found:
            if b.settled is None:
                b.refine([c for c in cells if c[0].startswith(b.prefix)], slack)
    return [b.settled for b in found]


def placed(documents: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, section: int = SECTION) -> tuple[DataFrame, str, str]:
    """The documents with all their columns and two more, and the names of these: shard and slot."""
    rows = keep(keyed(documents), "sharding")
    keys = splitters(rows, shards, tolerance)
    n_sections = max(1, -(-rows.count() // (shards * section)))

    def place(key: Column, doc_id: Column, checksum: Column) -> tuple[Column, Column]:
        number = F.lit(0)
        for k in keys:
            number = number + (key >= k).cast("int")
        return number, F.pmod(F.xxhash64(doc_id, checksum), F.lit(n_sections))

    number, part = place(F.col("sort_key"), F.col("doc_id"), F.col("text_crc32"))
    ahead = Window.partitionBy("start_shard").orderBy("start_section").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(number.alias("start_shard"), part.alias("start_section")).count().select(
        "start_shard", "start_section", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("start")
    )
    shard_at, slot_at, section_at, key_at = (own_column(documents, n) for n in ("shard", "slot", "_section", "_sort_key"))
    own = [F.col(quoted(c)) for c in documents.columns]
    text, doc_id = F.coalesce("text", F.lit("")), F.col("doc_id").cast("long")
    whole = documents.select(*own, F.concat(_hash_digits(text), _hash_digits(F.col("doc_id"))).alias(key_at))
    number, part = place(F.col(key_at), doc_id, F.crc32(text))
    whole = whole.select("*", number.alias(shard_at), part.alias(section_at))
    # The one exchange of the documents is that of this window; the starts are a few rows per shard.
    within = F.row_number().over(Window.partitionBy(shard_at, section_at).orderBy(key_at, doc_id))
    slot = own_column(whole, "_within")
    numbered = whole.withColumn(slot, within)
    starts = starts.toDF(*(own_column(numbered, c) for c in starts.columns))
    at_shard, at_section, start = starts.columns
    joined = numbered.join(starts, (F.col(shard_at) == F.col(at_shard)) & (F.col(section_at) == F.col(at_section)))
    out = joined.select(*own, F.col(shard_at), (F.col(start) + F.col(slot) - 1).cast("long").alias(slot_at))
    return out, shard_at, slot_at


def write_shards(
    documents: DataFrame, path: str, shards: int = SHARDS, tolerance: float = TOLERANCE, section: int = SECTION
) -> tuple[DataFrame, str, str]:
    """Write the documents below ``path``, a folder of Parquet files per shard; the written rows, as ``placed`` gives them."""
    out, shard_at, slot_at = placed(documents, shards, tolerance, section)
    out.write.partitionBy(shard_at).parquet(path)
    return documents.sparkSession.read.schema(out.schema).parquet(path), shard_at, slot_at


def shard(documents: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, section: int = SECTION) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per document, read from the written shards."""
    path = scratch_dir(documents.sparkSession, "shards")
    written, shard_at, slot_at = write_shards(documents, path, shards, tolerance, section)
    text = F.coalesce("text", F.lit(""))
    return written.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"), F.col(shard_at).alias("shard"),
        F.col(slot_at).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
