"""Best-fit packing of documents into sequences of fixed capacity, under conflicts.

Sizes are code points. A document longer than the capacity is cut into full pieces and a rest; all
are items. A bin holds no two items of one source and none of one duplicate cluster, for which it
carries two bitmaps. Items go in by decreasing size. The open bins of a group are kept in lists
ordered by residual, one list per bitmap (sources and clusters with many items), so that lists
in conflict are passed over whole; in each other list the search starts at the first
residual that is large enough and goes on to the next until a bin without the item's cluster is
found. The tightest of these is the tightest compatible bin of all.

Bins do not cross groups. Items are dealt to groups of about ``GROUP`` by a hash of what they are, so
a hot source or a large cluster is spread evenly over all groups, and a task holds one
group of sizes and bits, no text.

Nulls and odd rows: a null or empty text takes no space and gets no bin (``bin_id`` is null). A null
source or cluster conflicts with nothing. Repeated rows are items of one cluster and so get different
bins. An empty table gives no rows. Only the columns named in the arguments are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep

CAPACITY = 8_192
GROUP = 2_048
#: Clusters with more items in a group than this have a bit in the key of a list.
_HEAVY = 16
_BINS = 1 << 20


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """The bin of each item, the items given by decreasing size."""
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    cluster_bit = {c: 1 << i for i, c in enumerate(dict.fromkeys(c for c in clusters if c is not None))}
    heavy = 0
    for cluster, n in Counter(c for c in clusters if c is not None).items():
        heavy |= cluster_bit[cluster] if n > _HEAVY else 0
    smallest = min(sizes, default=0)
    lists: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    bin_sources: list[int] = []
    bin_clusters: list[int] = []
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = source_bit.get(source, 0), cluster_bit.get(cluster, 0)
        best = None
        for (held_sources, held_heavy), bins in lists.items():
            if held_sources & s or held_heavy & c or not bins or bins[-1][0] < size:
                continue
            for at in range(bisect_left(bins, (size, -1)), len(bins)):
                if best and bins[at] >= best:
                    break
                if not bin_clusters[bins[at][1]] & c:
                    best = bins[at]
                    break
        if best:
            residual, chosen = best
            bins = lists[bin_sources[chosen], bin_clusters[chosen] & heavy]
            del bins[bisect_left(bins, best)]
        else:
            residual, chosen = capacity, len(bin_sources)
            bin_sources.append(0)
            bin_clusters.append(0)
        bin_sources[chosen] |= s
        bin_clusters[chosen] |= c
        residual -= size
        if residual >= smallest:
            insort(lists[bin_sources[chosen], bin_clusters[chosen] & heavy], (residual, chosen))
        placed.append(chosen)
    return placed


def pack(
    documents: DataFrame,
    cluster: Column | None = None,
    source: Column | None = None,
    capacity: int = CAPACITY,
    group: int = GROUP,
) -> DataFrame:
    """One row per item: doc_id, piece, start, size, source, cluster, bin_id, position, bin_offset.

    ``start`` is where the piece begins in its text, ``bin_offset`` where it lies in its bin. By default
    equal texts are a cluster and the column ``source`` is the source.
    """
    whole = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("length"),
        (F.col("source") if source is None else source).cast("string").alias("source"),
        (F.xxhash64("text") if cluster is None else cluster).cast("long").alias("cluster"),
    )
    pieces = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("length") - 1) / capacity)).cast("int"))
    items = whole.select("*", F.explode(pieces).alias("piece")).select(
        "doc_id",
        "piece",
        (F.col("piece").cast("long") * capacity).alias("start"),
        F.least(F.lit(capacity), F.col("length") - F.col("piece").cast("long") * capacity).cast("int").alias("size"),
        "source",
        "cluster",
    )
    items = keep(items, "packing")
    n_groups = max(1, -(-items.count() // group))
    dealt = items.where("size > 0").withColumn(
        "deal", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(n_groups)).cast("long")
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_id", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        known = lambda column: [None if pd.isna(x) else x for x in rows[column]]
        rows["bin"] = best_fit(rows["size"].tolist(), known("source"), known("cluster"), capacity)
        in_bin = rows.groupby("bin")["size"]
        rows["position"] = in_bin.cumcount().astype(np.int32)
        rows["bin_offset"] = (in_bin.cumsum() - rows["size"]).astype(np.int32)
        rows["bin_id"] = rows["deal"] * _BINS + rows["bin"]
        return rows.drop(columns=["deal", "bin"])

    columns = "doc_id long, piece int, start long, size int, source string, cluster long, position int, bin_offset int, bin_id long"
    packed = dealt.groupBy("deal").applyInPandas(run, columns)
    return packed.unionByName(items.where("size = 0"), allowMissingColumns=True)


def sequences(documents: DataFrame, packed: DataFrame, separator: str = "\n") -> DataFrame:
    """(bin_id, doc_ids, text): the packed texts themselves. A bin is bounded by the capacity.

    ``doc_id`` must name one document each.
    """
    text = documents.select("doc_id", "text")
    held = packed.where("bin_id IS NOT NULL").join(text, "doc_id").select(
        "bin_id", F.struct("position", "doc_id", F.expr("substring(text, cast(start AS int) + 1, size)").alias("part")).alias("item")
    )
    ordered = F.sort_array(F.collect_list("item"))
    return held.groupBy("bin_id").agg(ordered.alias("items")).select(
        "bin_id", F.col("items.doc_id").alias("doc_ids"), F.array_join("items.part", separator).alias("text")
    )
