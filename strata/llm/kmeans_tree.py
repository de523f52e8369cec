"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on at most ``SAMPLE`` vectors, those with the smallest hash of their id: a node
is split by k-means into ``BRANCH`` children until it holds ``LEAF`` sample vectors or fewer. Every vector
is then dealt to a leaf. A search keeps a priority queue of nodes by the distance of their centre, takes the
nearest, puts its children in, and visits it when it is a leaf. How many leaves a search visits is calibrated:
for ``PROBES`` vectors of the corpus the exact neighbours over all rows are found, and the visits are widened
until the leaves visited hold ``RECALL`` of them. A search that has met fewer vectors than it has to
return goes on, to the last leaf if need be.

Equal vectors are one entry; of their ids the smallest k + 1 suffice for any answer, and a hot vector is reduced
to them below the shuffle. A query goes once to each region of neighbouring leaves with the list of those it visits,
and brings back k + 1 vectors. Regions are searched in blocks of vectors and blocks of queries, so that neither a
crowded leaf nor one that many queries visit falls to one task. The tree and the leaf sizes, bounded by
the sample, are all that goes to the driver and to the tasks.

Nearness is Euclidean distance in double precision on the original vectors. Vectors that are null, zero or hold
a null or non-finite component take no part, nor do those whose length is not the commonest one. Rows with
the same id and vector are one. An empty table gives no rows. Only vec_id and embedding are read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import keep

K = 10
SAMPLE = 40_000
BRANCH = 8
LEAF = 128
PROBES = 256
RECALL = 0.95
#: Neighbouring leaves are searched together, in this many regions at most.
REGIONS = 32
#: Vectors and queries that are compared in one piece.
VECTOR_BLOCK = 8_192
QUERY_BLOCK = 512


def _kmeans(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(rounds):
        near = _nearest(points, centres)
        held = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centres)
    return centres, _nearest(points, centres)


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)


@dataclass
class Tree:
    """Nodes by number; ``children`` of a leaf is empty. Leaves are numbered on their own."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    n_leaves: int = 0

    def add(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.centres) - 1

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down by the nearest child."""
        found = np.zeros(len(vectors), np.int32)
        open_nodes = [(0, np.arange(len(vectors)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            if not self.children[node]:
                found[rows] = self.leaf[node]
                continue
            near = _nearest(vectors[rows], np.stack([self.centres[c] for c in self.children[node]]))
            open_nodes += [(c, rows[near == i]) for i, c in enumerate(self.children[node]) if (near == i).any()]
        return found

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """All leaves, the best bin first."""
        near = ((np.stack(self.centres) - query) ** 2).sum(axis=1).tolist()
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield self.leaf[node]
                continue
            for child in self.children[node]:
                heapq.heappush(queue, (near[child], child))


def grow(sample: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 0) -> Tree:
    tree, rng = Tree(), np.random.default_rng(seed)
    waiting = [(tree.add(sample.mean(axis=0)), sample)]
    while waiting:
        node, points = waiting.pop()
        if len(points) > max(leaf, branch):
            centres, near = _kmeans(points, branch, rng)
            parts = [(centres[i], points[near == i]) for i in range(branch) if (near == i).any()]
            if len(parts) > 1:
                for centre, part in parts:
                    tree.children[node].append(tree.add(centre))
                    waiting.append((tree.children[node][-1], part))
                continue
        tree.leaf[node] = tree.n_leaves
        tree.n_leaves += 1
    return tree


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0))
    widths = rows.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width").first()
    return rows.where(F.size("embedding") == (widths.width if widths else 0))


def _entries(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(entry, embedding), one per different vector, and (entry, vec_id) with its smallest k + 1 ids."""
    same = Window.partitionBy("embedding")
    few = rows.withColumn("place", F.rank().over(same.orderBy("vec_id"))).where(F.col("place") <= k + 1)
    few = keep(few.dropDuplicates(["embedding", "vec_id"]).withColumn("entry", F.min("vec_id").over(same)), "ann")
    return few.where("vec_id = entry").select("entry", "embedding"), few.select("entry", "vec_id")


def _exact(entries: DataFrame, ids: np.ndarray, probes: np.ndarray, k: int) -> pd.DataFrame:
    """(probe, entry, leaf, distance): the exact nearest entries of each probe, itself left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, int, int]]] = [[] for _ in probes]
        for batch in batches:
            points, entry, leaf = _matrix(batch.column("embedding"), probes.shape[1]), batch.column("entry").to_numpy(), batch.column("leaf").to_numpy()
            square = (points**2).sum(axis=1)
            for i, probe in enumerate(probes):
                near = square - 2 * points @ probe
                take = np.argpartition(near, k)[: k + 1] if len(near) > k + 1 else np.arange(len(near))
                held = best[i] + [(float(near[j]), int(entry[j]), int(leaf[j])) for j in take if entry[j] != ids[i]]
                best[i] = heapq.nsmallest(k, held)
        rows = [(i, *b) for i, held in enumerate(best) for b in held]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        types = (pa.int32(), pa.float64(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["probe", "near", "entry", "leaf"])

    found = entries.mapInArrow(run, "probe int, near double, entry long, leaf int")
    place = F.row_number().over(Window.partitionBy("probe").orderBy("near", "entry"))
    return found.withColumn("place", place).where(F.col("place") <= k).toPandas()


def calibrated_visits(tree: Tree, entries: DataFrame, k: int, recall: float, probes: int) -> int:
    """The fewest leaf visits that reach the recall on the probes."""
    chosen = entries.orderBy(F.xxhash64("entry", F.lit(1)), "entry").limit(probes).toPandas()
    points = np.stack(chosen["embedding"].to_numpy())
    truth = _exact(entries, chosen["entry"].to_numpy(), points, k)
    if truth.empty:
        return 1
    needed = []
    for probe, held in truth.groupby("probe"):
        order = {leaf: i + 1 for i, leaf in enumerate(tree.visits(points[probe]))}
        needed += [order[leaf] for leaf in held["leaf"]]
    needed.sort()
    return needed[int(np.ceil(recall * len(needed))) - 1]


def search(
    vectors: DataFrame, queries: DataFrame, k: int = K, recall: float = RECALL, sample: int = SAMPLE, probes: int = PROBES
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, its own id left out.

    ``queries`` has the columns of ``vectors``; an id names one vector.
    """
    rows = usable(vectors)
    entries, members = _entries(rows, k)
    # Ids are chosen first, so that vectors leave their tasks only if they are in the sample.
    chosen = entries.select("entry").orderBy(F.xxhash64("entry"), "entry").limit(sample)
    some = entries.join(F.broadcast(chosen), "entry", "left_semi").select(F.xxhash64("entry").alias("place"), "entry", "embedding")
    some = some.toPandas().sort_values(["place", "entry"])
    answer = "query_id long, rank int, vec_id long, score double"
    if some.empty:
        return vectors.sparkSession.createDataFrame([], answer)
    points = np.stack(some["embedding"].to_numpy())
    width, tree = points.shape[1], grow(points)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaves_of(_matrix(batch.column("embedding"), width))
            yield pa.RecordBatch.from_arrays([batch.column("entry"), batch.column("embedding"), pa.array(leaf)], ["entry", "embedding", "leaf"])

    dealt = keep(entries.mapInArrow(deal, "entry long, embedding array<double>, leaf int"), "ann")
    visits = calibrated_visits(tree, dealt, k, recall, probes)
    held = np.zeros(tree.n_leaves, np.int64)
    for r in dealt.groupBy("leaf").count().collect():  # one row per leaf of the tree
        held[r.leaf] = r["count"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, regions, leaves = [], [], []
            for i, query in enumerate(_matrix(batch.column("embedding"), width)):
                met, wanted = 0, defaultdict(list)
                for n, leaf in enumerate(tree.visits(query)):
                    if n >= visits and met > k:
                        break
                    met += held[leaf]
                    wanted[leaf // per_region].append(leaf)
                take += [i] * len(wanted)
                regions += list(wanted)
                leaves += list(wanted.values())
            rows = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("query_id"), rows.column("embedding"), pa.array(regions, pa.int32()), pa.array(leaves, pa.list_(pa.int32()))],
                ["query_id", "query", "region", "leaves"],
            )

    per_region = -(-tree.n_leaves // REGIONS)
    dealt = dealt.withColumn("region", F.floor(F.col("leaf") / per_region).cast("int"))
    asked = usable(queries).where(F.size("embedding") == width).dropDuplicates(["vec_id", "embedding"])
    asked = asked.select(F.col("vec_id").alias("query_id"), "embedding")
    wanted = keep(asked.mapInArrow(probe, "query_id long, query array<double>, region int, leaves array<int>"), "ann")
    # Blocks per region: one row per region.
    blocks = F.broadcast(
        dealt.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / VECTOR_BLOCK).cast("int").alias("n_blocks"))
        .join(wanted.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("n_asks")), "region")
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = dealt.join(blocks, "region").select(
        "region", F.pmod(F.xxhash64("entry"), "n_blocks").cast("int").alias("block"), every("n_asks").alias("ask"), "leaf", "entry", "embedding"
    )
    right = wanted.join(blocks, "region").select(
        "region", every("n_blocks").alias("block"), F.pmod(F.xxhash64("query_id"), "n_asks").cast("int").alias("ask"), "query_id", "query", "leaves"
    )

    def compare(found: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if found.empty or asks.empty:
            return pd.DataFrame({"query_id": [], "entry": [], "score": []})
        entry, leaf, at = found["entry"].to_numpy(), found["leaf"].to_numpy(), np.stack(found["embedding"].to_numpy())
        square, out = (at**2).sum(axis=1), []
        for start in range(0, len(asks), 64):
            part = asks.iloc[start : start + 64]
            rough = square - 2 * np.stack(part["query"].to_numpy()) @ at.T
            for near, query_id, query, leaves in zip(rough, part["query_id"], part["query"], part["leaves"]):
                here = np.flatnonzero(np.isin(leaf, leaves))
                if len(here) > k + 1:  # the rough distance only leaves out what is clearly farther
                    values = near[here]
                    limit = np.partition(values, k)[k]
                    here = here[values <= limit + 1e-9 * (1 + abs(limit) + (query**2).sum())]
                score = np.sqrt(((at[here] - query) ** 2).sum(axis=1))
                best = np.lexsort((entry[here], score))[: k + 1]
                out.append((np.full(len(best), query_id), entry[here][best], score[best]))
        return pd.DataFrame(dict(zip(("query_id", "entry", "score"), map(np.concatenate, zip(*out)))))

    on = ["region", "block", "ask"]
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(compare, "query_id long, entry long, score double")
    nearest = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "entry"))
    found = found.withColumn("place", nearest).where(F.col("place") <= k + 1)
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    named = found.join(members, "entry").where("vec_id <> query_id")
    return named.withColumn("rank", ranked).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
