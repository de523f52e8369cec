"""Phrase collocations, counted in HAT-tries.

Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces, and pieces into words at blanks and
tabs. Everything is counted per language.

1. *Tries.* A task counts the phrases of one length in a burstable trie over word ids: below the first word hangs a
   hash container of the rest; a container of more than ``BURST`` entries bursts into one container per next
   word. Single words need no container. When a task holds ``ENTRIES`` phrases, the largest subtrees are written out
   whole, as runs sorted by their words, until half are gone.
2. *Runs.* A run's rows carry its prefix, the first two words. The runs of a prefix meet in one partition, where
   Spark adds them up. A frequent first word is spread over its second words, and each task has
   combined its own occurrences before.
3. *Lengths.* A phrase cannot be more frequent than its parts. So one length is counted after the other, and of longer phrases
   only those whose first and last words without one reach ``MIN_COUNT``. Tasks ask for that in a bit table of
   ``TABLE`` bits (16 MB, whatever the input); phrases that share a bit are counted without need, none is missed.
4. *Scores.* Frequent phrases are joined with the counts of their parts; all arithmetic is exact.

Odd rows: a null text has no words; a null language is ``und``. Repeated rows count again. Equal scores
rank by count, then by phrase in byte order. Very long texts are counted whole, in slices of ``SLICE`` bytes. An
empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import keep

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2_000
#: A phrase goes when a longer one that holds it has this percentage of its count.
COVERED = 50
SCALE = 1_000_000
#: Entries of a container before it bursts.
BURST = 16_384
#: Phrases that a task holds before it writes subtrees out.
ENTRIES = 1_000_000
#: Words that are counted at once.
WORDS = 1 << 19
#: Bytes of a text that become words at once.
SLICE = 1 << 20
#: Languages that a task holds before it writes everything out.
LANGUAGES = 256
#: Bits of the table of frequent phrases.
TABLE = 1 << 27
#: Bits of a word's number in a key; a task's vocabulary starts anew when it is full.
_ID = 21
_CUT = re.compile(rb"[\x20\x09.,;:!?\x0a-\x0d]")
# One letter case, one blank, and one sign for all breaks between pieces.
_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + b"\t.,;:!?\x0b\x0c\x0d", bytes(range(97, 123)) + b" " + b"\n" * 9
)
_U = np.uint64
_RUN = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("rest", pa.string()), ("n", pa.int64())])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(29))


def _bits(hashes: np.ndarray, words: int) -> np.ndarray:
    """The bit in the table of each phrase of ``words`` neighbours, from hashes of words."""
    out = hashes[: len(hashes) - words + 1].copy()
    for i in range(1, words):
        out = _mixed(out) + hashes[i : len(hashes) - words + 1 + i]
    return (_mixed(out) % _U(TABLE)).astype(np.int64)


class HatTrie:
    """Counts of phrases of one length. A key is the ids of the words, packed."""

    def __init__(self, words: int, burst: int = BURST) -> None:
        self.words, self.burst = words, burst
        self.roots: dict[int, dict] = {}
        self.inner: set[int] = set()
        self.sizes: dict[int, int] = {}
        self.held = 0
        self.single = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return self.held

    def add(self, keys: np.ndarray) -> None:
        """Count occurrences."""
        if self.words == 1:
            counts = np.bincount(keys, minlength=len(self.single))
            counts[: len(self.single)] += self.single
            self.single, self.held = counts, int(np.count_nonzero(counts))
            return
        keys, counts = np.unique(keys, return_counts=True)
        shift = (self.words - 1) * _ID
        first = keys >> shift
        edges = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])[: len(first)])
        rest, times = (keys & (1 << shift) - 1).tolist(), counts.tolist()
        ends = [*edges[1:].tolist(), len(rest)]
        for root, a, b in zip(first[edges].tolist(), edges.tolist(), ends):
            node = self.roots.get(root)
            if node is None:
                self.roots[root] = node = dict(zip(rest[a:b], times[a:b]))
                size = b - a
            elif root in self.inner:
                size = self.sizes[root] + self._below(node, rest[a:b], times[a:b])
            else:
                for key, n in zip(rest[a:b], times[a:b]):
                    node[key] = node.get(key, 0) + n
                size = len(node)
            self.held += size - self.sizes.get(root, 0)
            self.sizes[root] = size
            if self.words > 2 and size > self.burst and root not in self.inner:
                self.roots[root] = inner = {}
                self._below(inner, node.keys(), node.values())
                self.inner.add(root)

    def _below(self, inner: dict[int, dict[int, int]], keys, counts) -> int:
        """Count into the containers of the next words; returns how many entries are new."""
        new, mask = 0, (1 << _ID) - 1
        for key, n in zip(keys, counts):
            child = inner.get(key >> _ID)
            if child is None:
                child = inner[key >> _ID] = {}
            word = key & mask
            if word in child:
                child[word] += n
            else:
                child[word] = n
                new += 1
        return new

    def take(self, at_most: int) -> tuple[np.ndarray, np.ndarray]:
        """Remove whole subtrees, the largest first, until ``at_most`` phrases are held: (keys, counts)."""
        if self.words == 1:
            keys = np.flatnonzero(self.single)
            counts, self.single, self.held = self.single[keys], np.zeros(0, np.int64), 0
            return keys, counts
        leads, nodes = [], []
        shift = (self.words - 1) * _ID
        for root in sorted(self.sizes, key=self.sizes.__getitem__, reverse=True):
            if self.held <= at_most:
                break
            self.held -= self.sizes.pop(root)
            node = self.roots.pop(root)
            if root in self.inner:
                self.inner.remove(root)
                leads.extend(root << shift | word << _ID for word in node)
                nodes.extend(node.values())
            else:
                leads.append(root << shift)
                nodes.append(node)
        sizes = np.fromiter(map(len, nodes), np.int64, len(nodes))
        keys = np.fromiter(chain.from_iterable(nodes), np.int64, sizes.sum())
        counts = np.fromiter(chain.from_iterable(n.values() for n in nodes), np.int64, sizes.sum())
        return keys + np.repeat(np.array(leads, np.int64), sizes), counts


class _Vocabulary(dict):
    """Numbers words as they come; 0 is a break, -1 is nothing."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0, b"": -1})
        self.names = [b"\n"]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        return number


class Reader:
    """The words of one language in a task, on their way into the trie."""

    def __init__(self, lang: str, words: int, table: np.ndarray | None) -> None:
        self.lang, self.words, self.table = lang, words, table
        self.seed = xxhash.xxh64_intdigest(lang.encode())
        self.trie = HatTrie(words)
        self.ids: list[np.ndarray] = []
        self.waiting = 0
        self._number([])

    def _number(self, words: list[bytes]) -> None:
        """Begin a vocabulary with the words that are still to be counted."""
        self.vocabulary = _Vocabulary()
        self.hashes = np.zeros(0, _U)
        self.ids = [np.array([self.vocabulary[w] for w in words], np.int64)]

    def read(self, text: bytes) -> Iterator[None]:
        """Take in a text; stops whenever there are words enough to be counted."""
        start = 0
        while start <= len(text):
            cut = _CUT.search(text, start + SLICE) if len(text) - start > SLICE else None
            end = cut.start() if cut else len(text)
            words = text[start:end].translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")
            if end == len(text):
                words.append(b"\n")
            ids = np.fromiter(map(self.vocabulary.__getitem__, words), np.int64, len(words))
            ids = ids[ids >= 0]
            self.ids.append(ids)
            self.waiting += len(ids)
            start = end if cut else len(text) + 1
            if self.waiting >= WORDS:
                yield

    def settle(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        """Count what was read; write all runs where asked to, or where the vocabulary is full."""
        self.count()
        if everything or len(self.vocabulary) > (1 << _ID) - WORDS - SLICE:
            yield from self.runs(0)
            names = self.vocabulary.names
            self._number([names[i] for i in np.concatenate(self.ids).tolist()])

    def count(self) -> None:
        """Move what was read into the trie; the last words may begin phrases that are still to come."""
        k = self.words
        ids = np.concatenate(self.ids)
        starts = max(0, len(ids) - k + 1)
        self.ids, self.waiting = [ids[starts:]], 0
        good = np.ones(starts, bool)
        for i in range(k):
            good &= ids[i : i + starts] > 0
        if k > 1 and starts:
            fresh = [xxhash.xxh64_intdigest(w, self.seed) for w in self.vocabulary.names[len(self.hashes) :]]
            self.hashes = np.concatenate([self.hashes, np.array(fresh, _U)])
            bit = _bits(self.hashes[ids], k - 1)
            frequent = (self.table[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
            good &= (frequent[:starts] & frequent[1 : starts + 1]).astype(bool)
        keys = np.zeros(starts, np.int64)
        for i in range(k):
            keys = keys << _ID | ids[i : i + starts]
        self.trie.add(keys[good])

    def runs(self, at_most: int) -> Iterator[pa.RecordBatch]:
        """Sorted runs of the subtrees that have to go."""
        keys, n = self.trie.take(at_most)
        if not len(n):
            return
        columns = [keys >> _ID * i & (1 << _ID) - 1 for i in range(self.words - 1, -1, -1)]
        used = np.flatnonzero(np.bincount(np.concatenate(columns)))
        names = [self.vocabulary.names[i] for i in used.tolist()]
        order = sorted(range(len(names)), key=names.__getitem__)
        rank = np.zeros(used[-1] + 1, np.int64)
        rank[used[order]] = np.arange(len(order))
        words = pa.array([names[i].decode() for i in order])
        columns = [rank[c] for c in columns]
        by = np.lexsort(columns[::-1])
        columns, n = [c[by] for c in columns], n[by]
        joined = [words.take(pa.array(c)) for c in columns]
        repeated = lambda text: pa.array([text]).take(pa.array(np.zeros(len(n), np.int64)))
        prefix = joined[0] if len(joined) == 1 else pc.binary_join_element_wise(*joined[:2], " ")
        rest = joined[2] if len(joined) > 2 else repeated("")
        run = pa.RecordBatch.from_arrays([repeated(self.lang), prefix, rest, pa.array(n)], schema=_RUN)
        for at in range(0, len(n), 65_536):
            yield run.slice(at, 65_536)


def runs(documents: DataFrame, words: int, table=None, entries: int = ENTRIES) -> DataFrame:
    """(lang, prefix, rest, n): the sorted runs that tasks write, of phrases of ``words`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers: dict[str, Reader] = {}
        bits = np.frombuffer(table.value, np.uint8) if table is not None else None

        def settle() -> Iterator[pa.RecordBatch]:
            many = len(readers) > LANGUAGES
            for reader in readers.values():
                yield from reader.settle(many)
            if sum(len(r.trie) for r in readers.values()) > entries:
                for reader in readers.values():
                    yield from reader.runs(len(reader.trie) // 2)
            if many:
                readers.clear()

        waiting = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("body")):
                reader = readers.get(lang)
                if reader is None:
                    reader = readers[lang] = Reader(lang, words, bits)
                waiting -= reader.waiting
                for _ in reader.read(text.as_py()):
                    # The reader's own words only: the readers may not change while one reads.
                    yield from reader.settle(len(reader.trie) > entries)
                waiting += reader.waiting
                if waiting >= WORDS or len(readers) > LANGUAGES:
                    yield from settle()
                    waiting = 0
        for reader in readers.values():
            yield from reader.settle(True)

    return documents.select("lang", "body").mapInArrow(run, "lang string, prefix string, rest string, n long")


def merged(parts: DataFrame) -> DataFrame:
    """(lang, phrase, n): the runs of each prefix added up in its partition."""
    summed = parts.repartition("lang", "prefix").groupBy("lang", "prefix", "rest").agg(F.sum("n").alias("n"))
    return summed.select("lang", F.concat_ws(" ", "prefix", F.nullif("rest", F.lit(""))).alias("phrase"), "n")


def _table(frequent: DataFrame, words: int):
    """The bits of the frequent phrases of one length, at most ``TABLE`` of them, broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [
                xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang))
                for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())
                for word in phrase.encode().split(b" ")
            ]
            bits = _bits(np.array(hashes, _U), words)[::words] if hashes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bits)], ["bit"])

    # Spark's bitmaps count from 1.
    bit = F.col("bit") + 1
    rows = (
        frequent.mapInArrow(run, "bit long")
        .groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
        .collect()
    )
    table = np.zeros(TABLE // 8, np.uint8)
    for row in rows:
        part = np.frombuffer(row.bits, np.uint8)
        at = (row.bucket - 1) * len(part)
        table[at : at + len(part)] = part
    return frequent.sparkSession.sparkContext.broadcast(table.tobytes())


def _part(start: int, size: int) -> Column:
    return F.array_join(F.slice("words", start, size), " ")


def frequent_phrases(
    documents: DataFrame, max_words: int = MAX_WORDS, at_least: int = MIN_COUNT, entries: int = ENTRIES
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n, size) of all phrases of up to ``max_words`` words that occur ``at_least`` so often, and (lang, total)."""
    if max_words not in (2, MAX_WORDS):
        raise ValueError("phrases have up to 2 or 3 words")
    texts = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce("text", F.lit("")).cast("binary").alias("body"),
    )
    words = keep(merged(runs(texts, 1, entries=entries)), "phrases")
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    found = words.where(F.col("n") >= at_least)
    every = found.withColumn("size", F.lit(1))
    for size in range(2, max_words + 1):
        table = _table(found, size - 1)
        found = keep(merged(runs(texts, size, table, entries)).where(F.col("n") >= at_least), "phrases")
        every = every.unionByName(found.withColumn("size", F.lit(size)))
    return every, total


def collocations(
    documents: DataFrame, max_words: int = MAX_WORDS, at_least: int = MIN_COUNT, top: int = TOP, entries: int = ENTRIES
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases, from (lang, text)."""
    every, total = frequent_phrases(documents, max_words, at_least, entries)
    phrases = every.where("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", F.col("n").alias("a"), "k",
        _part(1, F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    side = lambda part, name: every.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    wide = lambda c: f"CAST({c} AS DECIMAL(38,0))"
    score = F.expr(f"({SCALE} * {wide('a')} * {wide('a')}) DIV ({wide('l')} * {wide('r')})")
    worst = (
        cuts.withColumn("score", score)
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("worst"))
        .select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score")
    )
    sizes = F.sequence(F.lit(2), F.col("size") - 1)
    inside = phrases.where("size > 2").select(
        "lang", "n",
        F.explode(F.flatten(F.transform(sizes, lambda s: F.transform(
            F.sequence(F.lit(1), F.col("size") - s + 1), lambda i: F.array_join(F.slice("words", i, s), " ")
        )))).alias("phrase"),
    )
    longer = inside.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    left = worst.join(longer, ["lang", "phrase"], "left").where(
        f"longer IS NULL OR 100 * longer < {COVERED} * a"
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
