"""Removal of long byte strings that occur more than once, by blocks of suffixes over an anchored cover sample.

The dealt method, blockwise suffix sorting with the ranks of a difference cover, is swapped: nothing is sorted and there
are no ranks. Kept of it are the blocks, of which undecided ones alone are worked on, and the precomputed
sample that decides ties; names of sampled strings, equal for equal strings, stand where ranks would.

A suffix is decided by its first ``LENGTH`` bytes: it is repeated if another suffix begins with the same
bytes. Sorting all suffixes of a corpus would shuffle many times its size, so the suffixes are
dealt to buckets such that equal ones share a bucket, and most buckets are decided as a whole:

1. *Buckets.* Every suffix is dealt to an anchor, the position of the smallest hash among the strings of half
   the length within its ``LENGTH`` bytes. Equal suffixes have the same anchor string at the same
   distance. Anchors lie about a quarter of the length apart; a run of suffixes with one anchor is one row. A bucket
   (anchor string) with a single run holds no repeated suffix and is dropped.
2. *Whole runs.* Runs of a bucket whose bytes are equal throughout are repeated suffix by suffix. What
   is left are buckets with several different runs; each different run is taken once.
3. *Cover sample.* In these runs the positions a multiple of ``PERIOD`` from the anchor are the cover. A
   cover made for arbitrary pairs of positions needs about sqrt(PERIOD) residues, so that some shift brings
   any two suffixes to covered positions; here the anchor tells the shift, and one residue suffices. A covered
   position gets a name (its rank as far as equality goes) for the string of LENGTH - PERIOD + 1 bytes there.
   Suffixes with unequal names at the next covered position differ.
4. *Blocks.* A block is the suffixes of one name. Blocks with one run are dropped; in the others a hash of all
   LENGTH bytes of each suffix tells which are equal.

Names and strings are compared by 64-bit hashes of the bytes. What a block decides rests on two independent ones; whole runs
rest on the hash of the anchor string and that of the run's bytes, which are of one kind.
All steps are joins and aggregations of Spark; no task needs more than the texts of a
batch, a bucket is never gathered, and hot buckets are split by Spark's skew handling.

A passage of over 50 words may be shorter than that, so ``report`` also says which documents share one with another
document. The same anchors are taken over hashes of words: runs whose anchor string another document has too are
compared whole, and where that does not settle it by a hash of each of their strings of 51 words. White space and the lengths of
words do not matter there, a passage that comes again in its own document only does not count, and nothing is removed for it.

Nulls and odd rows: a null or short text loses nothing. Rows are told apart by doc_id and text, so a
repeated row counts as a second occurrence and both lose all their long strings; a null doc_id is an id
like any other. For passages such a repeated row is the same document. An empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import keep, own_column

LENGTH = 400
#: Bytes that take in any passage of over 50 words: such passages have about 285 bytes and more.
PASSAGE = 250
PERIOD = 32
#: Words of a passage that counts as shared, and of its anchor.
WORDS = 51
ANCHOR_WORDS = 16
#: Bytes hashed at once; longer texts are cut with an overlap.
_CHUNK = 1 << 17
#: Longer words are hashed one by one.
_LONG = 1 << 12
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SHIFT = np.uint64(24)
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Hasher:
    """Hashes of substrings, equal for equal bytes wherever they stand. ``seed`` gives independent ones."""

    def __init__(self, size: int, seed: int) -> None:
        self.codes = np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64)
        base = int(self.codes[0]) | 1
        self.powers = self._powers(base, size)
        self.inverse = self._powers(pow(base, -1, 2**64), size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        factors = np.full(size + 1, base, _U)
        factors[0] = 1
        return np.cumprod(factors)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        return self.running(self.codes[data])

    def running(self, codes: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(codes) + 1, _U)
        np.cumsum(codes * self.powers[: len(codes)], out=sums[1:])
        return sums

    def all(self, sums: np.ndarray, length: int) -> np.ndarray:
        """``at`` for every start, without indices."""
        out = sums[length:] - sums[:-length]
        out *= self.inverse[: len(out)]
        return _mix(out)

    def at(self, sums: np.ndarray, start: np.ndarray, length) -> np.ndarray:
        return _mix((sums[start + length] - sums[start]) * self.inverse[start])


def _smallest_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, by running minima of blocks from both sides."""
    full = -(-len(values) // width) * width
    padded = np.full(full, np.iinfo(_U).max, _U)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs_of(sums: np.ndarray, spans: list[tuple[int, int]], length: int, anchor: int, hasher: Hasher) -> tuple:
    """(name, content, first, last, distance, size, n) of every run of suffixes in the texts at ``spans``.

    ``sums`` are those of the hasher over the bytes or the words of the texts.

    ``distance`` is how far the anchor lies behind the first suffix and ``size`` how many suffixes a run has. In
    periodic text the same run comes again and again; n equal ones that follow each other are one row.
    """
    strings = hasher.all(sums, anchor)
    ranked = (strings >> _SHIFT << _SHIFT) | np.arange(len(strings), dtype=_U)
    nearest = _smallest_in_window(ranked, length - anchor + 1)
    # A run begins where a text does and where the anchor changes; it ends before the next or with the text's last string.
    begins, ends = np.array(spans).T
    changed = np.flatnonzero(nearest[1:] != nearest[:-1]) + 1
    text = np.searchsorted(begins, changed, side="right") - 1
    inside = (text >= 0) & (changed > begins[text]) & (changed <= ends[text] - length)
    lo = np.sort(np.concatenate([begins, changed[inside]]))
    text = np.searchsorted(begins, lo, side="right") - 1
    hi = np.minimum(np.append(lo[1:], len(sums)) - 1, ends[text] - length)
    at = (nearest[lo] & _U((1 << 24) - 1)).astype(np.int64)
    shape = (at - lo).astype(_U) * _U(0x9E3779B97F4A7C15) + (hi - lo).astype(_U)
    content = _mix(hasher.at(sums, lo, hi - lo + length) ^ _mix(shape))
    name, distance, size = strings[at], at - lo, hi - lo + 1
    again = (name[1:] == name[:-1]) & (content[1:] == content[:-1]) & (lo[1:] == hi[:-1] + 1)
    first = np.flatnonzero(np.concatenate([[True], ~again]))
    n = np.diff(np.concatenate([first, [len(lo)]]))
    return name[first], content[first], lo[first], hi[first + n - 1], distance[first], size[first], n


def _groups(sizes: list[int], length: int) -> Iterator[list[tuple[int, int, int]]]:
    """(row, from, to) of the texts or overlapping parts of texts that are hashed together."""
    group, held = [], 0
    for row, size in enumerate(sizes):
        if size < length:
            continue
        step = _CHUNK - length
        for start in range(0, size - length + 1, step):
            end = min(size, start + step + length - 1)
            if held + end - start > _CHUNK and group:
                yield group
                group, held = [], 0
            group.append((row, start, end))
            held += end - start
    if group:
        yield group


def _runs(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(_CHUNK + length, 1)
        for batch in batches:
            texts = [t.as_buffer() if t.is_valid else b"" for t in batch.column("text")]
            doc, mark = batch.column("doc_id"), batch.column("mark")
            for group in _groups([len(t) for t in texts], length):
                parts = [np.frombuffer(texts[row], np.uint8)[a:b] for row, a, b in group]
                ends = np.cumsum([len(p) for p in parts])
                begins = ends - [len(p) for p in parts]
                name, content, lo, hi, distance, size, n = runs_of(
                    hasher.prefix(np.concatenate(parts)), list(zip(begins, ends)), length, anchor, hasher
                )
                part = np.searchsorted(begins, lo, side="right") - 1
                row = pa.array(np.array([g[0] for g in group])[part])
                first = lo - begins[part] + np.array([g[1] for g in group])[part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), pa.array(content.view(np.int64)), doc.take(row), mark.take(row),
                     *(pa.array(x.astype(np.int32)) for x in (first, first + hi - lo, distance, size, n))],
                    ["name", "content", "doc_id", "mark", "first", "last", "distance", "size", "n"],
                )

    schema = "name long, content long, doc_id long, mark long, first int, last int, distance int, size int, n int"
    return rows.select("doc_id", "mark", "text").mapInArrow(run, schema)


def _blocks(wanted: DataFrame, length: int) -> DataFrame:
    """(cover, single, doc_id, mark, first, tails): one row per covered position of the wanted runs.

    ``tails`` are hashes of the suffixes that meet the cover there, by position from ``first`` on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(2 * length, 2)
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("cover", "single", "doc_id", "mark", "first", "tails")}
            doc, mark = batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist()
            for i, (text, found) in enumerate(zip(batch.column("text"), batch.column("found").to_pylist())):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                for r in found:
                    n = r["size"]
                    sums = hasher.prefix(data[r["first"] : r["first"] + n - 1 + length])
                    tails = hasher.at(sums, np.arange(n), length).view(np.int64)
                    behind = r["distance"] - np.arange(n)
                    block = behind // PERIOD
                    cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
                    covered = r["distance"] - block[cut[:-1]] * PERIOD
                    seed = _mix(np.array([r["name"]], np.int64).view(_U) + block[cut[:-1]].view(_U) * _U(0x9E3779B97F4A7C15))
                    cover = _mix(hasher.at(sums, covered, length - PERIOD + 1) ^ seed).view(np.int64)
                    for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
                        out["cover"].append(cover[k])
                        out["single"].append(r["n"] == 1)
                        out["doc_id"].append(doc[i])
                        out["mark"].append(mark[i])
                        out["first"].append(r["first"] + int(a))
                        out["tails"].append(tails[a:b])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("cover", pa.int64()), ("single", pa.bool_()), ("doc_id", pa.int64()), ("mark", pa.int64()),
                        ("first", pa.int32()), ("tails", pa.list_(pa.int64()))])
    return wanted.mapInArrow(run, "cover long, single boolean, doc_id long, mark long, first int, tails array<long>")


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["mark"] == b["mark"])


def _marked(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text")
    )


def repeated_starts(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, mark, ranges): where strings of ``length`` bytes start that also start elsewhere.

    ``ranges`` are unordered (first, last) byte positions; ``mark`` is xxhash64 of the text.
    """
    anchor = length // 2
    rows = _marked(documents)
    runs = _runs(rows.where(F.octet_length("text") >= length), length, anchor)
    buckets = (
        runs.groupBy("name")
        .agg(F.sum("n").alias("times"), F.min("content").alias("least"), F.max("content").alias("most"))
        .where("times > 1")
        .select("name", (F.col("least") != F.col("most")).alias("mixed"))
    )
    shared = keep(runs.join(buckets, "name"), "suffix")
    mixed = shared.where("mixed")
    different = keep(
        mixed.groupBy("name", "content").agg(
            F.sum("n").alias("n"), F.min(F.struct("doc_id", "mark", "first", "distance", "size")).alias("one")
        ),
        "suffix",
    )
    whole = shared.where("NOT mixed").unionByName(
        mixed.join(different.where("n > 1").select("name", "content"), ["name", "content"])
    )
    per_text = (
        different.select("name", "n", "one.*")
        .groupBy("doc_id", "mark")
        .agg(F.collect_list(F.struct("name", "n", "first", "distance", "size")).alias("found"))
    )
    wanted = rows.join(per_text, _same_row(rows, per_text)).select(rows.doc_id, rows.mark, "text", "found")
    blocks = keep(_blocks(wanted, length), "suffix")
    tied = blocks.groupBy("cover").count().where("count > 1").select("cover")
    suffixes = blocks.join(tied, "cover").select(
        "cover", "single", "doc_id", "mark", "first", F.posexplode("tails").alias("at", "tail")
    )
    equal = suffixes.groupBy("cover", "tail").count().where("count > 1").select("cover", "tail")
    position = F.col("first") + F.col("at")
    resolved = suffixes.where("single").join(equal, ["cover", "tail"]).select(
        "doc_id", "mark", position.alias("first"), position.alias("last")
    )
    ranges = whole.select("doc_id", "mark", "first", "last").unionByName(resolved)
    return ranges.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def words_of(data: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and where it starts."""
    edges = np.flatnonzero(np.diff(_SPACE[data], prepend=True, append=True))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    codes, at = np.empty(len(starts), _U), 0
    while at < len(starts):
        base = starts[at]
        to = int(np.searchsorted(starts, base + _CHUNK - _LONG))
        sums = hasher.prefix(data[base : base + _CHUNK])
        codes[at:to] = hasher.at(sums, starts[at:to] - base, np.minimum(sizes[at:to], _LONG))
        at = to
    for i in np.flatnonzero(sizes > _LONG):
        word = data[starts[i] : starts[i] + sizes[i]].tobytes()
        codes[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return codes, starts


def _word_runs(texts: list, hasher: Hasher) -> Iterator[tuple]:
    """(row, name, content, first, size) of the runs of strings of words; ``first`` is the word of its text."""
    held, total = [], 0
    for row, text in enumerate(texts):
        held.append(row)
        total += len(text)
        if total < _CHUNK and row + 1 < len(texts):
            continue
        offsets = np.cumsum([0, *(len(texts[r]) + 1 for r in held)])
        codes, starts = words_of(np.frombuffer(b"\n".join(texts[r] for r in held), np.uint8), hasher)
        cuts = np.searchsorted(starts, offsets)
        for part in range(0, len(codes), _CHUNK - WORDS + 1):
            ends = np.clip(cuts - part, 0, _CHUNK)
            spans = [(a, b) for a, b in zip(ends, ends[1:]) if b - a >= WORDS]
            if spans:
                sums = hasher.running(codes[part : part + _CHUNK])
                name, content, lo, _, _, size, _ = runs_of(sums, spans, WORDS, ANCHOR_WORDS, hasher)
                text_of = np.searchsorted(cuts, lo + part, side="right") - 1
                yield np.array(held)[text_of], name, content, lo + part - cuts[text_of], size
        held, total = [], 0


def _passage_runs(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(_CHUNK, 1)
        for batch in batches:
            texts = [t.as_buffer() if t.is_valid else b"" for t in batch.column("text")]
            for row, name, content, first, size in _word_runs(texts, hasher):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), pa.array(content.view(np.int64)), batch.column("who").take(pa.array(row)),
                     pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32))],
                    ["name", "content", "who", "first", "size"],
                )

    return rows.select("who", "text").mapInArrow(run, "name long, content long, who long, first int, size int")


def _passages(wanted: DataFrame) -> DataFrame:
    """(who, passage): a hash of every string of words in the wanted runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(_CHUNK, 2)
        for batch in batches:
            hashes: list[np.ndarray] = []
            times = []
            for text, found in zip(batch.column("text"), batch.column("found").to_pylist()):
                codes, _ = words_of(np.frombuffer(text.as_buffer(), np.uint8), hasher)
                for r in found:
                    sums = hasher.running(codes[r["first"] : r["first"] + r["size"] + WORDS - 1])
                    hashes.append(hasher.at(sums, np.arange(r["size"]), WORDS))
                times.append(sum(r["size"] for r in found))
            who = np.repeat(batch.column("who").to_numpy(), times)
            passage = np.concatenate(hashes or [np.empty(0, _U)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(passage)], ["who", "passage"])

    return wanted.mapInArrow(run, "who long, passage long")


def _shared(frame: DataFrame, *key: str) -> DataFrame:
    """The keys that more than one document has."""
    several = frame.groupBy(*key).agg(F.min("who").alias("least"), F.max("who").alias("most"))
    return several.where("least <> most").select(*key)


def sharing_passages(documents: DataFrame) -> DataFrame:
    """(doc_id, mark) of the documents that share ``WORDS`` words in sequence with another one."""
    rows = _marked(documents).withColumn("who", F.xxhash64("doc_id", "mark"))
    # So many words have one white space less, and a byte each.
    runs = _passage_runs(rows.where(F.octet_length("text") >= 2 * WORDS - 1))
    common = keep(runs.join(_shared(runs, "name"), "name"), "passages")
    alike = common.join(_shared(common, "name", "content"), ["name", "content"])
    sure = keep(alike.select("who").distinct(), "passages")
    # Of the others each different run of an anchor is taken once; a document that is not sure has all of its own.
    unsure = common.join(sure, "who", "left_anti").select("name").distinct()
    once = common.join(unsure, "name", "left_semi").groupBy("name", "content").agg(F.min(F.struct("who", "first", "size")).alias("one"))
    per_text = once.select("one.*").groupBy("who").agg(F.collect_list(F.struct("first", "size")).alias("found"))
    passages = keep(_passages(rows.join(per_text, "who").select("who", "text", "found")), "passages")
    more = passages.join(_shared(passages, "passage"), "passage").select("who")
    return rows.join(sure.unionByName(more).distinct(), "who", "left_semi").select("doc_id", "mark")


def spans_of(ranges: list[dict] | None, length: int = LENGTH) -> list[tuple[int, int]]:
    """The maximal byte spans (start, end) covered by strings that start in the ranges."""
    spans: list[tuple[int, int]] = []
    for first, last in sorted((r["first"], r["last"]) for r in ranges or []):
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], last + length))
        else:
            spans.append((first, last + length))
    return spans


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _with_ranges(documents: DataFrame, length: int, sharing: DataFrame | None = None) -> tuple[DataFrame, str, str]:
    """The documents with the ranges of each row, and the names of the two added columns.

    With ``sharing``, (doc_id, mark) of some documents, there is a column ``shares_passage`` too, true or null.
    """
    ranges, body, ident, mark = (own_column(documents, n) for n in ("_ranges", "_body", "_id", "_mark"))
    found = keep(repeated_starts(documents, length), "suffix")
    if sharing is not None:
        both = found.withColumn("shares_passage", F.lit(None).cast("boolean")).unionByName(
            sharing.withColumn("shares_passage", F.lit(True)), allowMissingColumns=True
        )
        found = both.groupBy("doc_id", "mark").agg(
            F.first("ranges", ignorenulls=True).alias("ranges"), F.max("shares_passage").alias("shares_passage")
        )
    found = found.toDF(ident, mark, ranges, *found.columns[3:])
    same = documents["doc_id"].cast("long").eqNullSafe(found[ident]) & (F.xxhash64(documents["text"]) == found[mark])
    joined = documents.join(found, same, "left").drop(ident, mark)
    return joined.withColumn(body, F.col("text").cast("binary")), ranges, body


def report(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, shares_passage) per document; spans are byte positions.

    ``shares_passage`` says whether another document has a passage of over 50 words of it, shorter ones than ``length`` included.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Finished before the rest begins, whose files would lie beside its own.
    sharing = keep(sharing_passages(rows), "passages")
    joined, ranges, body = _with_ranges(rows, length, sharing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in schema.names}
            out["doc_id"] = batch.column("doc_id").to_pylist()
            out["shares_passage"] = batch.column("shares_passage").to_pylist()
            for text, found in zip(batch.column(body), batch.column(ranges).to_pylist()):
                data = text.as_py() or b""
                spans = spans_of(found, length)
                rest = kept_bytes(data, spans)
                out["n_bytes"].append(len(data))
                out["n_removed"].append(len(data) - len(rest))
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
                out["spans"].append([{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("spans", pa.list_(span)), ("shares_passage", pa.bool_())])
    return joined.select("doc_id", body, ranges, F.coalesce("shares_passage", F.lit(False)).alias("shares_passage")).mapInArrow(
        run,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start:long,end:long>>, shares_passage boolean",
    )


def remove(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated strings cut from their texts; characters cut in two are dropped whole."""
    joined, ranges, body = _with_ranges(documents, length)
    at = documents.schema.fieldNames().index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if text is None else kept_bytes(text, spans_of(found, length)).decode("utf-8", "ignore")
                for text, found in zip(batch.column(body).to_pylist(), batch.column(ranges).to_pylist())
            ]
            batch = batch.drop_columns([ranges, body])
            yield batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type))

    return joined.mapInArrow(run, T.StructType(documents.schema.fields))
