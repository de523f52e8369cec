"""Quality rules per document, and lines that too many documents of a host share.

A line is normalised (ASCII lower case, single spaces, every digit a 0) and hashed. Over all documents it is
counted in how many distinct documents of each host it stands; exact copies are one document. A line in
more than ``SHARE`` of a host's documents, and in more than ``FEW`` of them, is above the limit and is removed.
A document is depleted, and rejected, if fewer than ``MIN_WORDS`` words or less than ``REST`` of its
words are left.

Texts are read once, in batches, and never shuffled: a document becomes its counts and its line hashes.
Counting is partial before the shuffle, so a line on every page costs one row per task. Lines of a document go
back to it by a join in which Spark may split a hot line.

Nulls and odd rows: a null text has no words and fails the base rules. A null source is a host of its own.
Repeated rows get a row each and count as one document. An empty table gives no rows. Only doc_id, text
and source are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keep

SHARE = 0.01
FEW = 5
MIN_WORDS = 10
REST = 0.5
WINDOW = 5
_SPACE = b" \t\n\x0b\x0c\r"
_TAILS = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_DIGITS = bytes.maketrans(b"123456789", b"000000000")


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """How many words stand in a window of ``size`` words that occurs twice or more."""
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, end = 0, 0
    for at, window in enumerate(windows):
        if times[window] > 1:
            covered += at + size - max(at, end)
            end = at + size
    return covered


def _line_hash(words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words).lower().translate(_DIGITS)) - 2**63


def measured(text: bytes) -> tuple[int, int, int, int, int, list[tuple[int, int]]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and (hash, words) of each different line."""
    words = text.split()
    seen, dup, lines = set(), 0, Counter()
    for line in text.split(b"\n"):
        in_line = line.split()
        if in_line:
            dup += line in seen
            seen.add(line)
            lines[_line_hash(in_line)] += len(in_line)
    return (
        len(words),
        len(text.translate(None, _SPACE + _TAILS)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        dup,
        repeated_words(words),
        list(lines.items()),
    )


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("host"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
        F.col("text").cast("binary").alias("text"),
    )


def measure(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, host, mark (hash of the text), the counts, and its lines as (line, words)."""

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines_type = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))
        for batch in batches:
            found = [measured(t.as_py() or b"") for t in batch.column("text")]
            arrays = [pa.array([f[i] for f in found], pa.int64()) for i in range(5)]
            lines = pa.array([[{"line": a, "words": n} for a, n in f[5]] for f in found], lines_type)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), batch.column("mark"), *arrays, lines],
                ["doc_id", "host", "mark", *names, "lines"],
            )

    rows = _rows(documents)
    return rows.mapInArrow(
        run,
        "doc_id long, host string, mark long, " + ", ".join(f"{n} long" for n in names) + ", lines array<struct<line:long,words:long>>",
    )


def _above_limit(pages: DataFrame, share: float, few: int) -> DataFrame:
    """(host, mark, line, words): the lines of each page that are above the limit of its host."""
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_host"))
    lines = pages.select("host", "mark", F.inline("lines"))
    spread = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > few)
    common = spread.join(hosts, "host").where(F.col("n_docs") > F.lit(share) * F.col("n_host")).select("host", "line")
    return lines.join(common, ["host", "line"])


def judge(documents: DataFrame, share: float = SHARE, few: int = FEW) -> DataFrame:
    """The counts of every document with base_failed, n_removed_words, kept and the hashes of its removed lines."""
    rows = keep(measure(documents), "lines")
    # Lines and removals depend on the text and the host alone: each pair is treated once.
    pages = keep(rows.select("host", "mark", "lines").dropDuplicates(["host", "mark"]), "lines")
    removed = _above_limit(pages, share, few).groupBy("host", "mark").agg(
        F.sum("words").alias("n_removed_words"), F.collect_list("line").alias("removed_lines")
    )
    judged = rows.drop("lines").join(removed, ["host", "mark"], "left").withColumn(
        "n_removed_words", F.coalesce("n_removed_words", F.lit(0))
    )
    left = F.col("n_words") - F.col("n_removed_words")
    return judged.withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    ).withColumn("kept", ~F.col("base_failed") & (left >= MIN_WORDS) & (left >= REST * F.col("n_words")))


def cleaned(documents: DataFrame, share: float = SHARE, few: int = FEW) -> DataFrame:
    """(doc_id, host, text) of the kept documents, without the lines above the limit."""
    verdicts = judge(documents, share, few).where("kept").select("host", "mark", "removed_lines").dropDuplicates(["host", "mark"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("removed_lines").to_pylist()):
                drop = set(gone or ())
                texts.append(b"\n".join(x for x in text.split(b"\n") if not x.split() or _line_hash(x.split()) not in drop).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), pa.array(texts, pa.string())], ["doc_id", "host", "text"]
            )

    joined = _rows(documents).join(verdicts, ["host", "mark"])
    return joined.select("doc_id", "host", "text", "removed_lines").mapInArrow(run, "doc_id long, host string, text string")
