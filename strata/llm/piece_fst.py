"""SentencePiece encoding and decoding as a shortest path through a weighted transducer.

Three machines are compiled from a model file. The normaliser sets the dummy prefix and writes spaces as the
model's space mark, after any replacement rules given. The lexicon reads characters and writes pieces, each arc at
a weight. The byte fallback reads a character that is no piece and writes the pieces of its UTF-8 bytes. They are
composed with an input as the path is searched: the arcs that read on from a position are followed, and
of the paths to a position the least sum of weights (the tropical semiring) is kept.

A unigram model's arcs weigh the negated scores. A BPE model is ordered merges, which no sum of weights says; it is a
further machine that accepts a sequence of pieces if each two neighbours, written out and merged in the
model's order, give these two pieces again. A string has one accepted sequence, so there the arcs weigh nothing,
the shortest path is the only finite one, and it is what merging gives.

No piece continues behind a space mark that follows another character, so an input falls apart into words that are
searched on their own; a bounded table in each worker remembers their answers.

Decoding runs the machines backwards: pieces to characters and bytes, marks to spaces, without the prefix. Text that
holds the mark itself comes back with a space, which ``round_trip`` reports.

Nulls and odd rows: a null or empty text has no tokens. Repeated rows get a row each. An empty table gives no
rows. Only doc_id and text are read. Texts are encoded where they are read; nothing is shuffled. The model
file is read on the driver and its bytes, half a megabyte, go to the tasks.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Fixed values of the model format: piece kinds and model types.
_NORMAL, _UNKNOWN, _CONTROL, _DEFINED, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2
#: Words and pairs of pieces a worker remembers, and the longest word.
_WORDS, _PAIRS, _LONG = 250_000, 300_000, 48


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a message in the model file's format."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at : at + size]
            at += size


class _Words(dict):
    """The packed ids of each word, searched when first asked for."""

    def __init__(self, machine: Machine) -> None:
        super().__init__()
        self.machine = machine

    def __missing__(self, word: str) -> bytes:
        packed = np.array(self.machine.path(word), "<i4").tobytes()
        if len(word) <= _LONG:
            if len(self) >= _WORDS:
                self.clear()
            self[word] = packed
        return packed


class Machine:
    """The composed transducer of one model."""

    def __init__(self, model: bytes, rules: dict[str, str] | None = None) -> None:
        self.texts: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        self.model_type, self.prefix, self.squeeze, self.escape, self.fallback = _UNIGRAM, True, True, True, False
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.texts.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, _NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
                self.model_type, self.fallback = trainer.get(3, _UNIGRAM), bool(trainer.get(35, 0))
            elif number == 3:
                normaliser = dict(_fields(value))
                if normaliser.get(2):
                    raise ValueError("a compiled character map is not supported; give its rules instead")
                self.prefix, self.squeeze, self.escape = (bool(normaliser.get(k, 1)) for k in (3, 4, 5))
        if self.model_type not in (_UNIGRAM, _BPE):
            raise ValueError("only unigram and BPE models have a lexicon of scored pieces")
        usable = [i for i, k in enumerate(self.kinds) if k in (_NORMAL, _DEFINED)]
        self.arcs = {self.texts[i]: i for i in usable}
        self.lexicon: dict = {}
        for text, piece in self.arcs.items():
            node = self.lexicon
            for char in text[:-1]:
                node = node.setdefault(char, ({}, -1))[0]
            node[text[-1]] = (node.get(text[-1], ({}, -1))[0], piece)
        self.scores, self.weights = scores, [-s for s in scores]
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == _UNKNOWN), 0)
        self.bytes = {int(self.texts[i][3:5], 16): i for i, k in enumerate(self.kinds) if k == _BYTE}
        if any(MARK in t.lstrip(MARK) for t in self.arcs):
            self.words = re.compile(r".+", re.S)
        else:
            self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.rules = rules or {}
        self.find_rule = re.compile("|".join(map(re.escape, sorted(self.rules, key=len, reverse=True)))) if self.rules else None
        self.pairs: dict[tuple[int, int], bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.known = _Words(self)
        said = [MARK if k in (_UNKNOWN,) else t for t, k in zip(self.texts, self.kinds)]
        self.spoken = [
            b"" if k == _CONTROL else bytes([int(t[3:5], 16)]) if k == _BYTE else t.replace(MARK, " ").encode()
            for t, k in zip(said, self.kinds)
        ]

    def normalised(self, text: str) -> str:
        if self.find_rule:
            text = self.find_rule.sub(lambda m: self.rules[m[0]], text)
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if self.prefix and text:
            text = " " + text
        return text.replace(" ", MARK) if self.escape else text

    def merged(self, text: str) -> tuple[list[str], str]:
        """The pieces of a string by merging the best neighbours first, the leftmost of equals; the last left part."""
        parts, left = list(text), ""
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.arcs.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], i
            if best is None:
                return parts, left
            left = parts[at]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _edge(self, piece: int, right: bool) -> list[tuple[str, float, float]]:
        """How the right (or left) end of a piece grows: its parts there as (text, made at, merged at), last first.

        Times are scores, which fall as merging goes on. Empty if merging never makes the piece.
        """
        known = self.edges[right].get(piece)
        if known is None:
            known, text, until = [], self.texts[piece], float("-inf")
            while text:
                score = self.scores[self.arcs[text]] if len(text) > 1 else float("inf")
                known.append((text, score, until))
                if len(text) == 1:
                    break
                parts, left = self.merged(text)
                if parts != [text]:
                    known = []
                    break
                text, until = (text[len(left) :] if right else left), score
            self.edges[right][piece] = known
        return known

    def follows(self, left: int, right: int) -> bool:
        """Whether the merge order leaves the two pieces side by side.

        It does not if two parts that stand at the border at the same time form a piece that
        is due before either is merged inwards; of equal pieces the left one is merged first.
        """
        found = self.pairs.get((left, right))
        if found is not None:
            return found
        if len(self.pairs) >= _PAIRS:
            self.pairs.clear()
        ends, heads = self._edge(left, True), self._edge(right, False)
        i = j = 0
        found = bool(ends and heads)
        while found:
            (a, a_made, a_until), (b, b_made, b_until) = ends[i], heads[j]
            piece = self.arcs.get(a + b)
            if piece is not None and self.scores[piece] > a_until and self.scores[piece] >= b_until:
                found = False
            elif a_made <= b_made and i + 1 < len(ends):  # back in time: the part made later goes first
                i += 1
            elif j + 1 < len(heads):
                j += 1
            elif i + 1 < len(ends):
                i += 1
            else:
                break
        self.pairs[left, right] = found
        return found

    def _arcs_at(self, word: str, start: int) -> list[tuple[int, int]]:
        """(end, piece) of the arcs that read on from a position, the longest last; piece -1 is the byte fallback."""
        found: list[tuple[int, int]] = []
        node = self.lexicon
        for end in range(start, len(word)):
            step = node.get(word[end])
            if step is None:
                break
            node, piece = step
            if piece >= 0:
                found.append((end + 1, piece))
        if not found or found[0][0] > start + 1:
            found.insert(0, (start + 1, -1))
        return found

    def path(self, word: str) -> list[int]:
        """The ids along the shortest path that reads the word."""
        return self._ordered_path(word) if self.model_type == _BPE else self._weighted_path(word)

    def _weighted_path(self, word: str) -> list[int]:
        cost = [0.0] + [float("inf")] * len(word)
        came = [(0, -1)] * (len(word) + 1)
        for start in range(len(word)):
            for end, piece in self._arcs_at(word, start):
                # Bytes are dearer than any path of pieces, so that they are taken only where they have to be.
                total = cost[start] + (self.weights[piece] if piece >= 0 else 1e6)
                if total < cost[end]:
                    cost[end], came[end] = total, (start, piece)
        steps, end = [], len(word)
        while end:
            steps.append((came[end][1], end))
            end = came[end][0]
        return self._written(word, steps[::-1])

    def _ordered_path(self, word: str) -> list[int]:
        """All accepted paths weigh the same and there is one: found depth first, the longest arcs first."""
        pairs, n = self.pairs, len(word)
        steps: list[tuple[int, int]] = []
        open_arcs = [self._arcs_at(word, 0)]
        dead: set[tuple[int, int]] = set()
        last, at = -1, 0
        while at < n:
            arcs = open_arcs[-1]
            while arcs:
                end, piece = arcs.pop()
                if last >= 0 and piece >= 0:
                    follows = pairs.get((last, piece))
                    if follows is None:
                        follows = self.follows(last, piece)
                    if not follows:
                        continue
                if dead and (piece, end) in dead:
                    continue
                steps.append((piece, end))
                last, at = piece, end
                if end < n:
                    open_arcs.append(self._arcs_at(word, end))
                break
            else:
                if not steps:
                    raise ValueError(f"no accepted path reads {word[:40]!r}")
                dead.add(steps.pop())
                open_arcs.pop()
                last, at = steps[-1] if steps else (-1, 0)
        return self._written(word, steps)

    def _written(self, word: str, steps: list[tuple[int, int]]) -> list[int]:
        ids: list[int] = []
        for piece, end in steps:
            if piece >= 0:
                ids.append(piece)
            else:
                ids += self._spelt(word[end - 1])
        return ids

    def _spelt(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode()] if self.fallback else [self.unknown]

    def encode(self, text: str) -> np.ndarray:
        words = self.words.findall(self.normalised(text))
        return np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.spoken.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_MACHINES: dict[int, Machine] = {}


def _machine(model: bytes) -> Machine:
    """One machine per model and worker, so that its tables outlive a task."""
    key = hash(model)
    if key not in _MACHINES:
        _MACHINES[key] = Machine(model)
    return _MACHINES[key]


def tokenise(documents: DataFrame, model_path: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, n_byte_tokens, ids, round_trip) per document."""
    with open(model_path, "rb") as file:
        model = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(model)
        is_byte = np.array(machine.kinds) == _BYTE
        for batch in batches:
            found, same = [], []
            for text in batch.column("text").to_pylist():
                ids = machine.encode(text or "")
                found.append(ids)
                same.append(machine.decode(ids) == (text or ""))
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found) if found else np.zeros(0, np.int32)))
            counts = [pa.array([len(i) for i in found], pa.int64()), pa.array([int(is_byte[i].sum()) for i in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, ids, pa.array(same, pa.bool_())],
                ["doc_id", "n_tokens", "n_byte_tokens", "ids", "round_trip"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_byte_tokens long, ids array<int>, round_trip boolean")


def detokenise(tokens: DataFrame, model_path: str = MODEL) -> DataFrame:
    """(doc_id, text): the texts of ``ids``; null ids give null."""
    with open(model_path, "rb") as file:
        model = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(model)
        for batch in batches:
            texts = [None if ids is None else machine.decode(np.array(ids, np.int32)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
