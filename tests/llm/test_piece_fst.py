import numpy as np
import pytest
import sentencepiece

from strata.llm import piece_fst
from strata.llm.queries import REGISTRY

ODD = ["", " ", "Hello world", " a  b\n\tc ", "ééñ 你好 😀", "▁x ▁", "a\u0000b", "ﬁ ½ Å", "x" * 3_000, "ab" * 2_000, " " * 500 + "q", "\U0010ffff", "<s> </s> <unk> <0x0A>", "don't   stop"]


@pytest.fixture(scope="module")
def machine():
    with open(piece_fst.MODEL, "rb") as file:
        return piece_fst.Machine(file.read())


def test_odd_texts_match_the_library(machine):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_fst.MODEL)
    for text in ODD:
        assert machine.encode(text).tolist() == library.encode(text)
        assert machine.decode(machine.encode(text)) == library.decode(library.encode(text))


def test_pair_acceptor_matches_merging(machine):
    rng = np.random.default_rng(0)
    usable = [i for t, i in machine.arcs.items() if len(t) > 1]
    for left, right in rng.choice(usable, (3_000, 2)):
        a, b = machine.texts[left], machine.texts[right]
        assert machine.follows(int(left), int(right)) == (machine.merged(a + b)[0] == [a, b])


def test_whole_table_matches_the_library_and_comes_back(spark):
    sf = "/root/testdata/sf0.01"
    library = sentencepiece.SentencePieceProcessor(model_file=piece_fst.MODEL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tokens = REGISTRY["op5_sentencepiece"](spark, sf)
    rows = tokens.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id] or "") and r.n_tokens == len(r.ids)
        assert r.n_byte_tokens == sum(library.is_byte(i) for i in r.ids)
        assert r.round_trip
    back = {r.doc_id: r.text for r in piece_fst.detokenise(tokens).collect()}
    assert back == {d: t or "" for d, t in texts.items()}


def test_unigram_path_is_the_cheapest():
    def field(number, kind, body):
        return bytes([number << 3 | kind]) + (bytes([len(body)]) + body if kind == 2 else body)

    def piece(text, score, kind=1):
        return field(1, 2, field(1, 2, text.encode()) + field(2, 5, np.float32(score).tobytes()) + field(3, 0, bytes([kind])))

    model = piece("<unk>", 0, 2) + b"".join(piece(t, s) for t, s in [("▁", -2), ("a", -3), ("b", -3), ("ab", -5), ("▁a", -4), ("ba", -1)])
    machine = piece_fst.Machine(model + field(2, 2, field(3, 0, b"\1")) + field(3, 2, field(3, 0, b"\1") + field(4, 0, b"\0")))
    assert [machine.texts[i] for i in machine.encode("aba")] == ["▁a", "ba"]
    assert [machine.texts[i] for i in machine.encode("abz")] == ["▁", "ab", "<unk>"]
    ruled = piece_fst.Machine(model + field(2, 2, field(3, 0, b"\1")), {"ä": "a"})
    assert ruled.encode("äbä").tolist() == ruled.encode("aba").tolist()


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, None, 1), (1, None, 2), (None, "a▁b", 3), (2, "", None)], "doc_id long, text string, ids int")
    got = sorted(((r.doc_id, r.n_tokens, r.round_trip) for r in piece_fst.tokenise(frame).collect()), key=str)
    assert got == sorted([(1, 0, True), (1, 0, True), (None, len(piece_fst._machine(open(piece_fst.MODEL, "rb").read()).encode("a b")), False), (2, 0, True)], key=str)
    assert piece_fst.tokenise(frame.limit(0)).count() == 0
