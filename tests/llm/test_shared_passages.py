import random
import re

import numpy as np

from strata.llm import suffix_dedup
from strata.llm.queries import REGISTRY


def sharing(rows, size=51):
    """The documents with a sequence of ``size`` words that another document has."""
    first, found = {}, set()
    for row in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (row[1] or "").encode())
        for i in range(len(words) - size + 1):
            other = first.setdefault(tuple(words[i : i + size]), row)
            if other != row:
                found |= {row, other}
    return found


def verdicts(frame):
    return {((r.doc_id, r.n_bytes), r.shares_passage) for r in suffix_dedup.report(frame).collect()}


def test_planted_passages_shorter_than_400_bytes(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdéfgh") for _ in range(rng.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = {n: text(n) for n in (49, 50, 51, 52, 60, 75, 200)}
    rows = [(100 * n + i, f"{text(30 + 7 * i)} {p} {text(10 + i)}") for n, p in passages.items() for i in range(3)]
    own = text(60)
    rows += [(i, text(90)) for i in range(20)]
    rows += [(30, f"{own} {text(5)} {own}"), (31, "a " * 400), (32, "a\n" * 70), (33, "b " * 400), (34, ""), (35, None)]
    rows += [(40, passages[60].replace(" ", " \n")), (41, "z" * 9_000 + " " + own[:40]), (None, passages[75]), (None, text(80))]
    rows += [(50, "y" * 5_000 + " x" * 50), (51, "y" * 5_000 + " x" * 50 + " w"), (52, "y" * 4_999 + "v" + " x" * 50)]
    rows += [(60, same := text(70)), (60, same)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = sharing(rows)
    assert {r[0] for r in want} == {100 * n + i for n in (51, 52, 60, 75, 200) for i in range(3)} | {31, 32, 40, 50, 51, None}
    assert verdicts(frame) == {((r[0], len((r[1] or "").encode())), r in want) for r in rows}


def test_the_query_tells_them_in_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id for r in REGISTRY["op7_suffix_dedup"](spark, sf).collect() if r.shares_passage}
    assert got == {r[0] for r in sharing(rows)}


def test_words_of_long_texts_in_parts(monkeypatch):
    rng = random.Random(3)
    texts = [b" ".join(b"%d" % rng.randint(0, 10**9) for _ in range(n)) for n in (3_000, 10, 0, 700, 60)]
    texts.insert(2, b"q" * 9_000 + b" \t" + texts[0])
    whole = [sorted(zip(*(x.tolist() for x in p))) for p in suffix_dedup._word_runs(texts, suffix_dedup.Hasher(1 << 19, 1))]
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 6_000)
    hasher = suffix_dedup.Hasher(6_000, 1)
    for text in texts:
        codes, starts = suffix_dedup.words_of(np.frombuffer(text, np.uint8), hasher)
        words = text.split()
        assert len(codes) == len(words) and len(set(codes.tolist())) == len(set(words))
        assert [text[s : s + len(w)] for s, w in zip(starts, words)] == words
    monkeypatch.setattr(suffix_dedup, "_LONG", 64)
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 1_024)
    windows = lambda parts: sorted((r, f + k) for p in parts for r, _, _, f, s in p for k in range(s))
    cut = [sorted(zip(*(x.tolist() for x in p))) for p in suffix_dedup._word_runs(texts, suffix_dedup.Hasher(1 << 19, 1))]
    assert len(cut) > len(whole)
    assert windows(cut) == windows(whole) == [(r, i) for r, t in enumerate(texts) for i in range(len(t.split()) - 50)]
