import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from strata.llm import phrases
from strata.llm.oracle import ORACLE
from strata.llm.queries import REGISTRY


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, longest=3, at_least=10, top=2_000):
    """Sorted rows of the contract, by counting every phrase."""
    f = defaultdict(Counter)
    total = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counted in f.items():
        chosen = {p: a for p, a in counted.items() if len(p) > 1 and a >= at_least}
        longer = defaultdict(list)
        for q, n in chosen.items():
            for size in range(2, len(q)):
                for i in range(len(q) - size + 1):
                    longer[q[i : i + size]].append(n)
        kept = []
        for p, a in chosen.items():
            score, k = min((1_000_000 * a * a // (counted[p[:k]] * counted[p[k:]]), k) for k in range(1, len(p)))
            if not any(100 * n >= 50 * a for n in longer[p]):
                kept.append((-score, -a, " ".join(p).encode(), counted[p[:k]], counted[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def answers(frame, **options):
    return sorted(tuple(r) for r in phrases.collocations(frame, **options).collect())


def sample(seed, n=400):
    rng = random.Random(seed)
    words = ["New", "york", "CITY", "é", "das", "ÄH", "a", "b", "c d", "x-y"]
    text = lambda: "".join(
        rng.choice(words) + rng.choice([" ", "  ", "\t", " ", " ", ", ", ".", "\n", "? "]) for _ in range(rng.randint(0, 40))
    )
    rows = [(rng.choice(["en", "de", "", None]), text()) for _ in range(n)]
    rows += [("en", None), (None, ""), ("en", "hot spot of all " * 3_000), ("und", "tie one tie two " * 10), ("en", "same same same " * 40)]
    return rows


@pytest.mark.parametrize("options", [{}, {"entries": 40}, {"max_words": 2}, {"max_words": 2, "at_least": 5, "top": 20}])
def test_phrases_match_brute_force(spark, options):
    rows = sample(1)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    limits = {"longest": options.get("max_words", 3), "at_least": options.get("at_least", 10), "top": options.get("top", 2_000)}
    assert answers(frame, **options) == brute(rows, **limits)


def test_bursts_slices_and_small_vocabularies(spark, monkeypatch):
    """Small limits take every branch: bursting, slices of a piece, full vocabularies."""
    documents = spark.createDataFrame(sample(2), "lang string, text string").selectExpr(
        "coalesce(lang, 'und') AS lang", "cast(coalesce(text, '') AS binary) AS body"
    )
    want = Counter()
    for r in phrases.runs(documents, 3, every_bit(spark)).collect():
        want[r.lang, r.prefix, r.rest] += r.n
    rows = [(r.lang, bytes(r.body)) for r in documents.collect()]
    for words, size, burst, everything in ((16, 7, 4, False), (300, 50, 2, True), (7, 1, 100_000, True), (99, 9_999, 1, False)):
        monkeypatch.setattr(phrases, "WORDS", words)
        monkeypatch.setattr(phrases, "SLICE", size)
        got, readers = Counter(), {}
        for lang, body in rows:
            one = readers.get(lang)
            if one is None:
                one = readers[lang] = phrases.Reader(lang, 3, np.full(phrases.TABLE // 8, 255, np.uint8))
                one.trie.burst = burst
            for _ in one.read(body):
                add(got, one.settle(everything))
                add(got, one.runs(len(one.trie) // 2))
        for one in readers.values():
            add(got, one.settle(True))
            assert len(one.trie) == 0
        assert got == want


def test_many_languages_and_words(spark, monkeypatch):
    rows = [(f"l{i % 700}", f"w{i % 900} w{i % 5} w{i % 7}, x") for i in range(9_000)]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    assert answers(frame, at_least=3) == brute(rows, at_least=3)


def add(counts, batches):
    for batch in batches:
        rows = batch.to_pylist()
        order = [[w.encode() for w in (*r["prefix"].split(" "), r["rest"])] for r in rows]
        assert order == sorted(order)
        for r in rows:
            counts[r["lang"], r["prefix"], r["rest"]] += r["n"]


def every_bit(spark):
    return spark.sparkContext.broadcast(b"\xff" * (phrases.TABLE // 8))


def test_bits_agree_between_table_and_texts(spark):
    frequent = spark.createDataFrame([("en", "a b"), ("de", "ä b"), ("en", "b a")], "lang string, phrase string")
    table = np.frombuffer(phrases._table(frequent, 2).value, np.uint8)
    assert np.unpackbits(table).sum() == 3
    reader = phrases.Reader("en", 3, table)
    assert not list(reader.read(b"a b a c a b"))
    assert not list(reader.settle())
    assert [r["prefix"] + " " + r["rest"] for b in reader.runs(0) for r in b.to_pylist()] == ["a b a"]


def test_odd_tables(spark):
    frame = spark.createDataFrame(sample(3), "lang string, text string")
    assert phrases.collocations(frame.limit(0)).count() == 0
    wide = frame.selectExpr("lang", "text", "1 AS n", "2 AS phrase", "3 AS prefix", "4 AS body")
    assert answers(wide) == answers(frame)
    assert answers(frame.where("text = ''")) == []


def test_whole_table_matches_sql_and_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    got = sorted(tuple(r) for r in REGISTRY["op13_phrases"](spark, sf).collect())
    assert got == brute([(r.lang, r.text) for r in documents.collect()])
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == sorted(duckdb.sql(ORACLE["op13_phrases"]).fetchall())
