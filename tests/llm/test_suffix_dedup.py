import hashlib
import random
from collections import Counter

from strata.llm import suffix_dedup
from strata.llm.queries import REGISTRY


def brute(texts, length):
    """[(n_bytes, n_removed, n_spans, sha)] by counting every string."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        rest = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), len(t) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return out


def answers(frame, **options):
    rows = suffix_dedup.report(frame, **options).collect()
    return sorted(((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in rows), key=str)


def test_planted_repeats_match_brute_force(spark):
    rng = random.Random(11)
    fresh = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, line, base = fresh(900), fresh(330), fresh(3_000)
    texts = [fresh(rng.randint(0, 2_500)) for _ in range(12)]
    texts += [fresh(700) + passage[:k] + fresh(500) for k in (380, 395, 401, 450, 899)]
    texts += [fresh(300) + line + fresh(400) for _ in range(8)]
    texts += [base[:i] + "Z" + base[i + 1 :] for i in (5, 500, 1_500, 1_501, 2_990)] + [base] * 3
    texts += ["x" * 1_500, "xy" * 800, fresh(450) * 3, "a" * 400, "a" * 399, "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert answers(frame) == sorted(enumerate(brute([(t or "").encode() for t in texts], 400)), key=str)


def test_whole_table_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip((r.doc_id for r in rows), brute([(r.text or "").encode() for r in rows], 400)))
    got = REGISTRY["op7_suffix_dedup"](spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    assert len(got) == len(rows)


def test_repeated_rows_nulls_and_extra_columns(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abc") for _ in range(500))
    rows = [(1, text, "r", b"b"), (1, text, "r", None), (None, text + "tail", None, None), (2, None, "m", None), (3, "short", "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _ranges string, _body binary")
    assert answers(frame) == sorted(zip([r[0] for r in rows], brute([(r[1] or "").encode() for r in rows], 400)), key=str)
    cut = suffix_dedup.remove(frame)
    assert cut.columns == frame.columns
    assert sorted((r.text for r in cut.collect()), key=str) == sorted(["", "", "tail", None, "short"], key=str)
    assert suffix_dedup.report(frame.limit(0)).count() == 0


def test_long_text_is_hashed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 2_048)
    rng = random.Random(4)
    part = bytes(rng.choice(b"abcd") for _ in range(3_000))
    data = [part + bytes(rng.choice(b"abcd") for _ in range(9_000)), bytes(rng.choice(b"abcd") for _ in range(700)) + part]
    groups = list(suffix_dedup._groups([len(d) for d in data], 400))
    starts = sorted((row, p) for g in groups for row, a, b in g for p in range(a, b - 399))
    assert starts == [(row, p) for row, d in enumerate(data) for p in range(len(d) - 399)]


def test_passages_of_over_50_words_are_caught(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (51, 55, 60, 90)]
    rows = [(i, f"{text(60 + i)} {passages[i % 4]} {text(30 + i)}") for i in range(24)]
    rows += [(100 + i, text(120)) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in suffix_dedup.remove(frame, suffix_dedup.PASSAGE).collect()}
    assert not any(p in t for t in got.values() for p in passages)
    assert all(got[i] == t for i, t in rows if i >= 100)
    # What comes out is what counting every string gives.
    want = dict(zip((i for i, _ in rows), brute([t.encode() for _, t in rows], suffix_dedup.PASSAGE)))
    report = suffix_dedup.report(frame, suffix_dedup.PASSAGE).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in report} == want
    whole = spark.createDataFrame(rows + [(200 + i, t) for i, t in rows], frame.schema)
    assert all(r.n_removed == r.n_bytes for r in suffix_dedup.report(whole, suffix_dedup.PASSAGE).collect())
