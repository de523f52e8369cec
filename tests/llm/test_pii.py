import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from strata.llm import pii
from strata.llm.queries import REGISTRY

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, value):
    digits = [int(c) for c in value if c.isascii() and c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def slow_base(text):
    return [
        (kind, m.start(), m.end(), m.group())
        for kind, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(kind, m.group())
    ]


ODD = [
    None, "", "a@b.c_d@e.f x@y", "a@b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 007.08.0255.1 1.2.3", "é+1 (386) 555-3733é +12345678 +1-2-3-4-5-6-7-8-9-",
    "4041894974608795 4041 8949-7460 8795 4041894974608796 40418949746087951234", "ü" * 50 + " a.b%c@d-e.f.g. ", "+1 (2) 3+4 555 666 777 8", "0" * 16,
    "....@x.y a@b..c @a.b a@.b", "9" * 30_000 + " 1" * 5_000, ("x." * 20_000) + "@y.z", "a@" + "b." * 20_000 + "c", "+1" + " " * 20_000 + "5",
]


def test_base_spans_match_plain_patterns(spark):
    rng = random.Random(8)
    pieces = ["@", ".", "-", " ", "+", "(", ")", "1", "25", "255", "4041894974608795", "a", "b.c", "é", "_", "%", "+1 (386) 555-3733", "x@y.z", "10.0.0.1"]
    texts = ODD + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(3_000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = frame.select("doc_id", pii.base_spans(F.coalesce("text", F.lit(""))).alias("s")).collect()
    for r in rows:
        assert [tuple(s) for s in r.s] == slow_base(texts[r.doc_id]), texts[r.doc_id][:200]


def slow_terms(text):
    return {w for w in re.findall(r"[^\W_]+", (text or "").lower())}


def slow_disclosures(texts, support):
    entity = lambda k, v: k + ":" + (re.sub("[^0-9]", "", v) if k in ("card", "phone") else v.lower())
    held = {t: {entity(k, v) for k, _, _, v in slow_base(t)} for t in set(texts)}
    said = {t: slow_terms(t) for t in held}
    n_e = Counter(e for t in texts for e in held[t])
    n_t = Counter(w for t in texts for w in said[t])
    pairs = Counter((e, w) for t in texts for e in held[t] for w in said[t])
    backed = Counter((e, w) for t in held for e in held[t] for w in said[t])
    return {
        (e, w): math.log(n * len(texts) / (n_e[e] * n_t[w])) / math.log(len(texts) / n_e[e])
        for (e, w), n in pairs.items() if backed[e, w] >= support
    }


def test_disclosures_match_brute_force_and_take_effect(spark):
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    filler = lambda: " ".join(rng.choice(words) for _ in range(8))
    texts = [f"{filler()} {i}" for i in range(60)]
    texts += [f"{filler()} Quixote wrote to q@mail.org no{i}" for i in range(7)] + [f"{filler()} Dulcinea {'q@mail.org' if i else ''} n{i}" for i in range(9)]
    rows = list(enumerate(texts)) + [(100, texts[-1]), (None, texts[-1]), (101, None)]
    frame = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, _terms string")
    want = slow_disclosures([t or "" for _, t in rows], 5)
    got = {(r.entity, r.term): r.disclosure for r in pii.disclosures(frame).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    clean = {(r.doc_id, r.text) for r in pii.sanitise(frame).collect()}
    assert len(clean) == len({(d, t) for d, t in rows})
    assert not any("q@mail" in (t or "") or "Quixote" in (t or "") for _, t in clean)
    assert any("[EMAIL]" in (t or "") for _, t in clean) and (101, None) in clean
    assert {(d, t) for d, t in rows if d is not None and d < 60} <= clean
    assert pii.sanitise(frame).columns == frame.columns
    assert pii.sanitise(frame.limit(0)).count() == 0


def test_whole_table_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    strong = defaultdict(dict)
    for (e, w), x in slow_disclosures([t or "" for t in docs.values()], 5).items():
        if x >= pii.GENERALISE:
            strong[e][w] = x
    rows = REGISTRY["op10_pii"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = slow_base(docs[r.doc_id])
        texts = [f"{k}:{a}:{b}" for k, a, b, _ in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in PLAIN]
        assert r.base_sha256 == hashlib.sha256(",".join(texts).encode()).hexdigest()
        assert (r.spans or "").startswith(",".join(texts))
        assert bool(strong) or r.spans == ",".join(texts)


def test_terms_of_rare_entities_are_treated(spark):
    rng = random.Random(4)
    filler = lambda n=40: " ".join("".join(rng.choice("abcdefghij") for _ in range(3)) for _ in range(n))
    texts = [filler() for _ in range(900)]
    texts += [f"{filler()} Quixote wrote {filler()} don@mancha.org {filler()}" for _ in range(3)]  # one value in three texts
    texts += [f"{filler()} Acmecorp {filler()} u{i}@acme.example {filler()}" for i in range(4)]  # a domain, each value once
    texts += [f"{filler()} Branchbank {filler()} 404189{n} {filler()}" for n in ("4974608795", "0000000007", "0000000015")]
    alone = f"{filler()} Hapaxword {filler()} one@single.net {filler()}"
    copied = f"{filler()} Copyword {filler()} two@copied.net {filler()}"
    texts += [alone] + [copied] * 2 + [f"{copied} edit{i}" for i in range(3)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert pii.disclosures(frame).count() == 0  # none has five texts
    found = {(r.entity, r.term): r.disclosure for r in pii.estimates(frame).collect()}
    n = len(texts)
    assert abs(found["email:don@mancha.org", "quixote"] - (1 + math.log(2 / 3) / math.log(n / 3))) < 1e-9
    assert abs(found["email/acme.example", "acmecorp"] - (1 + math.log(3 / 4) / math.log(n / 4))) < 1e-9
    assert ("card/404189", "branchbank") in found
    assert not {t for _, t in found} & {"hapaxword", "copyword"}
    clean = {r.doc_id: r.text for r in pii.sanitise(frame).collect()}
    assert not any(w in t for t in clean.values() for w in ("Quixote", "Acmecorp", "Branchbank", "@", "404189"))
    assert sum("[TERM]" in t for t in clean.values()) == 10
    assert all(w in clean[d] for d, t in enumerate(texts) for w in ("Hapaxword", "Copyword") if w in t)


def test_an_entity_of_every_document_tells_nothing(spark):
    frame = spark.createDataFrame([(i, f"word{i} same x@y.zz") for i in range(6)], "doc_id long, text string")
    assert {r.text for r in pii.sanitise(frame).collect()} == {f"word{i} same [EMAIL]" for i in range(6)}
