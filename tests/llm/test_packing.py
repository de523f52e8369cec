import random
from collections import defaultdict

from strata.llm import packing
from strata.llm.queries import REGISTRY


def slow_best_fit(sizes, sources, clusters, capacity):
    bins, placed = [], []
    for size, s, c in zip(sizes, sources, clusters):
        fits = [
            (b["residual"], i) for i, b in enumerate(bins)
            if b["residual"] >= size and (s is None or s not in b["s"]) and (c is None or c not in b["c"])
        ]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"residual": capacity, "s": set(), "c": set()})
        bins[i]["residual"] -= size
        bins[i]["s"].add(s)
        bins[i]["c"].add(c)
        placed.append(i)
    return placed


def test_best_fit_is_the_tightest_compatible_bin():
    rng = random.Random(5)
    for n in (0, 1, 30, 200):
        for _ in range(6):
            sizes = sorted((rng.choice([rng.randint(1, 100), 50, 100]) for _ in range(n)), reverse=True)
            sources = [rng.choice(["hot"] * 5 + ["a", "b", "c", None]) for _ in range(n)]
            clusters = [rng.choice([7] * 60 + list(range(8, 60)) + [None]) for _ in range(n)]
            assert packing.best_fit(sizes, sources, clusters, 100) == slow_best_fit(sizes, sources, clusters, 100)


def test_whole_table_is_packed_without_conflicts(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = REGISTRY["op4_best_fit_packing"](spark, sf).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.size))
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for d, r in docs.items():
        at = 0
        for start, size in sorted(pieces[d]):
            assert start == at
            at += size
        assert at == len(r.text or "")
    for items in bins.values():
        items.sort(key=lambda r: r.position)
        assert sum(r.size for r in items) <= packing.CAPACITY
        assert [r.bin_offset for r in items] == [sum(x.size for x in items[:i]) for i in range(len(items))]
        for column in ("source", "cluster"):
            held = [r[column] for r in items if r[column] is not None]
            assert len(held) == len(set(held))


def test_odd_rows_and_texts(spark):
    rows = [(1, None, "s", 1), (2, "", None, 2), (3, "abc", "s", 3), (3, "abc", "s", 3), (None, "xé", None, 4), (5, "long " * 7_000, "t", 5), (6, "zz", None, 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = packing.pack(frame)
    held = got.collect()
    assert {r.doc_id for r in held if r.bin_id is None} == {1, 2}
    three = [r.bin_id for r in held if r.doc_id == 3]
    assert len(three) == 2 and len(set(three)) == 2
    assert sum(r.size for r in held if r.doc_id == 5) == 35_000
    texts = packing.sequences(frame.where("doc_id > 3"), packing.pack(frame.where("doc_id > 3"))).collect()
    assert sum(len(t.text.replace("\n", "")) for t in texts) == 35_002
    assert packing.pack(frame.limit(0)).count() == 0
