import math
import random
from collections import Counter

import numpy as np
import pytest

from strata.llm import whitening
from strata.llm.queries import REGISTRY


def brute(rows, components=4):
    """{row number: (n, deviation, whitened up to sign, explained)}, with exact sums."""
    taken = {}
    for i, (_, vector) in enumerate(rows):
        if vector and all(c is not None and math.isfinite(c) for c in vector):
            taken[i] = tuple(math.floor(256 * c) for c in vector)
    lengths = Counter(len(x) for x in taken.values())
    d = max(lengths, key=lambda k: (lengths[k], k))
    taken = {i: x for i, x in taken.items() if len(x) == d}
    fit = sorted(set(taken.values()))
    n, sums = len(fit), [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], dtype=object)
    covariance = np.array((centred.T @ centred), dtype=float) / n**3
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    out = {}
    for i, x in taken.items():
        c = [n * a - s for a, s in zip(x, sums)]
        w = (np.array(c, float) / n) @ vectors[:, order] / np.sqrt(values[order])
        out[i] = (n, sum(a * a for a in c), np.abs(w), values[order] / np.trace(covariance))
    return out


def check(frame, rows, components=4, **options):
    want = brute(rows, components)
    got = {}
    for r in whitening.whiten(frame, components, **options).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(got) == sorted(rows[i][0] for i in want)
    for i, (n, deviation, w, explained) in want.items():
        found = got[rows[i][0]]
        assert sorted(found) == list(range(1, components + 1))
        for k in range(components):
            r = found[k + 1]
            assert (r.n, int(r.deviation)) == (n, deviation)
            assert abs(r.whitened) == pytest.approx(w[k], rel=1e-9, abs=1e-9)
            assert r.explained == pytest.approx(explained[k], rel=1e-9)
            assert r.identity_error < 1e-9


def vectors(seed, n, d=6):
    rng = random.Random(seed)
    return [[rng.gauss(j, 1 + 2 * j) for j in range(d)] for _ in range(n)]


def test_whitening_matches_brute_force(spark):
    rows = list(enumerate(vectors(1, 700)))
    rows += [(1_000 + i, rows[3][1]) for i in range(300)]  # one vector, many rows
    rows += [(2_000, None), (2_001, []), (2_002, [1.0] * 5 + [None]), (2_003, [1.0] * 5 + [float("nan")]),
             (2_004, [float("-inf")] + [1.0] * 5), (2_005, [1.0, 2.0]), (2_006, [0.0] * 6), (2_007, [-0.001] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    check(frame, rows, block=64)
    check(frame, rows, components=2)


def test_long_vectors_take_several_column_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "COLUMNS", 4)
    rows = list(enumerate(vectors(2, 200)))
    check(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), rows, block=16)


def test_odd_tables(spark):
    rows = [(None, [1.0, 2.0]), (1, [3.0, 5.0]), (1, [3.0, 5.0]), (2, [4.0, -1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "7 AS x", "8 AS `index`", "9 AS part")
    got = whitening.whiten(frame).collect()
    assert Counter(r.vec_id for r in got) == {None: 2, 1: 4, 2: 2}
    flat = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])], "vec_id long, embedding array<double>")
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}  # no spread but along one direction
    same = whitening.whiten(flat.where("vec_id = 1"))
    none = whitening.whiten(flat.where("vec_id > 9"))
    assert same.count() == none.count() == 0
    assert same.schema == none.schema and same.columns == whitening.whiten(flat).columns


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows)
    got = REGISTRY["op12_whitening"](spark, sf).collect()
    assert len(got) == 4 * len(want)
    by_id = {rows[i][0]: v for i, v in want.items()}
    for r in got:
        n, deviation, w, explained = by_id[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(w[r.component - 1], rel=1e-8, abs=1e-9)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-9
