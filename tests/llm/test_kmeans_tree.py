from collections import defaultdict

import numpy as np
import pytest

from strata.llm import kmeans_tree
from strata.llm.queries import REGISTRY


def brute(ids, points, asked, k=10):
    out = {}
    for q in asked:
        d = np.sqrt(((points - points[ids.index(q)]) ** 2).sum(axis=1))
        order = sorted((x, i) for x, i in zip(d, ids) if i != q)
        out[q] = order[:k]
    return out


def test_recall_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, points = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    truth = brute(ids, points, [i for i in ids if i % 100 == 0])
    got = defaultdict(list)
    for r in REGISTRY["op2_kmeans_tree"](spark, sf).collect():
        got[r.query_id].append((r.rank, r.score, r.vec_id))
    assert got.keys() == truth.keys()
    hits = []
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert [(s, v) for _, s, v in found] == sorted((s, v) for _, s, v in found)
        for _, s, v in found:
            assert s == pytest.approx(float(np.linalg.norm(points[ids.index(q)] - points[ids.index(v)])), rel=1e-12)
        hits.append(len({v for _, _, v in found} & {v for _, v in truth[q]}) / 10)
    assert np.mean(hits) >= 0.9


def test_best_bin_first_visits_every_leaf_once():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(700, 5))
    tree = kmeans_tree.grow(points, leaf=16)
    visits = list(tree.visits(points[3]))
    assert sorted(visits) == list(range(tree.n_leaves)) and tree.n_leaves > 20
    assert kmeans_tree.grow(np.ones((500, 3))).n_leaves == 1


def test_few_equal_null_and_broken_vectors(spark):
    rows = [(100 * i, [1.0, 2.0], "x") for i in range(40)] + [(i, [1.0, 2.0], "x") for i in range(1, 40)]
    rows += [(7_001, [0.0, 3.0], None), (7_100, [0.0, 3.0], None), (7_100, [0.0, 3.0], None), (7_200, None, None), (7_300, [0.0, 0.0], None)]
    rows += [(7_400, [float("nan"), 1.0], None), (7_500, [None, 1.0], None), (7_600, [float("inf"), 1.0], None), (None, [1.0, 1.0], None), (7_700, [1.0], None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, entry string")
    got = defaultdict(list)
    for r in kmeans_tree.search(frame, frame.where("vec_id % 100 = 0")).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    good = sorted({i for i, e, _ in rows if i is not None and e in ([1.0, 2.0], [0.0, 3.0])})
    assert got.keys() == {i for i in good if i % 100 == 0}
    assert sorted(got[100]) == [(n + 1, v, 0.0) for n, v in enumerate([i for i in good if i != 100 and i < 7_000][:10])]
    assert sorted(got[7_100])[:2] == [(1, 7_001, 0.0), (2, 0, pytest.approx(2**0.5))]
    three = spark.createDataFrame([(100, [1.0]), (1, [5.0]), (2, [-4.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in kmeans_tree.search(three, three.where("vec_id = 100")).collect()) == [(100, 1, 1, 4.0), (100, 2, 2, 5.0)]
    assert kmeans_tree.search(frame.limit(0), frame).count() == 0
