import numpy as np
import pytest

from strata.llm import toxicity
from strata.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def test_thresholds_rise_and_weights_match_a_numeric_optimum():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, size=(400, 3)).astype(float)
    latent = x @ np.array([2.0, -1.0, 0.5]) + rng.logistic(size=400)
    grades = np.digitize(latent, [1.0, 2.5, 4.0])
    r, c = np.nonzero(x)
    w, t = toxicity.cumulative_link(r, c, x[r, c], grades, np.ones(400), 3)
    assert np.all(np.diff(t) > 0)

    def loss(w, t):
        below = 1 / (1 + np.exp(x @ w)[:, None] / np.exp(t))
        edges = np.hstack([np.zeros((400, 1)), below, np.ones((400, 1))])
        return -np.log(np.diff(edges, axis=1)[np.arange(400), grades]).mean() + 5e-5 * (w @ w)

    best = loss(w, t)
    for i in range(3):
        for d in (-0.05, 0.05):
            moved = w.copy()
            moved[i] += d
            assert loss(moved, t) > best
            cut = t.copy()
            cut[i] += d
            assert loss(w, cut) > best


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark, tables):
    documents, labels = tables
    seen, unseen = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0")
    model = toxicity.fit(documents, seen)
    scored = toxicity.score(documents, model).join(unseen, "doc_id").collect()
    right = [(r.severity >= toxicity.CUT) == (r.toxic == 1) for r in scored]
    clean = [r.severity < toxicity.CUT for r in scored if r.toxic == 0]
    assert np.mean(right) >= 0.93 and np.mean(clean) >= 0.99


def test_query_and_filter_agree(spark, tables):
    documents, labels = tables
    rows = REGISTRY["op1_toxicity"](spark, SF).collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert 1 >= r.p_mild >= r.p_severe >= r.p_extreme >= 0
        assert r.severity == pytest.approx(r.p_mild + r.p_severe + r.p_extreme)
    model = toxicity.fit(documents, labels)
    kept = toxicity.without_toxic(documents, model)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.toxic}


def test_odd_rows(spark, tables):
    documents, labels = tables
    frame = spark.createDataFrame(
        [(1, None, "a"), (2, "", None), (None, "idiot moron scum trash " * 30, "b"), (3, "plain " * 50_000, None), (3, "plain", None)],
        "doc_id long, text string, severity string",
    )
    model = toxicity.fit(documents, labels)
    got = {(r.doc_id, len(r.text or "")) for r in toxicity.without_toxic(frame, model).collect()}
    assert got == {(1, 0), (2, 0), (3, 300_000), (3, 5)}
    assert toxicity.score(frame, model).count() == 5
    one_class = labels.where("toxic = 0").unionByName(spark.createDataFrame([(None, 1, 1), (5, None, None)], labels.schema))
    assert toxicity.fit(documents, one_class) is toxicity.NO_MODEL
    assert toxicity.fit(documents.limit(0), labels) is toxicity.NO_MODEL
    assert {r.severity for r in toxicity.score(frame, toxicity.NO_MODEL).collect()} == {0.0}
