"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features are the lower-cased words of a whole text and their prefixes of four to six letters
(``^pref``), valued 2n / (1 + n) for n occurrences. Labels say toxic or not; the grades are 0 for clean and 1 to
3 for toxic, by the thirds of how much of the toxic vocabulary a labelled text holds. The
model has one weight per feature, shared by all thresholds: P(grade >= k) = sigmoid(w.x - t_k)
with t_1 < t_2 < t_3. The score is the expected grade, the sum of these probabilities.

The fit sees at most ``SAMPLE`` labelled documents of each class (those with the smallest hash of
their id), weighted back to the classes' true shares. Everything else sees every row.

Nulls and odd rows: a null or empty text has no features and gets the baseline severity. Null
labels and labels without a document are ignored; of several labels for one document the highest
counts. With no labelled document of one class there is no model and every severity is 0. Repeated
rows are scored each; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import keep, own_column

#: Labelled documents of each class that the fit may see.
SAMPLE = 6_000
#: Features the model may have.
FEATURES = 4_096
GRADES = 3
#: How many times as frequent in one class as in the other a feature has to be.
RATIO = 4.0
#: In which share of the documents of that class it has to be at least.
SPREAD = 0.03
#: Documents of this expected severity or more are toxic.
CUT = 0.5
_WORD = re.compile(r"\w+")
_PREFIXES = (4, 5, 6)


def features(text: str | None) -> Counter:
    words = Counter(_WORD.findall((text or "").lower()))
    found = Counter(words)
    for word, n in words.items():
        for size in _PREFIXES:
            if len(word) > size:
                found["^" + word[:size]] += n
    return found


def saturated(n: int) -> float:
    """What n occurrences count: 1 for one, towards 2 for many, so that a repeated word decides nothing alone."""
    return 2 * n / (1 + n)


@dataclass(frozen=True)
class Model:
    """Feature weights and rising thresholds; without features every severity is the baseline."""

    index: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, text: str | None) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, 3."""
        if not len(self.thresholds):
            return np.zeros(GRADES)
        score, index = 0.0, self.index
        for name, n in features(text).items():
            at = index.get(name)
            if at is not None:
                score += self.weights[at] * saturated(n)
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -60, 60)))


NO_MODEL = Model({}, np.zeros(0), np.zeros(0))


def cumulative_link(
    rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, share: np.ndarray,
    n_features: int, l2: float = 1e-4, steps: int = 600, rate: float = 0.05,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of largest penalised likelihood, by full-batch Adam.

    (rows, cols, values) is the sparse matrix, ``share`` each row's weight. The thresholds are a
    first one and positive gaps, so their order holds throughout.
    """
    share = share / share.sum()
    n_rows = len(grades)
    theta = np.zeros(n_features + GRADES)
    theta[n_features] = 2.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    one_hot = np.arange(GRADES + 1) == grades[:, None]
    for step in range(1, steps + 1):
        weights, free = theta[:n_features], theta[n_features:]
        gaps = np.exp(free[1:])
        cuts = np.concatenate([free[:1], free[0] + np.cumsum(gaps)])
        score = np.bincount(rows, values * weights[cols], n_rows) if len(rows) else np.zeros(n_rows)
        below = 1 / (1 + np.exp(np.clip(score[:, None] - cuts, -60, 60)))
        slope = below * (1 - below)
        edges = np.concatenate([np.zeros((n_rows, 1)), below, np.ones((n_rows, 1))], axis=1)
        likely = np.maximum((np.diff(edges, axis=1) * one_hot).sum(axis=1), 1e-12)
        upper, lower = slope * one_hot[:, :-1], slope * one_hot[:, 1:]
        by_cut = (upper - lower) * (share / likely)[:, None]
        by_score = -by_cut.sum(axis=1)
        to_cuts = by_cut.sum(axis=0)
        grad = np.empty_like(theta)
        grad[:n_features] = -np.bincount(cols, values * by_score[rows], n_features) + l2 * weights
        grad[n_features] = -to_cuts.sum()
        grad[n_features + 1 :] = -np.cumsum(to_cuts[::-1])[::-1][1:] * gaps
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    free = theta[n_features:]
    return theta[:n_features], np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])


def _labelled(documents: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """(toxic, text) of the sampled labelled documents, and how many labels each class has."""
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("is_toxic"))
    )
    totals = {r.is_toxic: r["count"] for r in known.groupBy("is_toxic").count().collect()}
    chosen = [
        known.where(F.col("is_toxic") == c).orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
        for c in (0, 1)
    ]
    # At most 2 * sample rows of 12 bytes: small enough to send to every task.
    few = F.broadcast(chosen[0].unionByName(chosen[1]))
    doc = documents.select(F.col("doc_id").cast("long").alias("label_id"), "text")
    return doc.join(few, "label_id").select("label_id", "is_toxic", "text"), totals


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    chosen, totals = _labelled(documents, labels, sample)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label_id"), batch.column("is_toxic"), pa.array([list(f) for f in found], pa.list_(pa.string())),
                 pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))],
                ["label_id", "is_toxic", "names", "counts"],
            )

    rows = keep(chosen.mapInArrow(counted, "label_id long, is_toxic int, names array<string>, counts array<int>"), "toxicity")
    sizes = {r.is_toxic: r["count"] for r in rows.groupBy("is_toxic").count().collect()}
    if min(sizes.get(0, 0), sizes.get(1, 0)) == 0:
        return NO_MODEL
    spread = (
        rows.select("is_toxic", F.explode("names").alias("name"))
        .groupBy("name")
        .agg(F.sum("is_toxic").alias("bad"), F.count(F.lit(1)).alias("both"))
        .where("both >= 3")
    )
    spread = keep(spread, "toxicity")
    bad, good = float(sizes[1]), float(sizes[0])
    term = lambda seen, total, odds: f"CASE WHEN {seen} > 0 THEN {seen} * ln({seen} / ({total} * {odds})) ELSE 0 END"
    share = f"(both / {bad + good})"
    surprise = F.expr(
        "2 * (" + " + ".join([
            term("bad", bad, share), term("(both - bad)", good, share),
            term(f"({bad} - bad)", bad, f"(1 - {share})"), term(f"({good} - both + bad)", good, f"(1 - {share})"),
        ]) + ")"
    )
    # The bar rises with the number of features tested, so that chance alone passes few.
    bar = 2 * np.log(max(2, spread.count()))
    best = (
        spread.withColumn("surprise", surprise)
        .where(F.col("surprise") >= float(bar))
        # Copies of one document make its words look telling; a telling word is common in its class and rare elsewhere.
        .where((F.col("bad") >= SPREAD * bad) | (F.col("both") - F.col("bad") >= SPREAD * good))
        .where(F.abs(F.ln((F.col("bad") + 0.5) / (bad + 1)) - F.ln((F.col("both") - F.col("bad") + 0.5) / (good + 1))) >= float(np.log(RATIO)))
        .orderBy(F.desc("surprise"), "name")
        .limit(FEATURES)
        .collect()
    )
    if not best:
        return NO_MODEL
    index = {r.name: i for i, r in enumerate(best)}
    leans = np.array([r.bad / bad > (r.both - r.bad) / good for r in best])
    # Only the chosen features of the sampled rows come to the driver.
    picked = F.broadcast(rows.sparkSession.createDataFrame([(n,) for n in index], "name string"))
    held = (
        rows.select("label_id", "is_toxic", F.explode(F.arrays_zip("names", "counts")).alias("p"))
        .select("label_id", "is_toxic", F.col("p.names").alias("name"), F.col("p.counts").alias("n"))
        .join(picked, "name")
        .groupBy("label_id", "is_toxic")
        .agg(F.collect_list(F.struct("name", "n")).alias("pairs"))
    )
    held = rows.select("label_id", "is_toxic").distinct().join(held, ["label_id", "is_toxic"], "left")
    return _fit_rows(held.orderBy("label_id").collect(), index, leans, totals, sizes)


def _fit_rows(held: Iterable, index: dict[str, int], leans: np.ndarray, totals: dict, sizes: dict) -> Model:
    row, col, value, toxic = [], [], [], []
    for i, r in enumerate(held):
        toxic.append(r.is_toxic)
        for name, n in sorted(r.pairs or []):
            row.append(i)
            col.append(index[name])
            value.append(saturated(n))
    rows, cols, values = np.array(row, int), np.array(col, int), np.array(value, float)
    is_toxic = np.array(toxic)
    held_bad = np.bincount(rows, values * leans[cols], len(is_toxic)) if len(rows) else np.zeros(len(is_toxic))
    limits = np.quantile(held_bad[is_toxic == 1], [1 / 3, 2 / 3])
    grades = np.where(is_toxic == 1, 1 + np.searchsorted(limits, held_bad, side="left"), 0)
    share = np.where(is_toxic == 1, totals[1] / sizes[1], totals[0] / sizes[0])
    weights, thresholds = cumulative_link(rows, cols, values, grades, share, len(index), l2=1e-5, steps=1_200)
    return Model(index, weights, thresholds)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, p_mild, p_severe, p_extreme, severity) per document; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.array([model.at_least(t.as_py()) for t in batch.column("text")]).reshape(-1, GRADES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(p[:, k]) for k in range(GRADES)), pa.array(p.sum(axis=1))],
                ["doc_id", "p_mild", "p_severe", "p_extreme", "severity"],
            )

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, p_mild double, p_severe double, p_extreme double, severity double")


def without_toxic(documents: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The documents whose expected severity is below the cut, with their own columns."""
    text = own_column(documents, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keeps = [bool(model.at_least(t.as_py()).sum() < cut) for t in batch.column(text)]
            yield batch.filter(pa.array(keeps, pa.bool_())).drop_columns([text])

    rows = documents.withColumn(text, F.col("text").cast("string"))
    return rows.mapInArrow(run, T.StructType(documents.schema.fields))
