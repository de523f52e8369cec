import hashlib
import random
import re
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import exact_dedup as ed
from strata.llm.queries import REGISTRY


def brute(rows):
    """Sorted (doc_id, keep_id, group_size, kept, sha) by grouping the normalised texts."""
    groups = defaultdict(list)
    for ident, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(ident)
    out = []
    for body, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(ident, ids[0], len(ids), k == 0, sha) for k, ident in enumerate(ids)]
    return sorted(out, key=str)


def answers(frame, **options):
    rows = ed.report(frame, **options).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows), key=str)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 2**20 - 1), st.integers(1, 2**40), max_size=200), st.sampled_from([20, 24, 64]))
def test_filters_give_back_what_they_hold(entries, width):
    shift = np.uint64(width - 20)
    keys = np.array(sorted(entries), np.uint64) << shift
    counts = np.array([entries[k] for k in sorted(entries)], np.int64)
    got = ed.decode(ed.encode(keys, counts, width))
    assert got[0].tolist() == keys.tolist() and got[1].tolist() == counts.tolist()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 2**64 - 1), st.integers(1, 9), max_size=60), min_size=1, max_size=6))
def test_merging_adds_up(parts):
    made = [ed.encode(np.array(sorted(p), np.uint64), np.array([p[k] for k in sorted(p)], np.int64), 64) for p in parts]
    want = defaultdict(int)
    for part in parts:
        for key, n in part.items():
            want[key] += n
    keys, counts = ed.decode(ed.merge(made, 64))
    assert dict(zip(keys.tolist(), counts.tolist())) == dict(want)
    assert keys.tolist() == sorted(want)


def test_clustered_quotients_overflow_the_table():
    keys = (np.uint64(2**64 - 1) - np.arange(500, dtype=np.uint64))[::-1]
    counts = np.arange(1, 501)
    got = ed.decode(ed.encode(keys, counts, 64))
    assert got[0].tolist() == keys.tolist() and got[1].tolist() == counts.tolist()


def test_partition_filters_merge_without_loss(spark):
    frame = spark.range(0, 200_000, numPartitions=7).select(F.xxhash64(F.col("id") % 60_000).alias("fp"))
    parts = ed.filters(frame, 3, size=5_000)
    assert parts.count() > 7 * 8
    sections = ed.merged(parts, 3)
    assert sections.count() == 8
    want = {(r.fp, r["count"]) for r in frame.groupBy("fp").count().collect()}
    assert {(r.fp, r.n) for r in ed.counts(sections, 3).collect()} == want
    assert {(r.fp, r.n) for r in ed.counts(sections, 3, 4).collect()} == {x for x in want if x[1] >= 4}
    twice = ed.counts(ed.merged(sections.union(sections), 3), 3)
    assert {(r.fp, r.n) for r in twice.collect()} == {(fp, 2 * n) for fp, n in want}


def rows_with_copies():
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "ÄÖ", "x"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))) for i in range(300)]
    rows += [(1_000 + i, "hot\tcopy \n of  a text") for i in range(150)] + [(7, "hot copy of a text"), (7, "hot copy of a text")]
    rows += [(None, "only null"), (None, "only\nnull"), (5, None), (6, ""), (8, " "), (9, "\r\n"), (10, " a"), (11, "a")]
    return rows + [(12, "long " * 200_000), (13, "long\t" * 200_000), (14, "a b"), (15, "a b")]


def test_groups_match_brute_force(spark):
    rows = rows_with_copies()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert answers(frame) == brute(rows)


def test_false_matches_are_told_apart(spark):
    rows = rows_with_copies()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert answers(frame, bits=4, section=2) == brute(rows)


def test_kept_documents_and_odd_tables(spark):
    rows = [(i, t, f"s{k}", k) for k, (i, t) in enumerate(rows_with_copies())]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _fp string, `fp.sha` long")
    kept = ed.deduplicate(frame)
    assert kept.columns == frame.columns
    want = sorted(((i, s) for i, _, _, k, s in brute([r[:2] for r in rows]) if k), key=str)
    assert sorted(((r.doc_id, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest())
                   for r in kept.collect()), key=str) == want
    assert ed.report(frame.limit(0)).count() == 0 and ed.deduplicate(frame.limit(0)).count() == 0


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = REGISTRY["op11_exact_dedup"](spark, sf).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=str) == brute(rows)
