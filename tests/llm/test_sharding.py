import zlib
from collections import defaultdict

from strata.llm import sharding
from strata.llm.queries import REGISTRY


def checked(rows, texts, shards):
    """Every law of the result; texts as (doc_id, text)."""
    want = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in texts), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=str) == want
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    sizes = checked(REGISTRY["op9_sharding"](spark, sf).collect(), texts, 24)
    total, largest = sum(sizes.values()), max(len((t or "").encode()) + 8 for _, t in texts)
    assert all(abs(sizes[s] - total / 24) <= largest + 0.002 * total / 24 for s in range(24))


def test_hot_text_and_sections(spark):
    rows = [(i, "hot text " * 20) for i in range(2_000)] + [(i, f"own {i} " * (i % 40)) for i in range(2_000, 5_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.shard(frame, 6, section=100).collect()
    sizes = checked(found, rows, 6)
    mean = sum(sizes.values()) / 6
    assert all(abs(v - mean) <= 400 for v in sizes.values())
    keys = sharding.splitters(sharding.keyed(frame), 6)
    assert keys == sorted(keys)
    below = sorted((r.sort_key, r["size"]) for r in sharding.keyed(frame).collect())
    for i, k in enumerate(keys, 1):
        assert abs(sum(s for key, s in below if key < k) - mean * i) <= 200
    assert not any("Python" in line for line in sharding.shard(frame, 6)._jdf.queryExecution().toString().split("\n"))


def test_odd_rows(spark):
    rows = [(1, None, 5), (1, None, 5), (None, "é", 1), (2, "", None), (3, "x" * 100_000, 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, size int")
    checked(sharding.shard(frame).collect(), [r[:2] for r in rows], 24)
    assert sharding.shard(frame.limit(0)).count() == 0
    assert {r.shard for r in sharding.shard(frame, 1).collect()} == {0}


def test_shards_are_written_with_their_documents(spark, tmp_path):
    rows = [(i, f"text {i} " * (i % 30), "n" * (i % 3), i, 7) for i in range(600)] + [(5, None, None, None, None), (None, "é", "x", 1, 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, shard long, SLOT int")
    path = str(tmp_path / "shards")
    written, shard_at, slot_at = sharding.write_shards(frame, path, 4, section=50)
    assert sorted(map(tuple, written.select("doc_id", "text", "`a.b`", "shard", "SLOT").collect()), key=str) == sorted(rows, key=str)
    assert len(list((tmp_path / "shards").glob(f"{shard_at}=*"))) == 4
    digest = {(r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in sharding.shard(frame, 4, section=50).collect()}
    own = {(r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode()), r[shard_at], r[slot_at]) for r in written.collect()}
    assert digest == own and len(own) == len(rows)
