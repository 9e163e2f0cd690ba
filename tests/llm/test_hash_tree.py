import math
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from starpipe.llm import hash_tree
from starpipe.llm.queries import op2_hash_tree
from tests.llm.conftest import SF


def draw(key, name):
    h = xxhash.xxh64_intdigest(name.encode(), xxhash.xxh64_intdigest(key.encode(), 42))
    return math.log(((h >> 11) + 0.5) / (1 << 53))


def brute_shard(key, leaves):
    """Level by level, every child's weighted draw."""
    path = ""
    for depth in range(2, 5):
        weight = Counter()
        for x in leaves:
            full = (x.generation, x.region, x.rack, x.shard)
            name = "/".join(map(str, full[:depth]))
            if path == "" or name.startswith(path + "/"):
                weight[name] += x.weight
        path = max(weight, key=lambda n: draw(key, n) / weight[n])
    return int(path.split("/")[-1])


def test_query_against_brute_force(spark, documents):
    rows = {r.doc_id: r for r in op2_hash_tree(spark, SF).collect()}
    leaves = hash_tree.layout(24)
    assert {x.shard for x in leaves} == set(range(24)) and len({(x.region, x.rack) for x in leaves}) == 6
    docs = documents.collect()
    assert len(rows) == len(docs)
    for d in docs:
        r, data = rows[d.doc_id], d.text.encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert r.shard == brute_shard(str(d.doc_id), leaves)
        assert r.grown_shard == brute_shard(str(d.doc_id), hash_tree.grown(leaves))
    slots = {}
    for r in rows.values():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("shards", [1, 5, 24, 37])
def test_growth_takes_only_into_the_new_shard(spark, shards):
    leaves = hash_tree.layout(shards)
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    for _ in range(2):
        more = hash_tree.grown(leaves)
        new = max(x.shard for x in more)
        rows = keys.select(hash_tree.shard_of(F.col("k"), leaves).alias("a"), hash_tree.shard_of(F.col("k"), more).alias("b")).collect()
        assert all(a == b or b == new for a, b in rows)
        sizes = Counter(b for _, b in rows)
        assert set(sizes) == set(range(new + 1))
        assert max(abs(n - 20_000 / (new + 1)) for n in sizes.values()) < 6 * math.sqrt(20_000 / (new + 1))
        leaves = more


def test_weight_change_moves_only_its_subtrees(spark):
    leaves = hash_tree.layout(24)
    less = [hash_tree.Leaf(x.region, x.rack, x.shard, 0.25 if x.shard == 5 else 1.0) for x in leaves]
    where = {x.shard: (x.region, x.rack) for x in leaves}
    rows = (spark.range(20_000).select(F.col("id").cast("string").alias("k"))
            .select(hash_tree.shard_of(F.col("k"), leaves).alias("a"), hash_tree.shard_of(F.col("k"), less).alias("b")).collect())
    moved = [(a, b) for a, b in rows if a != b]
    assert moved
    for a, b in moved:   # out of the subtree of shard 5, and never into shard 5
        assert b != 5 and where[a][0] == where[5][0]
        if where[a] == where[b]:
            assert a == 5


def test_edge_cases(make_docs):
    rows = [(1, None), (1, None), (1, ""), (2, "ä" * 50_000), (None, "x"), (None, "x")] + [(7, "same")] * 300
    df = hash_tree.assign(make_docs(rows), hash_tree.layout(24))
    got = hash_tree.with_slots(df, rows_per_bucket=10).collect()
    assert len(got) == len(rows)
    assert {r["size"] for r in got if r["id"] == 2} == {100_008} and {r["size"] for r in got if r["id"] == 1} == {8}
    assert len({r["shard"] for r in got if r["id"] == 7}) == 1
    for s in {r["shard"] for r in got}:
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))
    assert hash_tree.with_slots(df.limit(0)).collect() == []


def test_many_buckets(spark):
    df = hash_tree.assign(spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), hash_tree.layout(3))
    got = hash_tree.with_slots(df, rows_per_bucket=50).collect()
    for s in range(3):
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))


def test_alike_rows_are_written_by_many_tasks(spark):
    rows = spark.range(30_500).select(F.when(F.col("id") < 30_000, -1).otherwise(F.col("id")).alias("k"),
                                      (F.col("id") % 2 * 0).alias("shard"))
    got = hash_tree.with_slots(rows, rows_per_bucket=1000).withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r["slot"] for r in got) == list(range(30_500))
    hot = Counter(r["task"] for r in got if r["k"] == -1)
    assert sum(hot.values()) == 30_000 and max(hot.values()) <= 15_000
