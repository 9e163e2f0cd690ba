import random

import xxhash
from pyspark.sql import functions as F

from starpipe.llm import simhash_blocks
from starpipe.llm.queries import op8_pigeonhole_blocks
from tests.llm.conftest import SF


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    """Smallest id per component, by comparing all fingerprints."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= distance:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    least = {}
    for i, (k, _) in enumerate(prints):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return sorted(((k, fp, least.get(root(i))) for i, (k, fp) in enumerate(prints)), key=str)


def got(rows):
    return sorted(((r["id"], r["fp"] % (1 << 64), r["component_id"]) for r in rows.collect()), key=str)


def test_query_against_brute_force(spark, documents):
    want = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in documents.collect()], 2)
    rows = op8_pigeonhole_blocks(spark, SF).collect()
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in rows), key=str) == want
    assert all(len(r.fingerprint) == 16 for r in rows)
    assert len({r.component_id for r in rows}) < len(rows)


def test_edge_cases(make_docs):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(5, None), (7, ""), (3, " \t"), (1, "one"), (2, "ONE"), (4, "one two"), (9, long), (8, long + " w"),
            (None, "lonely words here"), (6, "a b c d"), (6, "a b c d"), (None, "one")]
    want = brute_components([(k, brute_fingerprint(t)) for k, t in rows], 2)
    assert got(simhash_blocks.near_duplicates(make_docs(rows))) == want


def test_empty_table(make_docs):
    assert simhash_blocks.near_duplicates(make_docs([(1, "a")]).limit(0)).collect() == []


def test_crowded_buckets_link_alike(spark):
    """Families, chains and strangers: every cap and distance gives the brute-force components."""
    rng = random.Random(3)
    prints = set()
    for _ in range(3):
        x = rng.getrandbits(64)
        prints |= {x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
        for _ in range(40):
            x ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    rows = list(enumerate(sorted(prints)))
    df = spark.createDataFrame([(k, p - (1 << 64) if p >> 63 else p) for k, p in rows], "id long, fp long")
    for distance in (0, 1, 2, 3):
        want = brute_components(rows, distance)
        for cap in ((0, 8, 10_000) if distance < 3 else (10_000,)):
            named = df.join(simhash_blocks.classes(df, distance, bucket_cap=cap), "fp")
            least = named.groupBy("label").agg(F.min("id").alias("component_id"))
            assert got(named.join(least, "label")) == want, (distance, cap)
