import random

import pytest

from starpipe.llm import simhash_blocks
from starpipe.operators import components
from tests.llm.test_simhash_blocks import brute_components, got


def labels_of(spark, edges):
    return {r["node"]: r["label"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}


@pytest.fixture()
def rounds(monkeypatch):
    """Counts the rounds of contraction (tables of moves)."""
    seen = []
    write = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, label="t": (seen.append(label), write(df, label))[1])
    return lambda: seen.count("moves")


def test_chain_in_falling_order(spark, rounds):
    n = 2000
    chain = [0, *range(n - 1, 0, -1)]
    assert labels_of(spark, list(zip(chain, chain[1:]))) == dict.fromkeys(range(n), 0)
    assert rounds() <= 20


def test_random_graphs(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(450)] + [(5, 5), (1000, 1001), (1001, 1000)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            parent[root(a)] = root(b)
    least = {}
    for x in list(parent):
        least[root(x)] = min(x, least.get(root(x), x))
    assert labels_of(spark, edges) == {x: least[root(x)] for x in parent}


def test_no_edges(spark):
    assert labels_of(spark, []) == {}


def test_long_walk_of_fingerprints(spark, rounds):
    """A text edited step by step: 2,000 fingerprints, each two bits from the last."""
    rng = random.Random(9)
    x, walk = rng.getrandbits(64), {}
    while len(walk) < 2000:
        walk.setdefault(x, len(walk))
        x ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
    rows = [(k, p) for p, k in walk.items()]
    df = spark.createDataFrame([(k, p - (1 << 64) if p >> 63 else p) for k, p in rows], "id long, fp long")
    named = df.join(simhash_blocks.classes(df), "fp")
    from pyspark.sql import functions as F
    least = named.groupBy("label").agg(F.min("id").alias("component_id"))
    assert got(named.join(least, "label")) == brute_components(rows, 2)
    assert rounds() <= 20
