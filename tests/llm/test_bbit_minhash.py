import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starpipe.llm import bbit_minhash as M
from starpipe.llm.queries import QUERIES
from tests.llm.conftest import SF


def word_set(text, k):
    w = (text or "").encode().lower().split()
    k = min(k, len(w))
    return frozenset(b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def brute(docs, k=5, percent=80):
    """(id, set size, component id, kept) by comparing all documents that share a shingle."""
    sets = [word_set(t, k) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        near = set()
        for x in s:
            near.update(holders.setdefault(x, []))
            holders[x].append(i)
        for j in near:
            both = len(s & sets[j])
            if root(i) != root(j) and 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((str((d, len(s), least.get(root(i)), d == least.get(root(i)))) for i, ((d, _), s) in enumerate(zip(docs, sets))))


def got(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_whole_table_equals_brute_force(spark, documents):
    rows = QUERIES["op13_bbit_minhash"](spark, SF)
    assert rows.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert got(rows) == brute([(r["doc_id"], r["text"]) for r in documents.collect()], 4)


def near_family(rng, length, size, edits):
    base = [f"b{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("cap", [1, 8, 64])
def test_families_and_chains_equal_brute_force(spark, make_docs, cap):
    """Families around the threshold, texts edited step by step, and a passage that many share."""
    rng = random.Random(5)
    texts = near_family(rng, 120, 60, 6) + near_family(rng, 60, 40, 4) + near_family(rng, 300, 25, 1)
    walk = [f"c{rng.randrange(10**6)}" for _ in range(100)]
    for _ in range(60):
        walk[rng.randrange(100)] = f"s{rng.randrange(10**6)}"
        walk[rng.randrange(100)] = f"s{rng.randrange(10**6)}"
        texts.append(" ".join(walk))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(10, 60))) for _ in range(80)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert got(M.near_duplicates(make_docs(rows), bucket_cap=cap, shingle_words=4)) == brute(rows, 4)


def test_a_large_family_that_is_edited_too_much_makes_few_candidates(spark, make_docs, monkeypatch):
    """Members of crowded buckets meet by rare shingles, not all with all."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(260):
        words = list(base)
        for at in rng.sample(range(0, 60, 4), 3 if d % 10 else 1):
            words[at] = f"e{rng.randrange(40)}"
        rows.append((d, " ".join(words)))
    tested = []
    confirm = M.confirm
    monkeypatch.setattr(M, "confirm", lambda pairs, *a: (tested.append(pairs.distinct().count()), confirm(pairs, *a))[1])
    assert got(M.near_duplicates(make_docs(rows), bucket_cap=16, shingle_words=4)) == brute(rows, 4)
    assert len(tested) == 2 and tested[1] < 5 * len(rows), tested


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_prefix_pairs_hold_every_link(spark, percent):
    rng = random.Random(percent)
    sets = {0: set(range(5)), 1: set(range(5)), 2: {0}}
    for r in range(3, 120):
        other = set(sets[rng.randrange(r)])
        for _ in range(rng.randrange(4)):
            other.add(rng.randrange(200))
        if len(other) > 1 and rng.random() < 0.5:
            other.discard(rng.choice(sorted(other)))
        sets[r] = other
    frame = spark.createDataFrame([(r, sorted(s)) for r, s in sets.items()], "row long, set array<long>")
    entries = frame.select("row", F.col("row").alias("label"), F.size("set").cast("long").alias("n"),
                           F.lit(0).cast("long").alias("own"), F.array(F.lit(0)).alias("sig"))
    pairs = {(r["a"], r["b"]) for r in M.prefix_pairs(entries, frame, percent, F.lit(True)).collect()}
    links = {(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    assert links and links <= pairs and len(pairs) < len(sets) * (len(sets) - 1) // 2


def test_a_hot_entry_is_dealt_over_groups(spark, make_docs, monkeypatch):
    monkeypatch.setattr(M, "PER_GROUP", 4)
    rows = list(enumerate(near_family(random.Random(2), 200, 50, 2)))
    assert got(M.near_duplicates(make_docs(rows))) == brute(rows)


def test_edge_rows(spark, make_docs):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "Two one"), (None, "one"), (8, "a a a a a a a"),
            (9, "a a a a"), (10, long), (11, long + " tail"), (12, long), (12, long), (None, "only null ids here, twice"),
            (None, "only null ids here, twice"), (None, None), (13, "É é"), (14, "é é")]
    assert got(M.near_duplicates(make_docs(rows))) == brute(rows)
    assert got(M.near_duplicates(make_docs(rows).where("false"))) == []


def test_estimate_is_corrected_for_chance(spark):
    """The estimate of pairs of known similarity, from 1024 minima."""
    rng, (a, b) = np.random.default_rng(1), M._orders(1024)
    for s in (0.0, 0.3, 0.8, 1.0):
        union = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
        common = round(600 * s)
        left, right = union[:common + (600 - common) // 2], np.concatenate([union[:common], union[common + (600 - common) // 2:]])
        sigs = [M.pack(M.minima(x, a, b)).tolist() for x in (left, right)]
        df = spark.createDataFrame([sigs], "x array<long>, y array<long>")
        agree = df.select(M.agreeing("x", "y", 1024).alias("k")).first()["k"]
        low = [M.minima(x, a, b) & np.uint64(3) for x in (left, right)]
        assert agree == int((low[0] == low[1]).sum())
        est = df.select(M.estimate(F.lit(agree), 1024).alias("e")).first()["e"]
        assert abs(est - s) < 0.09
