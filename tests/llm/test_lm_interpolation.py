import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starpipe.llm import lm_interpolation as lm
from starpipe.llm.queries import op1_deleted_interpolation
from tests.llm.conftest import SF


def words(text):
    return [*(text or "").encode().lower().split(), None]


def brute_counts(texts):
    one, two, starts = Counter(), Counter(), 0
    for t in texts:
        w = words(t)
        one.update(w)
        two.update(zip(["^", *w[:-1]], w, strict=True))
        starts += 1
    return one, two, starts


def brute_base(text, one):
    n, v = sum(one.values()), len(one)
    return sum(math.log10((one[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(text))


def brute_score(text, one, two, docs, weights):
    n, v, total, before = sum(one.values()), len(one), 0.0, "^"
    for w in words(text):
        context = docs if before == "^" else one[before]
        l = weights[min(int(math.log2(context + 1)), lm.BUCKETS - 1)]
        p = l[0] / (v + 1) + l[1] * one[w] / n + (l[2] * two[before, w] / context if context else 0)
        total += math.log10(p)
        before = w
    return total


def test_query_against_brute_force(spark, documents, monkeypatch):
    learned = []
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a, **k: learned.append(learn(*a, **k)) or learned[-1])
    rows = {r.doc_id: r for r in op1_deleted_interpolation(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in texts}
    one, two, docs = brute_counts([t for k, t in texts.items() if not held[k]])
    assert set(rows) == set(texts)
    for k, t in texts.items():
        r = rows[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held[k], len(words(t)), sum(one[w] > 0 for w in words(t)), sum(one.values()))
        assert r.base_score == pytest.approx(brute_base(t, one), rel=1e-9)
        assert r.score == pytest.approx(brute_score(t, one, two, docs, learned[0]), rel=1e-9)
    # The mixture must beat the smoothed unigrams on text it has not seen.
    unseen = [rows[k] for k in texts if held[k]]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_weights_are_a_maximum(spark, documents):
    """EM's weights do no worse on the held-out histogram than others near them."""
    rng = np.random.default_rng(1)
    f = np.abs(rng.normal(size=(200, 2))) * np.array([0.01, 0.1])
    f[::3, 1] = 0
    hist = np.column_stack([np.full(200, 4), rng.integers(1, 50, 200), f])
    w = lm.learn_weights(hist, 2, 1000, prior=0.0)[4]
    full = np.column_stack([np.full(200, 1 / 1001), f])

    def fit(x):
        return float((hist[:, 1] * np.log(full @ x)).sum())
    assert w.sum() == pytest.approx(1) and (w >= 0).all()
    for _ in range(50):
        other = np.abs(w + rng.normal(size=3) * 0.02)
        assert fit(w) >= fit(other / other.sum()) - 1e-3


def test_mixture_sums_to_one_after_every_context():
    texts = ["a b c", "a b", "c a a", None]
    one, two, docs = brute_counts(texts)
    rng = np.random.default_rng(2)
    hist = np.column_stack([np.arange(20) % 4, rng.integers(1, 9, 20), rng.random((20, 2))])
    weights = lm.learn_weights(hist, 2, len(one))
    n, v = sum(one.values()), len(one)
    for before in ("^", b"a", b"b", b"c", b"never seen"):
        context = docs if before == "^" else one[before]
        l = weights[lm._bucket(np.array([context]))[0]]
        p = [l[0] / (v + 1) + l[1] * one[w] / n + (l[2] * two[before, w] / context if context else 0) for w in [*one, "unknown"]]
        assert sum(p) == pytest.approx(1)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_edge_cases_and_blocks(make_docs, order):
    long = " ".join(f"w{i % 50}" for i in range(20_000))
    rows = [(1, "a b c"), (2, "A B d"), (3, None), (4, ""), (5, long), (6, "a b c"), (6, "a b c"), (None, "x y"), (7, "new words"), (8, "a b")]
    df = make_docs(rows)
    got = sorted(map(tuple, lm.score(df, F.col("doc_id") != 8, order=order).collect()), key=str)
    small = sorted(map(tuple, lm.score(df, F.col("doc_id") != 8, order=order, block_tokens=5, range_keys=3).collect()), key=str)
    one, _, _ = brute_counts([t for k, t in rows if k is not None and k != 8])
    assert len(got) == len(rows)
    for a, b in zip(got, small, strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:])
    for k, t in rows:
        r = next(x for x in got if x[0] == k)
        assert r[1:4] == (len(words(t)), sum(one[w] > 0 for w in words(t)), sum(one.values()))
        assert r[4] == pytest.approx(brute_base(t, one))


def test_nothing_to_learn_from(make_docs):
    rows = lm.score(make_docs([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert {(r["id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows} == {(1, 3, 0, 0), (2, 1, 0, 0)}
    assert lm.score(make_docs([(1, "a")]).limit(0), F.lit(True)).collect() == []


def test_known_words_score_higher(make_docs):
    rows = [(i, "the cat sat on the mat") for i in range(30)] + [(100, "the cat sat on the mat"), (101, "mat the on sat cat the")]
    got = {r["id"]: r["score"] for r in lm.score(make_docs(rows), F.col("doc_id") < 100).collect()}
    assert got[100] > got[101]


def test_corpus_counts_beyond_32_bits(spark):
    asked, many = lm._steps(np.array([5, 9], "<u8")), lm._shrink(np.array([3_000_000_000, 1], "<u4"))
    rows = [(1, 0, block, role, bytearray(asked), bytearray(many)) for block, role in enumerate([lm.KEPT, lm.KEPT, lm.DELETED])]
    got = lm._answers(spark.createDataFrame(rows, "n int, part long, block long, role int, hashes binary, counts binary")).collect()
    total, = [r for r in got if r["block"] is None]
    assert (total["total"], total["kept_total"], total["kinds"]) == (9_000_000_003, 6_000_000_002, 2)
    answer, = [r.asDict() for r in got if r["block"] == 2]
    words, ranks = lm._steps(np.array([5, 9], "<u8")), lm._shrink(np.array([0, 1], "<u4"))
    body = {"n": None, "part": None, "tokens": lm._shrink(np.array([0, 1, 0], "<u4")), "words": words, "ranks": ranks, "lens": [3]}
    for col, counts in (("seen", [9_000_000_000, 3, 9_000_000_000]), ("kept", [6_000_000_000, 2, 6_000_000_000])):
        assert lm._estimates([body, answer], 1, col, 1, 1)[2].tolist() == counts
