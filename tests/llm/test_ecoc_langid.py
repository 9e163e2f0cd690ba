import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starpipe.llm import ecoc_langid as ecoc
from starpipe.llm.queries import op4_output_codes
from tests.llm.conftest import SF


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op4_output_codes(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(truth) and len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    clear = [r for r in held if not r.ambiguous]
    assert len(clear) >= 0.95 * len(held)
    assert sum(r.lang_pred == truth[r.doc_id] for r in clear) >= 0.98 * len(clear)


def brute_grams(text):
    """Numbers of a text's byte pairs and triples, one at a time."""
    kept = [ord(chr(b).lower()) if b < 128 and chr(b).isalpha() else b if b >= 128 else 32 for b in text.encode()]
    b, out = [32, *kept, 32], []
    for i in range(len(b) - 1):
        out.append(b[i] * 256 + b[i + 1])
        if i + 2 < len(b):
            mixed = ((b[i] * 65599 + b[i + 1]) * 65599 + b[i + 2]) * 2654435761 % 2**32
            out.append(2**16 + (mixed >> 16))
    return Counter(out)


def brute_languages(train, texts):
    """(language, score) of each text, from a model learned from the (text, language) pairs of ``train``."""
    langs = sorted({lang for _, lang in train})
    code = ecoc.codewords(len(langs)).tolist()
    bits = range(len(code[0]))
    counts = {lang: Counter() for lang in langs}
    for text, lang in train:
        counts[lang].update(brute_grams(text))
    total = {lang: counts[lang].total() for lang in langs}
    odds = {}

    def of(g):
        if g not in odds:
            share = [(counts[x][g] + 0.5) / (total[x] + 0.5 * 2**17) for x in langs]
            odds[g] = []
            for k in bits:
                one, other = ([s for s, c in zip(share, code, strict=True) if c[k] == side] for side in (1, -1))
                odds[g].append(math.log(sum(one) / len(one)) - math.log(sum(other) / len(other)))
        return odds[g]

    def margins(text):
        grams = brute_grams(text)
        return [sum(n * of(g)[k] for g, n in grams.items()) / grams.total() for k in bits]

    wrong = [0] * len(bits)
    for text, lang in train:
        m = margins(text)
        for k in bits:
            wrong[k] += m[k] * code[langs.index(lang)][k] <= 0
    error = [(w + 0.5) / (len(train) + 1) for w in wrong]
    weights = [max(math.log((1 - e) / e), 0.05) for e in error]
    out = []
    for text in texts:
        if text is None or not any(c.isalpha() for c in text):
            out.append(("und", 0.0))
            continue
        m = margins(text)
        loss = [sum(weights[k] * math.log1p(math.exp(-20 * word[k] * m[k])) for k in bits) / sum(weights) for word in code]
        best = min(range(len(langs)), key=loss.__getitem__)
        out.append((langs[best], 1 / sum(math.exp(-(x - loss[best]) * len(bits)) for x in loss)))
    return out


def test_query_equals_brute_force(spark, documents):
    rows = documents.select("doc_id", "text", "lang").collect()
    train = [(r.text, r.lang) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None and r.text is not None]
    want = dict(zip([r.doc_id for r in rows], brute_languages(train, [r.text for r in rows]), strict=True))
    got = {r.doc_id: (r.lang_pred, r.score) for r in op4_output_codes(spark, SF).collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(v[1] == pytest.approx(want[k][1], abs=1e-4) for k, v in got.items())


def test_learns_from_text_and_label_only(documents):
    train = documents.where("doc_id % 3 <> 0")
    one = ecoc.fit(train, rows_per_lang=10**9)
    two = ecoc.fit(train.withColumn("source", F.lit("other")).withColumn("doc_id", F.col("doc_id") + 1000), rows_per_lang=10**9)
    assert np.array_equal(one.odds, two.odds) and np.array_equal(one.weights, two.weights)


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 12, 40):
        code = ecoc.codewords(n)
        far = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
        assert min(far) >= max(1, code.shape[1] // 4)
        assert all(len(set(col)) == 2 for col in code.T)


def test_one_wrong_bit_is_corrected():
    langs = ["a", "b", "c", "d"]
    model = ecoc.Model(langs, ecoc.codewords(4), np.zeros((1, 7)), np.ones(7))
    for k in range(4):
        for bit in range(7):
            margins = model.code[k].astype(float) * 0.1
            margins[bit] *= -1
            assert model.decode(margins)[0] == langs[k]
    lang, score, ambiguous = model.decode(np.zeros(7))
    assert ambiguous and abs(score - 0.25) < 1e-9


def test_edge_cases(make_docs):
    train = [(i, "the cat and the dog " * 3, "en") for i in range(20)] + [(i + 20, "der hund und die katze " * 3, "de") for i in range(20)]
    model = ecoc.fit(make_docs([*train, (99, None, "en"), (98, "nothing", None)]))
    assert model.langs == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "123 #$ !"), (4, "the dog and the cat"), (5, "die katze und der hund"), (5, "die katze und der hund"),
            (6, "der hund " * 100_000), (None, "the cat"), (7, "é"), (8, "²³")]
    got = ecoc.predict(make_docs(rows), model).collect()
    assert "n_words" in got[0].asDict() and got[0]["fp"] == "clash"
    found = sorted(((r.doc_id, r.lang_pred) for r in got), key=str)
    assert [x for x in found if x[0] in (1, 2, 3, 8)] == [(1, "und"), (2, "und"), (3, "und"), (8, "und")]
    assert [x for x in found if x[0] in (4, 5, 6, None)] == [(4, "en"), (5, "de"), (5, "de"), (6, "de"), (None, "en")]
    assert all(r.score == 0 for r in got if r.lang_pred == "und")


def test_nothing_or_one_language_to_learn(make_docs):
    docs = make_docs([(1, "abc"), (2, None)])
    none = ecoc.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert [r.lang_pred for r in ecoc.predict(docs, none).collect()] == ["und", "und"]
    one = ecoc.fit(docs)
    assert sorted((r.lang_pred, r.score) for r in ecoc.predict(docs, one).collect()) == [("en", 1.0), ("und", 0.0)]
    assert ecoc.predict(docs.limit(0), one).collect() == []


def test_long_text_equals_its_slices(monkeypatch):
    model = ecoc.Model(["a", "b"], ecoc.codewords(2), np.random.default_rng(1).normal(size=(ecoc.FEATURES, 1)), np.ones(1))
    text = b"some words that go on " * 50
    whole = model.margins(text)
    monkeypatch.setattr(ecoc, "SLICE", 64)
    assert abs(model.margins(text) - whole).max() < 0.1
