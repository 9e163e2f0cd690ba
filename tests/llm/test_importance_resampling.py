import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from starpipe.llm import importance_resampling as R
from starpipe.llm.queries import QUERIES
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def features(text):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(feature, buckets=10000):
    return zlib.crc32(feature.encode()) % buckets


def brute(docs, target, buckets=10000, percent=5, min_words=20, seed=42):
    """Rows (id, n_features, weight, score, rank) by zlib, one feature at a time."""
    s, t = [0] * buckets, [0] * buckets
    for texts, into in ((docs, s), (target, t)):
        for _, text in texts:
            for f in features(text):
                into[bucket(f, buckets)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        own = features(text)
        weight = sum(gain[bucket(f, buckets)] for f in own)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = k
    return sorted(map(str, (tuple(r[:5]) for r in rows)))


def rows_of(df):
    return sorted(str((r["id"], r["n_features"], r["weight"], r["score"], r["rank"])) for r in df.collect())


def test_crc_of_spans_of_every_length_equals_zlib():
    table = R.PositionTable()
    data = np.random.default_rng(1).integers(0, 256, 300_000, dtype=np.uint8)
    starts = np.random.default_rng(2).integers(0, 1000, 400)
    lens = np.concatenate([np.arange(1, 300), np.random.default_rng(3).integers(1, 5000, 100), [290_000]])
    ends = starts[:len(lens)] + lens
    assert table.crc(data, starts[:len(lens)], ends).tolist() == [
        zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


def test_long_spans_fold_across_several_chunks(monkeypatch):
    monkeypatch.setattr(R, "SPAN_BYTES", 500)
    test_crc_of_spans_of_every_length_equals_zlib()


def test_slices_and_groups_do_not_change_the_buckets(monkeypatch):
    texts = [b"a b c d e f", b"", None, b"Z", b"one two", ("w" * 3000 + " xéy 9-" + "v" * 200).encode()]
    whole = [np.concatenate(c) for c in zip(*[x[1:] for x in R.feature_buckets(texts, R.PositionTable(), 997)])]
    monkeypatch.setattr(R, "SLICE_WORDS", 2)
    cut = [np.concatenate(c) for c in zip(*[x[1:] for x in R.feature_buckets(texts, R.PositionTable(), 997)])]
    assert sorted(zip(*[x.tolist() for x in whole])) == sorted(zip(*[x.tolist() for x in cut]))
    expected = sorted((i, bucket(f, 997)) for i, t in enumerate(texts) for f in features((t or b"").decode()))
    assert sorted(zip(*[x.tolist() for x in whole])) == expected


def test_whole_tables_equal_brute_force(spark, documents):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = brute([(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()],
                     [(r["item_id"], r["text"]) for r in target.select("item_id", "text").collect()])
    got = QUERIES["op11_position_crc"](spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    assert rows_of(got.withColumnRenamed("doc_id", "id")) == expected


@pytest.mark.parametrize("percent", [0, 5, 50, 100])
def test_edge_rows_equal_brute_force(spark, make_docs, percent):
    text = " ".join(f"w{i % 7}" for i in range(30))
    rows = ([(i, text) for i in range(20)] + [(3, text), (None, text), (None, None), (50, None), (51, ""), (52, " .,- \n"),
            (53, "short"), (54, "x" * 100_000 + " " + text), (55, "Été 中文 " * 12), (56, "A-B " * 20)])
    target = [(1, "w1 w2 w3"), (2, None)]
    got = R.resample(make_docs(rows), make_docs(target), percent=percent)
    assert rows_of(got) == brute(rows, target, percent=percent)


def test_empty_tables(spark, make_docs):
    none = make_docs([(1, "x")]).where("false")
    assert R.resample(none, none).collect() == []
    some = [(i, " ".join(f"t{j * i}" for j in range(25))) for i in range(30)]
    assert rows_of(R.resample(make_docs(some), none)) == brute(some, [])
