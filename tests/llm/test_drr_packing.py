import json
import random
import string
import tracemalloc
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starpipe.llm import drr_packing as drr
from starpipe.llm.common import arrow_rows
from starpipe.llm.queries import op7_deficit_round_robin, word_tokenizer
from starpipe.sources.io import materialize
from tests.llm.conftest import SF


def encode(texts):
    t = Tokenizer.from_str(word_tokenizer())
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def check_pieces(rows, ids, window):
    """Every id in one piece, right digests, sequences gapless and full but for the last."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for k, own in by_doc.items():
        own.sort(key=lambda r: r["start"])
        at = 0
        for r in own:
            part = np.array(ids[k][r["start"]:r["start"] + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids[k]), zlib.crc32(part.tobytes()))
            assert r["length"] > 0
            at += r["length"]
        assert at == len(ids[k])
    assert sorted(by_seq) == list(range(len(by_seq)))
    for s, own in by_seq.items():
        own.sort(key=lambda r: r["offset"])
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert at == window or (s == len(by_seq) - 1 and 0 < at <= window)


def test_query_against_tokenizer(spark, documents):
    docs = documents.collect()
    ids = dict(zip([d.doc_id for d in docs], encode([d.text for d in docs]), strict=True))
    rows = [{**r.asDict(), "id": r.doc_id} for r in op7_deficit_round_robin(spark, SF).collect()]
    check_pieces(rows, ids, 2048)
    source = {d.doc_id: d.source for d in docs}
    total = Counter()
    for k, v in ids.items():
        total[source[k]] += len(v)
    full = Counter()
    for r in rows:
        full[r["sequence_id"], source[r["id"]]] += r["length"]
    last = max(r["sequence_id"] for r in rows)
    for s in range(last):   # every window has the target proportions to within a few tokens
        for src, n in total.items():
            assert abs(full[s, src] - 2048 * n / sum(total.values())) <= len(total) + 1


def brute_rounds(totals, window, target=None):
    """The order of (source, token) by literal deficit round-robin, phase by phase."""
    order, sched = [], drr.Schedule(totals, window, target)
    for _, total, sent, done in sched.phases:
        deficit, gone = [0] * len(sent), [0] * len(sent)
        while sum(gone) < total:
            for q, d in enumerate(sent):
                deficit[q] += window * d
                n = min(deficit[q] // total, d - gone[q])
                order += [(q, done[q] + gone[q] + i) for i in range(n)]
                gone[q] += n
                deficit[q] -= n * total
    return sched, order


@pytest.mark.parametrize("target", [None, {"a": 1, "b": 1, "c": 1}, {"a": 0.7, "b": 0.3}, {"z": 1}])
def test_places_follow_deficit_round_robin(target):
    rng = random.Random(1)
    for _ in range(20):
        totals = {s: rng.randrange(1, 120) for s in "abc"}
        window = rng.choice([1, 4, 16, 33])
        sched, order = brute_rounds(totals, window, target)
        place = {x: i for i, x in enumerate(order)}
        assert len(place) == len(order) == sum(totals.values())
        for q, s in enumerate(sched.sources):
            first = rng.randrange(totals[s])
            n = rng.randrange(1, totals[s] - first + 1)
            at = 0
            for start, where, size in sched.runs(s, first, n):
                assert start == at and where // window == (where + size - 1) // window
                assert [place[q, first + start + i] for i in range(size)] == list(range(where, where + size))
                at += size
            assert at == n


def test_edge_cases(make_docs):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "Don't STOP — naïve café!! 123 x y\x1cz", "en", "b"),
            (4, "word " * 30_000, "en", "a"), (5, "x" * 5000, "en", None), (6, "<|endoftext|> a", "en", "c"), (None, "no id", "en", "c")]
    ids = dict(zip([r[0] for r in rows], encode([r[1] for r in rows]), strict=True))
    got = drr.pack(make_docs(rows), word_tokenizer(), window=64, with_ids=True).collect()
    check_pieces([r.asDict() for r in got], ids, 64)
    assert all(np.frombuffer(r["ids"], "<u4").tolist() == ids[r["id"]][r["start"]:r["start"] + r["length"]] for r in got)


def test_repeated_rows_and_empty_table(make_docs):
    got = drr.pack(make_docs([(1, "a b"), (1, "a b")]), word_tokenizer(), window=4).collect()
    assert sum(r["length"] for r in got) == 6 and {r["doc_tokens"] for r in got} == {3}
    assert drr.pack(make_docs([(1, "a")]).limit(0), word_tokenizer()).collect() == []


def test_word_by_word_ids_equal_whole_text(documents, monkeypatch):
    monkeypatch.setattr(drr, "CACHE_WORDS", 50)
    monkeypatch.setattr(drr, "CACHE_BYTES", 6)
    texts = [r.text for r in documents.limit(40).collect()] + ["́a ́", "Σας ΣΑΣ", "a\tb\x0bc\x0cd\re", "I'll we've 'S"]
    got = drr.WordTokenizer(word_tokenizer())([t.encode() for t in texts], 1)
    assert [x.tolist() for x in got] == encode(texts)


def test_ids_of_letters_between_punctuation():
    """Every letter that is more than letters once it is normalised, and 3,000 others, beside every ASCII punctuation mark."""
    letters = [c for c in map(chr, range(0x80, 0x110000)) if c.isalpha()]
    odd = [c for c in letters if not unicodedata.normalize("NFC", unicodedata.normalize("NFC", c).lower()).isalpha()]
    assert "\u0130" in odd and "\u09dc" in odd
    rng = random.Random(1)
    marks = string.punctuation.replace("<", "")
    texts = [" ".join(f"{p}a{c}{p} {c}{p} {p}{c}b" for p in marks) for c in odd]
    texts += [" ".join(f"{p}{c}{rng.choice(letters)}{p}" for p in rng.sample(marks, 4)) for c in rng.sample(letters, 3000)]
    got = drr.WordTokenizer(word_tokenizer())([t.encode() for t in texts], 1)
    assert sum(x.tolist() != want for x, want in zip(got, encode(texts), strict=True)) == 0


def test_random_strings_equal_the_tokenizer():
    rng = random.Random(2)
    pool = "aZ9 \t.,'\"-!<|>éİıß中あ\u09dc\u0958\u0301\ufb1d\u200d😀"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 12))) for _ in range(20_000)]
    got = drr.WordTokenizer(word_tokenizer())([t.encode() for t in texts], 1)
    assert sum(x.tolist() != want for x, want in zip(got, encode(texts), strict=True)) == 0


def test_words_of_letters_by_the_model_or_by_a_run():
    """Case is kept in a text with special tokens; both ways give the tokenizer's ids."""
    texts = ["The <|x ZYa QQ <|endoftext|> Word", "plain Words, (and) ''more'' " + "long" * 40, "Été ZYa"]
    for direct in (True, False):
        tokenizer = drr.WordTokenizer(word_tokenizer())
        assert tokenizer.direct
        tokenizer.direct = direct
        assert [x.tolist() for x in tokenizer([t.encode() for t in texts], 1)] == encode(texts)
    assert not drr.WordTokenizer(word_tokenizer())._takes_letters(["abc"])


def test_a_worker_keeps_its_tokenizer():
    """Tasks of one worker share what is loaded of a tokenizer; another one takes its place."""
    spec = word_tokenizer()
    a, b = drr.WordTokenizer(spec), drr.WordTokenizer(spec)
    assert a.tokenizer is b.tokenizer and a.known is not b.known
    parts = json.loads(spec)
    vocab = parts["model"]["vocab"]
    first, second = sorted(vocab)[-2:]
    vocab[first], vocab[second] = vocab[second], vocab[first]
    other = drr.WordTokenizer(json.dumps(parts))
    assert other.tokenizer is not a.tokenizer
    assert [x.tolist() for x in drr.WordTokenizer(spec)([b"The cat sat."], 1)] == encode(["The cat sat."])


@pytest.mark.parametrize("session_rows", ["10000", "5", "0"])
def test_rows_that_go_to_python_at_a_time(spark, session_rows):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, session_rows)
    try:
        sizes = spark.range(0, 100, 1, 1).mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in it), "n long")
        with pytest.raises(ZeroDivisionError), arrow_rows(spark, 7):
            assert max(r.n for r in sizes.collect()) == (5 if session_rows == "5" else 7)
            raise ZeroDivisionError
        assert spark.conf.get(name) == session_rows
    finally:
        spark.conf.set(name, before)


def test_tokens_are_written_in_small_batches(spark, monkeypatch):
    """The bound holds for the job that writes the tokens, whatever the session's is."""
    seen, name = [], "spark.sql.execution.arrow.maxRecordsPerBatch"
    monkeypatch.setattr(drr, "materialize", lambda df, label: (seen.append((label, spark.conf.get(name))), materialize(df, label))[1])
    drr.pack(spark.createDataFrame([(1, "cat", "a")], "doc_id long, text string, source string"), word_tokenizer()).collect()
    assert dict(seen)["tokens"] == str(drr.ROWS)


def test_target_proportions_hold_until_a_queue_is_dry(spark):
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("cat "), 50).alias("text"),
                                   F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"))
    got = drr.pack(rows, word_tokenizer(), window=100, target={"a": 0.5, "b": 0.5}).collect()
    share = Counter()
    for r in got:
        share[r["sequence_id"], r["id"] % 4 == 0] += r["length"]
    assert all(abs(share[s, True] - 50) <= 3 for s in range(100))
    assert all(share[s, True] == 0 for s in range(103, 204))


def exact_place(sched, source, k):
    """Place of a queue token in a stream of one phase, by Python's integers."""
    (_, total, sent, _), = sched.phases
    q, own = sched.number[source], sent[sched.number[source]]
    r = -(-(k + 1) * total // (sched.window * own)) - 1

    def gone(j, r):
        return min(sent[j], r * sched.window * sent[j] // total)
    return sum(gone(j, r + (j < q)) for j in range(len(sent))) + k - gone(q, r)


@pytest.mark.parametrize("scale", [1, 1000])
def test_small_source_beside_billions_of_tokens(scale):
    totals = {f"s{i}": 3_000_000_000 // (i + 1) * scale for i in range(20)} | {"one": 500, "": 1}
    sched = drr.Schedule(totals, 2048)
    rng = random.Random(3)
    asked = [("one", 0, 500), ("", 0, 1)] + [(s, rng.randrange(n - 3000), 3000) for s, n in totals.items() if n > 3000]
    asked += [(s, n - 3000, 3000) for s, n in totals.items() if n > 3000]
    for source, first, n in asked:
        tracemalloc.start()
        got = list(sched.runs(source, first, n))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 32 << 20
        assert sum(size for _, _, size in got) == n and [a for a, _, _ in got] == [0, *np.cumsum([x[2] for x in got])[:-1]]
        for a, where, size in got:
            assert where == exact_place(sched, source, first + a)
            assert where + size - 1 == exact_place(sched, source, first + a + size - 1)


@pytest.mark.parametrize("target", [None, {"s39": 1.0, "big": 1.0}])
def test_more_sources_than_queues(make_docs, monkeypatch, target):
    monkeypatch.setattr(drr, "MAX_SOURCES", 3)
    rows = [(i, "cat " * (i % 7 + 1), "en", f"s{i % 40}" if i % 2 else None) for i in range(200)]
    rows += [(200 + i, "dog " * 300, "en", "big") for i in range(10)] + [(300 + i, "a b c", "en", f"rest{'_' * i}"[:5]) for i in range(4)]
    ids = dict(zip([r[0] for r in rows], encode([r[1] for r in rows]), strict=True))
    got = [r.asDict() for r in drr.pack(make_docs(rows).repartition(5), word_tokenizer(), window=64, target=target).collect()]
    check_pieces(got, ids, 64)
    if target is None:   # the largest source keeps its share of every window
        share = Counter()
        for r in got:
            share[r["sequence_id"]] += r["length"] * (200 <= r["id"] < 300)
        part = sum(len(ids[200 + i]) for i in range(10)) / sum(map(len, ids.values()))
        assert all(abs(share[s] - 64 * part) <= 5 for s in range(max(share)))
