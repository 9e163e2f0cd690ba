import hashlib
import random
import re

from pyspark.sql import functions as F

from starpipe.llm import prefix_decontam as pd_
from starpipe.llm.queries import op5_prefix_join
from tests.llm.conftest import SF

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    windows = {}
    for k, t in items:
        w = split(t)
        for i in range(max(len(w) - window, 0) + 1):
            if w:
                windows.setdefault(tuple(w[i:i + window]), set()).add("" if k is None else str(k))
    sizes = {len(w) for w in windows}
    out = []
    for k, t in docs:
        w, hit, found = split(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                of = windows.get(tuple(w[i:i + n]))
                if of:
                    hit |= set(range(i, i + n))
                    found |= of
        out.append((k, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(rows):
    n_hit = pd_.hit_words(F.col("hit_spans"))
    rows = rows.select("doc_id", F.col("n_words"), n_hit, F.size("items"), F.sha2(F.array_join("items", ",").cast("binary"), 256), n_hit > 0)
    return sorted(map(tuple, rows.collect()), key=str)


def test_query_against_brute_force(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = sorted(map(tuple, op5_prefix_join(spark, SF).collect()), key=str)
    assert rows == brute([(r.doc_id, r.text) for r in documents.collect()], items)
    assert any(r[-1] for r in rows)


def make_items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("n_words", F.lit(1))


def test_edge_cases_and_blocks(spark, make_docs):
    rng = random.Random(2)

    def prose(n):
        return " ".join(rng.choice(["the", "of", "a", "cat", "Dog", "été", "x1"]) for _ in range(n))
    items = [(i, prose(rng.randrange(1, 25))) for i in range(40)] + [(50, None), (51, ""), (52, "..."), (53, "Solo"), (3, "second text"), (3, "Solo"), (None, "no id here")]
    docs = [(i, prose(rng.randrange(0, 60)) + rng.choice([" solo.", " No-ID, here!", " ", " " + items[i % 40][1].upper()])) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "!!"), (103, docs[0][1]), (103, docs[0][1]), (None, "solo"), (104, "solo " * 50_000)]
    want = brute(docs, items)
    assert got(pd_.find_contamination(make_docs(docs), make_items(spark, items))) == want
    assert got(pd_.find_contamination(make_docs(docs), make_items(spark, items), block_bytes=4000)) == want


def test_empty_tables(spark, make_docs):
    docs, items = make_docs([(1, "a b")]), make_items(spark, [(1, "a b")])
    assert got(pd_.find_contamination(docs, items.limit(0))) == brute([(1, "a b")], [])
    assert got(pd_.find_contamination(docs.limit(0), items)) == []


def test_prefix_is_the_rarest_shingle():
    index = pd_.Index([("1", b"the of the cat")], {(b"the", b"of"): 9, (b"of", b"the"): 2, (b"the", b"cat"): 5})
    assert list(index.by_shingle) == [(b"of", b"the")]
    assert index.hits(b"x the of the cat y".split()) == ([(1, 5)], {"1"})
    assert index.hits(b"of the cat".split()) == ([], set())


def test_large_benchmark_is_a_join_of_one_plan(spark, make_docs, monkeypatch):
    """However many windows there are: no index, no window in the driver, no more steps."""
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(40))) for i in range(300)]
    docs = [(i, f"x{i} y {t} z" if i % 3 else f"x{i} y z") for i, t in items] + [(1, items[1][1])] * 50
    monkeypatch.setattr(pd_, "Index", None)
    monkeypatch.setattr(pd_, "MAX_BITS", 1 << 10)   # nearly every window passes the bitmap

    def steps(found):
        return found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
    found = [pd_.find_contamination(make_docs(docs), make_items(spark, items), block_bytes=b) for b in (200_000, 2000)]
    assert [steps(f) for f in found] == [1, 1]
    want = brute(docs, items)
    assert all(got(f) == want for f in found)
