import random
import re
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starpipe.llm import phrase_streams as P
from starpipe.llm.queries import QUERIES
from tests.llm.conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, min_count=100, longest=5, percent=100, top=2000):
    """Rows as the query's, by counting every phrase in a dictionary."""
    total, f = Counter(), defaultdict(Counter)
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, counts in f.items():
        held = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        gone = set()
        for p, a in held.items():
            for n in range(2, len(p)):
                gone |= {p[i:i + n] for i in range(len(p) - n + 1) if 100 * a >= percent * held[p[i:i + n]]}
        rows = []
        for p, a in held.items():
            if p not in gone:
                s, k = min((1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        rows.sort()
        out += [(lang, i, p.decode(), -a, le, r, total[lang], -s) for i, (s, a, p, le, r) in enumerate(rows[:top], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_whole_table_equals_brute_force(spark, documents):
    rows = QUERIES["op12_count_streams"](spark, SF)
    assert rows.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got(rows) == brute([(r["lang"], r["text"]) for r in documents.collect()])


def texts(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6)] + ["Été", "a\x01", "a", "new", "york"]
    out = []
    for i in range(n):
        w = [rng.choice(vocabulary[:3 + i % 9]) for _ in range(rng.randrange(40))]
        at = rng.randrange(len(w) + 1)
        w[at:at] = ["New", "York", "City", "Hall"][:rng.randrange(5)]
        out.append((i, "".join(x + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n"]) for x in w), rng.choice(["en", "fr", None, "und"])))
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(("block", "percent", "longest", "top"), [(50, 100, 5, 2000), (1_000_000, 60, 3, 7), (400, 100, 2, 1)])
def test_random_texts_equal_brute_force(spark, make_docs, seed, block, percent, longest, top):
    rows = texts(seed)
    docs = make_docs(rows).repartition(5)
    found = P.mine(docs, min_count=4, block_tokens=block, keep_percent=percent, longest=longest, top=top)
    assert got(found) == brute([(lang, t) for _, t, lang in rows], 4, longest, percent, top)


def test_runs_and_prefixes_across_many_parts(spark):
    """A hot first word and a hot window over parts of a few rows each."""
    rows = [("en", "a b c d e " * 300), ("en", " ".join(f"a x{i % 40} y{i % 3}" for i in range(3000))), ("en", "a a a a a a a " * 50)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        found = got(P.mine(docs, min_count=20, block_tokens=100))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found == brute(rows, 20)


def test_bitmap_only_prunes(spark, make_docs, monkeypatch):
    """It holds every frequent pair, and taking all pairs for frequent changes no result."""
    pairs = spark.createDataFrame([(i * 7 + 1, i * i + 1) for i in range(500)], "w1 long, w2 long")
    held = P.pair_bitmap(pairs, 1 << 15)
    at = P._pair_place(np.arange(500) * 7 + 1, np.arange(500) ** 2 + 1, 1 << 15)
    assert np.unpackbits(held, bitorder="little").sum() == len(np.unique(at))
    assert ((held[at >> 3] >> (at & 7)) & 1).all()
    rows = texts(5)
    monkeypatch.setattr(P, "pair_bitmap", lambda pairs: np.full(4096, 255, np.uint8))
    assert got(P.mine(make_docs(rows), min_count=4, block_tokens=300)) == brute([(lang, t) for _, t, lang in rows], 4)


def test_edge_rows(spark, make_docs):
    assert got(P.mine(make_docs([(1, "x")]).where("false"), min_count=1)) == []
    rows = [(1, None, "en"), (2, "", None), (3, " \t.,;\n", "fr"), (4, "b" * 200_000 + " c", "en"), (None, "A b, a B a\tb", None),
            (6, "one", "de"), (6, "one", "de"), (7, "x. y! z", "de")]
    for least in (1, 2):
        assert got(P.mine(make_docs(rows), min_count=least)) == brute([(r[2], r[1]) for r in rows], least)


def test_scores_beyond_64_bits_are_exact(spark):
    big = [(3_000_000_007, 2_000_000_000_003, 4_000_000_009, 5_000_000_029), (100, 10**13, 101, 10**13), (10**12, 10**13, 10**12, 10**12),
           (7, 22, 7, 7)]
    df = spark.createDataFrame(big, "a long, n long, l long, r long")
    rows = df.select(*df.columns, P.score(*map(F.col, df.columns)).cast("long").alias("s")).collect()
    assert [r["s"] for r in rows] == [1000 * a * n // (le * r) for a, n, le, r in big]


@pytest.mark.parametrize("buckets, bits", [(1, 1 << 15), (8, 1 << 15), (8, 1 << 27), (None, 1 << 27)])
def test_numbers_of_a_blocks_words_in_packed_rows(spark, documents, buckets, bits):
    """As many rows in the join as blocks and buckets, not one for each word of a block."""
    blocks = P.make_blocks(documents, "lang", "text", 20_000).cache()
    all_words = blocks.select("lang", F.explode("words").alias("word")).distinct()
    words = all_words.where(F.crc32(F.col("word").cast("binary")) % 3 == 0).withColumn("id", F.monotonically_increasing_id() + 1).cache()
    want = {}
    for r in blocks.select("block", "lang", F.posexplode("words").alias("at", "word")).join(words, ["lang", "word"]).collect():
        want.setdefault(r.block, set()).add((r["at"], r["id"]))
    found = P.own_numbers(blocks, words, buckets, bits)
    rows = found.collect()
    assert {r.block: {(x["at"], x["id"]) for x in r.own} for r in rows} == want and len(rows) == len(want)
    assert sum(len(r.own) for r in rows) == sum(map(len, want.values()))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = re.findall(r"Join [^\n]*", plan)
    assert len(joins) == 1 and "bucket#" in joins[0] and "word#" not in joins[0]
    blocks.unpersist(), words.unpersist()


def test_both_python_steps_of_the_packed_join_are_in_tasks_of_their_own(spark, documents):
    """However few words there are: a broadcast would put both in one task, with two workers a core."""
    blocks = P.materialize(P.make_blocks(documents, "lang", "text", 20_000))
    words = P.materialize(blocks.select("lang", F.explode("words").alias("word")).distinct()
                          .withColumn("id", F.monotonically_increasing_id() + 1))
    found = P.own_numbers(blocks, words, 2)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and plan.count("MapInArrow") == 2


@pytest.mark.parametrize("longest, shortest", [(2, 2), (5, 3)])
def test_a_blocks_windows_take_little_memory(longest, shortest, monkeypatch):
    """A block of 1.5 million tokens, by a few first words at a time: 120 and 83 MB before, and the same rows however many at a time."""
    rng = np.random.default_rng(1)
    tokens = np.minimum(rng.zipf(1.25, 1_500_000), 60_000).astype("<u4")
    ids = rng.permutation(200_000)[:20_000] + 1
    own = pa.array([[{"at": i, "id": int(x)} for i, x in enumerate(ids)]])
    batch = pa.RecordBatch.from_arrays([pa.array([P._shrink(tokens)], pa.binary()), own], names=["tokens", "own"])
    bitmap = None if shortest == 2 else rng.integers(0, 256, 1 << 20, dtype=np.uint8)
    driver = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value)))
    numbered = SimpleNamespace(sparkSession=driver, mapInArrow=lambda run, schema: run)
    found = []
    for at_once in (None, 5_000, 1 << 30):
        if at_once:
            monkeypatch.setattr(P, "AT_ONCE", at_once)
        run = P.windows(numbered, longest, shortest, bitmap)
        tracemalloc.start()
        rows = list(run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1] - sum(b.nbytes for b in rows)
        tracemalloc.stop()
        assert at_once or peak < 70e6
        found.append(pa.Table.from_batches(rows).combine_chunks())
    assert found[0].num_rows > 100_000 and found[0].equals(found[1]) and found[0].equals(found[2])


def test_few_large_rows_are_handed_to_python_at_a_time(spark, make_docs, monkeypatch):
    """Else a task holds all packed rows of its bucket at once, which grow with the number of blocks."""
    name, at, written = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, P.materialize
    before = spark.conf.get(name)

    def note(df, label):
        at[label] = int(spark.conf.get(name))
        return written(df, label)

    monkeypatch.setattr(P, "materialize", note)
    rows = texts(1)
    assert got(P.mine(make_docs(rows), min_count=4, block_tokens=300)) == brute([(lang, t) for _, t, lang in rows], 4)
    assert at["phrase_blocks"] == P.TEXT_ROWS and at["numbered"] == P.PACKED_ROWS
    assert at["pairs"] == at["phrases"] == int(before) and spark.conf.get(name) == before
