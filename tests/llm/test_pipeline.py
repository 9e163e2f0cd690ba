import hashlib
from collections import defaultdict

import duckdb
import pytest

import corpus_pipeline
from starpipe.llm import ecoc_langid
from starpipe.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import SF
from tests.llm.test_drr_packing import check_pieces, encode
from tests.llm.test_prefix_decontam import brute as brute_hits
from tests.llm.test_secret_ownership import ASSIGN, base
from tests.llm.test_simhash_blocks import brute_components, brute_fingerprint
from tools.compare import TABLES, digest


def test_stages_and_registration(spark):
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} and set(QUERIES) | {"pipeline"} <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontaminate", "secret_scan", "packing"]
    assert set(entry.oracle_sql()) <= names


def test_each_stage_against_brute_force(spark, documents):
    stage = dict(corpus_pipeline.STAGES)
    docs = documents.collect()

    # 1: clean prose stays; what goes has no letters or no clear language
    kept = stage["language_id"](spark, documents, SF)
    assert kept.columns == documents.columns
    model = ecoc_langid.fit(documents)
    rejected = {r.doc_id for r in ecoc_langid.predict(documents, model).collect() if r.lang_pred == "und" or r.ambiguous}
    assert {r.doc_id for r in kept.collect()} == {d.doc_id for d in docs} - rejected
    assert len(rejected) <= 0.02 * len(docs)

    # 2: the smallest id of each group
    kept = stage["near_duplicates"](spark, documents, SF)
    assert kept.columns == documents.columns
    want = {c for _, _, c in brute_components([(d.doc_id, brute_fingerprint(d.text)) for d in docs], 2)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)

    # 3: no window of a benchmark item
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = stage["decontaminate"](spark, documents, SF)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in brute_hits([(d.doc_id, d.text) for d in docs], items) if not r[-1]}

    # 4: without documents that hold a value of few owners and repositories
    more = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    held = defaultdict(set)
    for d in more.collect():
        for kind, a, b in base(d.text):
            held[ASSIGN.match(d.text, a, b)[2] if kind == 0 else d.text[a:b]].add((d.source, d.doc_id))
    live = {k for of in held.values() if len({s for s, _ in of}) <= 3 and len(of) <= 20 for _, k in of}
    kept = stage["secret_scan"](spark, more, SF)
    assert kept.columns == more.columns and live
    assert {r.doc_id for r in kept.collect()} == {d.doc_id for d in more.collect()} - live

    # 5: every id of every document in one piece
    pieces = [{**r.asDict(), "id": r.doc_id} for r in stage["packing"](spark, documents, SF).collect()]
    check_pieces(pieces, dict(zip([d.doc_id for d in docs], encode([d.text for d in docs]), strict=True)), 2048)


def test_run_is_its_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    want = sorted(map(tuple, docs.select("doc_id", "start", "length", "ids_crc32").collect()))
    digest = hashlib.sha256(str(sorted({r[0] for r in want})).encode()).hexdigest()
    got = corpus_pipeline.run(spark, SF)
    ids = sorted({r.doc_id for r in got.select("doc_id").collect()})
    assert hashlib.sha256(str(ids).encode()).hexdigest() == digest


def test_edge_rows(spark, make_docs):
    prose = "the cat and the dog went over to see what was there and then came home again " * 3
    german = "der hund und die katze gingen hinaus und sahen nach was es da gab und kamen wieder heim " * 3
    rows = [(1, prose), (1, prose), (2, prose), (3, None), (4, ""), (5, "123 ###"), (None, german, "de"), (None, german, "de"),
            (6, german + "token=abcdefgh1 " + "x y z " * 20, "de"), (7, "w " * 30_000 + prose)]
    stage = dict(corpus_pipeline.STAGES)
    docs = make_docs(rows)
    kept = stage["language_id"](spark, docs, SF)
    assert kept.columns == docs.columns and {3, 4, 5}.isdisjoint({r.doc_id for r in kept.collect()})
    once = stage["near_duplicates"](spark, docs, SF)
    assert once.columns == docs.columns
    ids = [r.doc_id for r in once.collect()]
    assert ids.count(1) == 1 and 2 not in ids and ids.count(None) == 1 and ids.count(3) == 1 and 4 not in ids
    assert 6 not in {r.doc_id for r in stage["secret_scan"](spark, docs, SF).collect()}
    clean = stage["decontaminate"](spark, docs, SF)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    empty = docs.limit(0)
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, empty, SF).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, rel = QUERIES[name](spark, SF), con.sql(ORACLE_SQL[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(rel.columns, rel.fetchall())
