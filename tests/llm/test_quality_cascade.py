import re
from collections import Counter

from starpipe.llm import quality_cascade as qc
from starpipe.llm.queries import op3_rule_cascade
from tests.llm.conftest import SF

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = {w for w, n in Counter(windows).items() if n > 1}
    inside = {i + j for i, w in enumerate(windows) if w in many for j in range(3)}
    lines, dup, seen = text.split("\n"), 0, set()
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    chars, symbols = sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>")
    base = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    fails = (symbols * 10 > len(words) or not 2 * len(words) <= chars <= 20 * len(words) or (dup >= 3 and dup * 10 > 3 * len(lines))
             or len(re.findall("[A-Z]", text)) * 2 > chars or len(re.findall("[0-9]", text)) * 10 > 3 * chars
             or sum(c.isalpha() for c in text) * 2 < chars)
    return len(words), chars, symbols, dup, len(inside), base, not (base or fails)


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def test_query_against_brute_force(spark, documents):
    rows = {r.doc_id: tuple(r[c] for c in FIELDS) for r in op3_rule_cascade(spark, SF).collect()}
    assert rows == {d.doc_id: brute(d.text) for d in documents.collect()}
    assert {r[-1] for r in rows.values()} == {True, False}


def test_edge_cases(make_docs):
    prose = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300))
    rows = [(1, None), (2, ""), (3, " \n\t\x0b "), (4, "a b c a b c a b"), (5, prose), (5, prose), (6, prose + "\n" + prose),
            (7, prose.upper()), (8, "### " * 80), (9, "x y z\nx y z\n\nx y z\n"), (None, prose), (10, "1234 5678 " * 3 + prose),
            (11, " ".join(str(i) for i in range(1000, 1200))), (12, "a\x85b c " * 60), (13, prose * 30),
            (14, "ab\\d [x] (y) " + prose), (15, " ".join("—…" for _ in range(80)))]
    got = sorted(((r["id"], *(r[c] for c in FIELDS)) for r in qc.cascade(make_docs(rows)).collect()), key=str)
    assert got == sorted(((k, *brute(t)) for k, t in rows), key=str)
    assert qc.cascade(make_docs(rows).limit(0)).collect() == []


def test_order_is_rejection_per_cost_and_never_the_verdict(spark, make_docs):
    rules = (qc.Rule("cheap", "n_words > 5"), qc.Rule("dear", "n_words > 3"), qc.Rule("never", "false"))
    stats = [qc.RuleStat("cheap", 1.0, 0.3), qc.RuleStat("dear", 10.0, 0.9), qc.RuleStat("never", 0.1, 0.0)]
    order = qc.ordered(rules, stats)
    assert [r.name for r in order] == ["cheap", "dear", "never"]
    df = qc.with_features(make_docs([(i, "w " * i) for i in range(9)]))
    first = df.select("doc_id", qc.first_failure(order).alias("why")).collect()
    last = df.select("doc_id", qc.first_failure(order[::-1]).alias("why")).collect()
    assert {r.doc_id for r in first if r.why} == {r.doc_id for r in last if r.why} == {4, 5, 6, 7, 8}
    assert {r.doc_id: r.why for r in first}[8] == "cheap" and {r.doc_id: r.why for r in last}[8] == "dear"


def test_later_rules_are_not_evaluated(make_docs):
    df = qc.with_features(make_docs([(1, "a b")]))
    order = [qc.Rule("first", "n_words = 2"), qc.Rule("boom", "raise_error('evaluated') IS NULL")]
    assert df.select(qc.first_failure(order).alias("why")).first().why == "first"


def test_sampled_selectivity(make_docs):
    rows = qc.with_features(make_docs([(i, "w " * (i % 4)) for i in range(200)]))
    stats = {s.name: s for s in qc.estimate(rows, (qc.Rule("half", "n_words >= 2"), qc.Rule("none", "n_words > 9")))}
    assert stats["half"].rejects == 0.5 and stats["none"].rejects == 0 and stats["half"].cost > 0


def test_plan_is_native(spark):
    df = qc.with_features(spark.read.parquet(f"{SF}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
