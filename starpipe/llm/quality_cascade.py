"""Quality rules as a short-circuit cascade; DataFrame functions only.

Each rule is a Boolean column that says whether a document fails. A sample of
the documents gives each rule's cost (seconds over the sample) and
selectivity (share that fails); rules are ordered by rejection per cost and
chained in one CASE expression, so a document that fails a rule never
reaches the dearer ones behind it. The order changes what a document costs,
never whether it is kept.

Defined cases: a null text has no words and fails; an empty table gives no
rows and any order of rules; repeated rows are judged alike; extra columns
stay, and result columns replace columns of the same names.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.llm.common import fresh
from starpipe.sources.io import materialize

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL expression over the text and feature columns, null counting as false."""
    name: str
    fails: str


@dataclass(frozen=True)
class RuleStat:
    name: str
    cost: float
    rejects: float

    @property
    def worth(self) -> float:
        return self.rejects / max(self.cost, 1e-9)


#: Beyond the base rules: a symbol in ten words; words of odd length; three repeated lines or
#: more that are 30 % of the lines; code points in words of which half are capitals, 30 % are
#: digits, or fewer than half are letters. Those on the raw text cost a pass over it.
RULES = (
    Rule("symbols", "n_symbols * 10 > n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("dup_lines", r"n_dup_lines >= 3 AND n_dup_lines * 10 > 3 * size(split(text, '\\n'))"),
    Rule("capitals", "length(regexp_replace(text, '[^A-Z]+', '')) * 2 > word_chars"),
    Rule("digits", "length(regexp_replace(text, '[^0-9]+', '')) * 10 > 3 * word_chars"),
    Rule("letters", r"length(regexp_replace(text, '[^\\p{L}]+', '')) * 2 < word_chars"),
)


def _bind(value: Column, body) -> Column:
    """``body`` over ``value``, which is computed once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that the array holds twice or more.

    Windows are compared by their 64-bit hash. Sorted with their places, equal
    ones are neighbours; each repeated window then covers three words, or as
    many as lie before the next one."""
    windows = _bind(words, lambda w: F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))
    twice = _bind(F.sort_array(windows), lambda s: F.filter(s, lambda x, j: (
        F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False)))))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = _bind(places, lambda p: F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))))
    return F.aggregate(covered, F.lit(0).cast("long"), lambda acc, x: acc + x)


def features(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = F.filter(F.split(text, SPACE, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup = _bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return _bind(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, rf"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        dup.cast("long").alias("n_dup_lines"),
        _repeated_words(w).alias("n_repeat_words")))


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the five features and base_failed."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    own = [c for c in docs.columns if c.lower() not in names]
    # Through a generator, the struct is computed once for all the columns taken from it.
    f = fresh(docs, "features")
    got = docs.select(*own, F.explode(F.array(features(F.coalesce(F.col(text_col), F.lit(""))))).alias(f))
    return got.select(*own, f"{f}.*").withColumn(
        "base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


def estimate(rows: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000, seed: int = 5) -> list[RuleStat]:
    """Cost and selectivity of each rule on a sample of about ``sample_rows`` rows."""
    total = rows.count()
    sample = materialize(rows.sample(min(1.0, sample_rows / max(total, 1)), seed), "rule_sample")

    def timed(*measures: Column) -> tuple[float, list]:
        took, got = [], None
        for _ in range(2):
            began = time.perf_counter()
            got = sample.agg(F.count(F.lit(1)), *measures).first()
            took.append(time.perf_counter() - began)
        return min(took), list(got)

    empty, _ = timed()
    stats = []
    for rule in rules:
        took, (n, failed) = timed(F.sum(F.coalesce(F.expr(rule.fails), F.lit(False)).cast("long")))
        stats.append(RuleStat(rule.name, max(took - empty, 1e-4), (failed or 0) / max(n, 1)))
    return stats


def ordered(rules: tuple[Rule, ...], stats: list[RuleStat]) -> list[Rule]:
    """Rules by falling rejection per cost; of equal ones the cheaper first, then by name."""
    by_name = {s.name: s for s in stats}
    return sorted(rules, key=lambda r: (-by_name[r.name].worth, by_name[r.name].cost, r.name))


def first_failure(rules: list[Rule]) -> Column:
    """The first rule that a document fails, or null; later rules are not evaluated for it."""
    chain = None
    for rule in rules:
        fails = F.coalesce(F.expr(rule.fails), F.lit(False))
        chain = F.when(fails, F.lit(rule.name)) if chain is None else chain.when(fails, F.lit(rule.name))
    return chain if chain is not None else F.lit(None).cast("string")


def cascade(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
            sample_rows: int = 2000) -> DataFrame:
    """id, the features, base_failed, kept, and failed_rule: base, or the
    first failing rule in the order that the sample gave."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.count()
    sample = with_features(rows.sample(min(1.0, sample_rows / max(total, 1)), 3))
    order = ordered(rules, estimate(sample.where("NOT base_failed"), rules, sample_rows))
    verdict = F.when(F.col("base_failed"), F.lit("base")).otherwise(first_failure(order))
    return (with_features(rows).withColumn("failed_rule", verdict).drop("text")
            .withColumn("kept", F.col("failed_rule").isNull()))
