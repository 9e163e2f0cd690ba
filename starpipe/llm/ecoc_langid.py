"""Language identification by error-correcting output codes.

Each language has a codeword of bits. For each bit a binary classifier over
byte n-grams says on which side of the bit a text lies; a text's language is
the codeword with the least weighted logistic loss against all the bits, and
a text whose two best codewords lie too close is flagged ambiguous.

Fitting counts n-grams per language in Spark over a sample of labelled rows
of about ``rows_per_lang`` rows a language (a documented bound; rows are taken by
a hash of the id). The counts have at most (languages x 131,072) cells
whatever the input, and only they reach the driver. Every bit's classifier
is a log-odds table made from them. The bits' weights come from their error
on the same sample.

Defined cases: a null text or one without any letter is ``und`` with score
0; with nothing to learn from every text is ``und``; with one language every
text with letters gets it with score 1; rows without a label are never
learned from; extra columns are ignored; repeated rows come out as often as
they came in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starpipe.llm.common import fresh, map_texts, shared

#: Bigrams have a cell each; trigrams share as many cells by a hash.
CELLS = 1 << 16
FEATURES = 2 * CELLS
#: Bytes of text that are turned into n-grams at once.
SLICE = 1 << 18
#: ASCII letters in lower case, all other ASCII to a space, the rest as it is.
FOLD = bytes(b if b >= 128 else (b | 32 if chr(b).isalpha() else 32) for b in range(256))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """An (n, bits) array of -1 and 1: the exhaustive code up to seven
    languages, beyond that the random code of best least distance among 64 draws."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 7:
        cols = [(1, *c) for c in product((1, -1), repeat=n - 1) if -1 in c]
        return np.array(cols, np.int8).T
    rng, best, apart = np.random.default_rng(seed), None, -1
    bits = int(np.ceil(10 * np.log2(n)))
    for _ in range(64):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code = code[:, np.abs(code.sum(0)) < n]
        gram = code.astype(np.int32) @ code.T.astype(np.int32)
        least = (code.shape[1] - (gram - np.diag(np.diag(gram))).max()) // 2
        if least > apart:
            best, apart = code, least
    return best


def _grams(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    two = b[:-1] * 256 + b[1:]
    three = ((b[:-2] * 65599 + b[1:-1]) * 65599 + b[2:]) * np.uint32(2654435761)
    return np.concatenate([two, (three >> np.uint32(16)) + np.uint32(CELLS)]).astype(np.int64)


def _slices(text: bytes) -> Iterator[bytes]:
    """A folded text with a space at both ends, in slices that share two bytes."""
    data = b" " + text.translate(FOLD) + b" "
    for at in range(0, max(len(data) - 2, 1), SLICE):
        yield data[at:at + SLICE + 2]


@dataclass(frozen=True)
class Model:
    langs: list[str]
    code: np.ndarray       # (languages, bits)
    odds: np.ndarray       # (features, bits) log-odds of bit 1
    weights: np.ndarray    # (bits,)
    sharpness: float = 20.0
    ambiguity: float = 0.02

    def margins(self, text: bytes) -> np.ndarray:
        """Mean log-odds of each bit over the text's n-grams."""
        total, n = np.zeros(self.code.shape[1]), 0
        for data in _slices(text):
            g = _grams(data)
            n += len(g)
            total += self.odds[g].sum(0, dtype=np.float64)
        return total / max(n, 1)

    def decode(self, margins: np.ndarray) -> tuple[str, float, bool]:
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        z = -self.code * margins * self.sharpness
        losses = (np.logaddexp(0, z) * self.weights).sum(1) / self.weights.sum()
        order = np.argsort(losses, kind="stable")
        p = np.exp(-(losses - losses[order[0]]) * self.code.shape[1])
        score = float(1 / p.sum())
        return self.langs[order[0]], score, bool(losses[order[1]] - losses[order[0]] < self.ambiguity)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        rows_per_lang: int = 5000, smoothing: float = 0.5) -> Model:
    """Learn from the rows of ``docs`` that have a text and a label."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).where("lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    code = codewords(len(langs))
    if len(langs) < 2:
        return Model(langs, code, np.zeros((FEATURES, 0), np.float32), np.ones(0))
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(rows_per_lang / sizes[k]))])
    draw = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.where(F.col("text").isNotNull() & (draw < share[F.col("lang")])).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = seen.setdefault(lang, np.zeros(FEATURES, np.int64))
                for data in _slices(text):
                    own += np.bincount(_grams(data), minlength=FEATURES)
        for lang, own in seen.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(own[at])], names=["lang", "cell", "n"])

    cells = (sample.mapInArrow(count, "lang string, cell int, n long")
             .groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((len(langs), FEATURES))
    for k, lang in enumerate(langs):
        own = cells[cells["lang"] == lang]
        counts[k, own["cell"].to_numpy()] = own["n"].to_numpy()
    share_of = (counts + smoothing) / (counts.sum(1, keepdims=True) + smoothing * FEATURES)
    ones = (code > 0).astype(float)
    odds = np.log(share_of.T @ (ones / ones.sum(0))) - np.log(share_of.T @ ((1 - ones) / (1 - ones).sum(0)))
    model = Model(langs, code, odds.astype(np.float32), np.ones(code.shape[1]))
    return Model(langs, code, model.odds, _bit_weights(sample, model))


def _bit_weights(sample: DataFrame, model: Model) -> np.ndarray:
    """Each bit's weight: the log-odds that its classifier is right on the sample."""
    spark = sample.sparkSession
    held = shared(spark, model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held()
        row = {x: k for k, x in enumerate(m.langs)}
        wrong, n = np.zeros(m.code.shape[1], np.int64), 0
        for batch in batches:
            for text, lang in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                wrong += (m.margins(text) * m.code[row[lang]] <= 0)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(len(wrong)), pa.int32()), pa.array(wrong),
                                          pa.array([n] * len(wrong), pa.int64())], names=["bit", "wrong", "n"])

    got = (sample.mapInArrow(judge, "bit int, wrong long, n long")
           .groupBy("bit").agg(F.sum("wrong").alias("wrong"), F.sum("n").alias("n")).collect())
    weights = np.ones(model.code.shape[1])
    for r in got:
        error = (r["wrong"] + 0.5) / (r["n"] + 1)
        weights[r["bit"]] = max(np.log((1 - error) / error), 0.05)
    return weights


def predict(docs: DataFrame, model: Model, text_col: str = "text",
            names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """``docs`` plus the predicted language, its score and the ambiguity flag
    under ``names``, which replace columns of the same names; no shuffle."""
    spark: SparkSession = docs.sparkSession
    held = shared(spark, model)
    letters = fresh(docs, "text")
    # Texts without letters go in as null: the JVM knows the letters of Unicode.
    rows = docs.withColumn(letters, F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col)))
    inner = [fresh(docs, f"out{i}") for i in range(3)]

    def make():
        m = held()

        def run(texts):
            out = [m.decode(m.margins(t)) if t is not None and m.langs else ("und", 0.0, False) for t in texts]
            return [list(x) for x in zip(*out, strict=True)] if out else [[], [], []]
        return run

    fields = [T.StructField(n, t) for n, t in zip(inner, (T.StringType(), T.DoubleType(), T.BooleanType()), strict=True)]
    out = map_texts(rows, letters, fields, make)
    own = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    return out.select(*own, *[F.col(i).alias(n) for i, n in zip(inner, names, strict=True)])
