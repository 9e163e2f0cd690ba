"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens. A round gives each queue its quantum, the
window length times the queue's target share; a queue sends the whole
tokens of what it is owed and carries the fraction on as its deficit. The
rounds follow one another in one stream, cut every ``window`` tokens. So
every window has the target proportions to within one token a source, and
the deficits carry across windows and partitions alike.

After r rounds a queue with D of the stream's X tokens has sent
``floor(r * window * D / X)`` tokens, deficit included. So where any token
lies follows from its place in its queue by integer arithmetic, and no task
waits for another's deficit: documents are numbered inside each partition as
they are tokenised, partition sums give every partition its place in the
queues, and each document finds its own windows.

By default the target is each source's share of the tokens, and all queues
end together. With other targets, the stream has phases: one ends when a
queue runs dry, and the next shares out among the queues left.

Any number of sources is packed. Up to ``MAX_SOURCES``, each is a queue of its
own. Of more, those with a target and the largest are, and all others
together are one further queue, whose share is the sum of theirs: inside it,
sources follow one another by partition and name, placed by sums in Spark.

Defined cases: a null or empty text is the end id alone; a null source
shares the queue of the empty one; repeated rows are packed as often as they
come; equal ids are not told apart by the result; extra columns are
ignored; no documents give no pieces.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from fractions import Fraction
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starpipe.llm.common import arrow_rows, shared
from starpipe.sources.io import materialize

#: Words whose ids a task remembers; beyond that it starts anew.
CACHE_WORDS = 800_000
#: Bytes of a word up to which its ids are remembered.
CACHE_BYTES = 48
#: Documents whose new words are encoded together.
GROUP = 4
#: Letters, to be checked, between ASCII punctuation, which has ids of its own beside letters.
#: The apostrophe is left out, as it may begin a contraction.
EDGED = re.compile(rb"([!-&(-/:-@\[-`{-~]*)([a-z\x80-\xff]+)([!-&(-/:-@\[-`{-~]*)")
#: Sources that have a queue of their own; further ones share one.
MAX_SOURCES = 100_000
#: Cells (rounds by queues) that are computed at a time.
CELLS = 1 << 17
#: Pieces that a task holds before it hands them on.
PIECES = 50_000
#: Documents that go to a task's Python, and are worked on, at a time.
ROWS = 500


class Known(dict):
    """Ids of words; a word that it does not hold has none, and is put down in ``missed``."""
    missed: list[bytes] = []

    def __missing__(self, word: bytes) -> None:
        self.missed.append(word)


def _loaded(spec: str) -> tuple:
    """(tokenizer, whether an id ends a word, contents of added tokens) of ``spec``. A worker keeps the last
    ones from task to task, so many small tasks do not load one each. Functions of this package travel by
    value and see new globals in each task: the tokenizers package, loaded once a worker, holds them."""
    import tokenizers
    held = getattr(tokenizers, "_starpipe_loaded", None)
    if held is None or held[0] != spec:
        tokenizer = tokenizers.Tokenizer.from_str(spec)
        vocab = tokenizer.get_vocab(with_added_tokens=True)
        parts = json.loads(spec)
        suffix = parts["model"].get("end_of_word_suffix") or "\0"
        ends = np.zeros(max(vocab.values()) + 1, bool)
        ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        held = tokenizers._starpipe_loaded = (spec, tokenizer, ends, [t["content"] for t in parts.get("added_tokens") or []])
    return held[1:]


class WordTokenizer:
    """Ids of texts, by way of their words, for tokenizers that drop white space and case,
    never join across white space or between letters and punctuation, and mark a word's last id.

    A word's ids are looked up, as bytes. A new word loses the punctuation around it, which has ids
    of its own. What is left and all a-z goes to the tokenizer's model as it is, if the
    tokenizer does the same; other letters are encoded in one run and cut behind each id that ends
    a word; any other new word is encoded by itself."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.ends, added = _loaded(spec)
        normalizer = self.tokenizer.normalizer
        self.normalized = normalizer.normalize_str if normalizer is not None else str
        self.dtype = np.dtype("<u2" if len(self.ends) <= 1 << 16 else "<u4")
        self.known = Known()
        self.model = self.tokenizer.model
        self.direct = self._takes_letters(added)

    def _takes_letters(self, added: list[str]) -> bool:
        """Whether words of a-z reach the model unchanged: asked of the tokenizer."""
        probes = [*ascii_lowercase, ascii_lowercase, ascii_lowercase[::-1], "the", "internationalisation", "qzxj" * 20]
        return (not any(t.strip().isalpha() for t in added)
                and all([t.id for t in self.model.tokenize(x)] == self.tokenizer.encode(x, add_special_tokens=False).ids for x in probes))

    def _only_letters(self, word: bytes) -> bool:
        """Whether the word is letters as the tokenizer sees it: normalised, some letters end in a
        mark, which joins punctuation behind it."""
        return word.isascii() or self.normalized(word.decode()).isalpha()

    def _alone(self, words: list[bytes]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.array(g.ids, self.dtype).tobytes() for g in got]

    def _letters(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are letters only."""
        if self.direct:
            # Texts with special tokens keep their case.
            plain, words = [w for w in words if w.isascii() and w.islower()], [w for w in words if not (w.isascii() and w.islower())]
            flat, cuts = [], [0]
            for w in plain:
                flat += [t.id for t in self.model.tokenize(w.decode())]
                cuts.append(len(flat) * self.dtype.itemsize)
            raw = np.array(flat, self.dtype).tobytes()
            return {**{w: raw[a:b] for w, a, b in zip(plain, cuts, cuts[1:], strict=False)}, **self._run_of_letters(words)}
        return self._run_of_letters(words)

    def _run_of_letters(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are letters only, from one run of the tokenizer."""
        if not words:
            return {}
        got = self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids
        ids = np.array(got, self.dtype)
        cuts = ((np.flatnonzero(self.ends[ids]) + 1) * self.dtype.itemsize).tolist()
        raw = ids.tobytes()
        if len(cuts) != len(words) or cuts[-1] != len(raw):  # some lower case is more than letters
            return dict(zip(words, self._alone(words), strict=True))
        return dict(zip(words, [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)], strict=True))

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of new words, which are remembered if they are short."""
        texts = b" ".join(words).decode().split(" ")
        known, letters, edged, alone = self.known, [], {}, []
        for w, t in zip(words, texts, strict=True):
            if t.isalpha():
                letters.append(w)
            elif (m := EDGED.fullmatch(w)) and b"<|" not in w and self._only_letters(m[2]):
                edged[w] = m.groups()
            else:
                alone.append(w)
        out = self._letters([*letters, *{x[1] for x in edged.values() if x[1] not in known}])
        alone += {x for p in edged.values() for x in (p[0], p[2]) if x and x not in known}
        out.update(zip(alone, self._alone(alone), strict=True))
        have = {**{x: known[x] for p in edged.values() for x in p if x in known}, **out, b"": b""}
        out.update({w: have[a] + have[b] + have[c] for w, (a, b, c) in edged.items()})
        if len(known) + len(out) > CACHE_WORDS:
            self.known = Known()
        self.known.update((w, x) for w, x in out.items() if len(w) <= CACHE_BYTES)
        return out

    @staticmethod
    def _words(text: bytes) -> list[bytes]:
        return text.split() if b"<|" in text else text.lower().split()  # special tokens have a case

    def __call__(self, texts: list[bytes | None], end_id: int) -> Iterator[np.ndarray]:
        tail = np.array([end_id], self.dtype).tobytes()
        for at in range(0, len(texts), GROUP):
            self.known.missed = missed = []
            ids = []
            for t in texts[at:at + GROUP]:
                before = len(missed)
                got = list(map(self.known.__getitem__, self._words(t or b"")))
                ids.append((got, len(missed) - before))
            learned = self._learn(list(dict.fromkeys(missed))) if missed else {}
            new = iter(missed)
            for got, n in ids:
                place = -1
                for _ in range(n):
                    place = got.index(None, place + 1)
                    got[place] = learned[next(new)]
                yield np.frombuffer(b"".join(got) + tail, self.dtype)


def tokenise(docs: DataFrame, spec: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """(part, source, id, n, before, ids): each document's ids as little-endian
    bytes and the number of its source's tokens before it in its partition."""
    held = shared(docs.sparkSession, spec)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
                       F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sent, part = WordTokenizer(held()), {}, TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                sources, n, before, ids = some.column(1).to_pylist(), [], [], []
                for source, own in zip(sources, encode(some.column(2).cast(pa.binary()).to_pylist(), end_id), strict=True):
                    n.append(len(own))
                    before.append(sent.get(source, 0))
                    sent[source] = before[-1] + len(own)
                    ids.append(own.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n), pa.int32()), some.column(1), some.column(0),
                     pa.array(n, pa.int64()), pa.array(before, pa.int64()), pa.array(ids, pa.binary())],
                    names=["part", "source", "id", "n", "before", "ids"])

    return rows.mapInArrow(run, f"part int, source string, id {id_type}, n long, before long, ids binary")


class Schedule:
    """Where each token of each queue lies in the stream."""

    def __init__(self, totals: dict[str, int], window: int, target: dict[str, float] | None = None):
        self.window = window
        self.sources = sorted(totals)
        self.number = {s: i for i, s in enumerate(self.sources)}
        left = [totals[s] for s in self.sources]
        weights = left if target is None else [Fraction(target.get(s, 0)) for s in self.sources]
        #: (stream start, tokens, per queue: tokens of the phase, tokens before it)
        self.phases: list[tuple[int, int, list[int], list[int]]] = []
        start, done = 0, [0] * len(left)
        while any(left):
            active = [w if n else 0 for w, n in zip(weights, left, strict=True)]
            if not any(active):  # queues without a target follow the others
                active = left
            time = min(Fraction(n) / w for n, w in zip(left, active, strict=True) if w)
            sent = [min(n, int(w * time)) for n, w in zip(left, active, strict=True)]
            self.phases.append((start, sum(sent), sent, list(done)))
            start += sum(sent)
            left = [n - k for n, k in zip(left, sent, strict=True)]
            done = [n + k for n, k in zip(done, sent, strict=True)]

        self.shares = [np.array(sent, np.int64) for _, _, sent, _ in self.phases]

    def runs(self, source: str, first: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(start in the run of ``n`` tokens, place in the stream, length) of
        every piece of queue tokens ``first`` to ``first + n``."""
        q, window = self.number[source], self.window
        for (start, total, sent, done), share in zip(self.phases, self.shares, strict=True):
            own, lo, hi = sent[q], max(first - done[q], 0), min(first + n - done[q], sent[q])
            if lo >= hi:
                continue
            # Round r sends token k if floor((r + 1) * window * own / total) is the first to exceed k.
            dense = window * own >= total                    # then every round sends a token, else at most one
            r0, r1 = (-(-(k + 1) * total // (window * own)) - 1 for k in (lo, hi - 1)) if dense else (lo, hi - 1)
            step = max(1, CELLS // len(sent))
            for r in range(r0, r1 + 1, step):
                rounds = np.arange(r, min(r + step, r1 + 1))
                if not dense:                                # these are tokens
                    quot, rest = _times_over(rounds + 1, total, window * own)
                    rounds = quot - (rest == 0)
                rounds = rounds[:, None] * window
                after = np.minimum(share[:q + 1], _times_over(rounds + window, share[:q + 1], total)[0])
                before = np.minimum(share[q:], _times_over(rounds, share[q:], total)[0])
                at = np.maximum(before[:, 0], lo)
                size = np.minimum(after[:, q], hi) - at
                place = start + after[:, :q].sum(1) + before.sum(1) + at - before[:, 0]
                for a, where, left in zip((at + (done[q] - first)).tolist(), place.tolist(), size.tolist(), strict=True):
                    while left:
                        piece = min(left, window - where % window)
                        yield a, where, piece
                        a, where, left = a + piece, where + piece, left - piece


def _times_over(a: np.ndarray, b: np.ndarray | int, by: int) -> tuple[np.ndarray, np.ndarray]:
    """Quotient and remainder of ``a * b`` over ``by``, in 64 bits: by long division, a few bits of ``a``
    at a time, as many as the products have room for. ``b`` and ``by`` are below 2^61."""
    top, most = int(a.max()), int(np.max(b, initial=0))
    if top * most < 1 << 62:
        return np.divmod(a * b, by)
    bits = 62 - max(most, by).bit_length()
    quot = rest = np.int64(0)
    for low in range(bits * ((top.bit_length() - 1) // bits), -1, -bits):
        more, rest = np.divmod((rest << bits) + (a >> low & (1 << bits) - 1) * b, by)
        quot = (quot << bits) + more
    return quot, rest


def _queues(sums: DataFrame, target: dict[str, float] | None) -> tuple[dict[str, int], DataFrame]:
    """Tokens by queue, and (source, part, queue, base): the queue's tokens before the part's of the source."""
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    totals = {r["source"]: r["n"] for r in by_source.limit(MAX_SOURCES + 1).collect()}
    before = (Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(*before)), F.lit(0))
    if len(totals) <= MAX_SOURCES:
        return totals, sums.select("source", "part", F.col("source").alias("queue"), earlier.alias("base"))

    by_source = materialize(by_source, "source_totals")
    aimed = list(target or {})
    chosen = by_source.withColumn("aimed", F.col("source").isin(aimed) if aimed else F.lit(False))
    chosen = materialize(chosen.orderBy(F.desc("aimed"), F.desc("n"), "source")
                         .limit(max(MAX_SOURCES, len(aimed))).select("source", "n"), "own_queues")
    totals = {r["source"]: r["n"] for r in chosen.collect()}
    rest = "rest"
    while rest in totals or rest in aimed:
        rest += "_"
    tail = materialize(sums.join(chosen, "source", "left_anti").select("source", "part", "n"), "tail_sums")
    parts = tail.groupBy("part").agg(F.sum("n").alias("n"))
    if n := parts.agg(F.sum("n")).first()[0]:
        totals[rest] = n
    # One row a part in one task; within a part, a row for each of its small sources.
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*before)), F.lit(0)).alias("start"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("source").rowsBetween(*before))
    tail = (tail.withColumn("inside", F.coalesce(inside, F.lit(0))).join(parts, "part")
            .select("source", "part", F.lit(rest).alias("queue"), (F.col("start") + F.col("inside")).alias("base")))
    own = sums.join(chosen.select("source"), "source", "left_semi")
    return totals, own.select("source", "part", F.col("source").alias("queue"), earlier.alias("base")).unionByName(tail)


def pack(docs: DataFrame, spec: str, end_id: int = 1, window: int = 2048, target: dict[str, float] | None = None,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", with_ids: bool = False) -> DataFrame:
    """One row a piece: id, start and length in its document's ids, ids_crc32,
    doc_tokens, sequence_id, offset, and ids (little-endian 32-bit) if asked for."""
    with arrow_rows(docs.sparkSession, ROWS):
        tokens = materialize(tokenise(docs, spec, end_id, id_col, text_col, source_col), "tokens")
    sums = materialize(tokens.groupBy("source", "part").agg(F.sum("n").alias("n")), "token_sums")
    totals, base = _queues(sums, target)
    held = shared(docs.sparkSession, Schedule(totals, window, target))
    id_type = tokens.schema["id"].dataType.simpleString()
    placed = tokens.join(base, ["source", "part"]).select("id", F.col("queue").alias("source"), (F.col("base") + F.col("before")).alias("first"), "n", "ids")

    def pieces(id_arrow: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        out = list(zip(*rows, strict=True)) if rows else [()] * 8
        return pa.RecordBatch.from_arrays(
            [id_arrow.take(pa.array(out[0], pa.int32())), *[pa.array(c, pa.int64()) for c in out[1:7]],
             *([pa.array(out[7], pa.binary())] if with_ids else [])],
            names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schedule = held()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                id_arrow = some.column(0)
                rows: list[tuple] = []
                cols = (some.column(i).to_pylist() for i in (1, 2, 3, 4))
                for i, (source, first, n, raw) in enumerate(zip(*cols, strict=True)):
                    ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                    for start, place, size in schedule.runs(source, first, n):
                        own = ids[start:start + size].tobytes()
                        rows.append((i, start, size, zlib.crc32(own), n, place // window, place % window, own if with_ids else None))
                        if len(rows) == PIECES:
                            yield pieces(id_arrow, rows)
                            rows = []
                yield pieces(id_arrow, rows)

    return placed.mapInArrow(run, f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
                                  "sequence_id long, offset long" + ", ids binary" * with_ids)
