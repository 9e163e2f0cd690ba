"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of ``window`` consecutive words (a
shorter item is one window). A window is the set of its two-word shingles,
each at a known place. Shingles are ordered by rarity in the documents, and
as containment must be complete, one shingle is the necessary prefix: the
rarest one. Documents are joined with windows on that shingle only; the
window must then fit between the document's ends at the place the shingle
dictates (length and positional bounds), and the words are compared
exactly over the item-sized window.

With up to about ``block_bytes`` of windows documents never move: each is
read where it lies, against a broadcast index. Beyond that the windows stay a
table. Documents are read once against a bitmap of window hashes, whose size
has a bound; the windows that pass are joined with the table on hash and words,
and the hits, by the text's hash, with the documents. There the whole window
is the prefix, so no frequent shingle makes rows. No window passes through the
driver, and the plan is the same for any number of them.

Defined cases: null and blank texts have no words, so a null document has no
hits and a null item no windows; repeated items count once by their id;
repeated documents come out as often as they came in; a null item id is
written as an empty string; extra columns stay as they are, and result
columns replace document columns of the same names.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starpipe.llm.common import fresh, map_texts, shared
from starpipe.sources.io import materialize

#: ASCII letters in lower case, digits and all bytes over 127 as they are, the rest a space.
FOLD = bytes(b if b >= 128 else (b | 32 if chr(b).isalpha() else (b if chr(b).isdigit() else 32))
             for b in range(256))

#: Bits of the largest bitmap of window hashes (16 MB).
MAX_BITS = 1 << 27


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def _shingles(words) -> list[tuple]:
    return list(zip(words, words[1:], strict=False)) if len(words) > 1 else [tuple(words)]


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = 10) -> DataFrame:
    """Distinct (item, words): the item's id as text and one window, space-joined."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                w = words_of(text)
                if w:
                    out += [(item, b" ".join(w[i:i + window])) for i in range(max(len(w) - window, 0) + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()),
                                              pa.array([x[1] for x in out], pa.binary())], names=["item", "words"])

    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "item string, words binary").distinct()


class Index:
    """The windows of a benchmark, by their necessary prefix shingle."""

    def __init__(self, windows: list[tuple[str, bytes]], rarity: dict[tuple, int]):
        self.by_shingle: dict[tuple, dict] = {}
        self.single = False
        items: dict[tuple, list[str]] = defaultdict(list)
        for item, joined in windows:
            items[tuple(joined.split(b" "))].append(item)
        for words, of in items.items():
            shingles = _shingles(words)
            at = min(range(len(shingles)), key=lambda i: (rarity.get(shingles[i], 0), i))
            self.single |= len(words) == 1
            places = self.by_shingle.setdefault(shingles[at], {})
            places.setdefault((at, len(words)), {})[words] = of

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Covered word ranges (merged, end exclusive) and the items found."""
        index, found, items = self.by_shingle, [], set()
        n = len(words)
        places = [(i, index[p]) for i, p in enumerate(zip(words, words[1:], strict=False)) if p in index]
        if self.single:
            places += [(i, index[(w,)]) for i, w in enumerate(words) if (w,) in index]
        for i, windows in places:
            for (at, size), known in windows.items():
                start = i - at
                if start >= 0 and start + size <= n:
                    of = known.get(tuple(words[start:start + size]))
                    if of:
                        found.append((start, start + size))
                        items.update(of)
        return _merged(found), items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _rarity(docs: DataFrame, text_col: str, windows: list[tuple[str, bytes]]) -> dict[tuple, int]:
    """How often each shingle of these windows occurs in all documents."""
    known = sorted({s for _, joined in windows for s in _shingles(joined.split(b" "))})
    held = shared(docs.sparkSession, {s: i for i, s in enumerate(known)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seen = held(), Counter()
        ones = any(len(s) == 1 for s in number)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                w = words_of(text)
                seen.update(filter(number.__contains__, zip(w, w[1:], strict=False)))
                if ones:
                    seen.update(s for s in zip(w, strict=False) if s in number)
        yield pa.RecordBatch.from_arrays([pa.array([number[s] for s in seen], pa.int32()),
                                          pa.array(list(seen.values()), pa.int64())], names=["shingle", "n"])

    rows = (docs.select(F.col(text_col)).mapInArrow(count, "shingle int, n long")
            .groupBy("shingle").agg(F.sum("n").alias("n")).collect())
    return {known[r["shingle"]]: r["n"] for r in rows}


def find_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = 10, block_bytes: int = 16 << 20,
                       names: tuple[str, str, str] = ("n_words", "hit_spans", "items")) -> DataFrame:
    """``docs`` plus, under ``names``: the number of words; the word ranges
    (start, end) inside occurrences of windows; the sorted ids, as text, of
    items with an occurring window."""
    windows = materialize(item_windows(items, item_id, item_text, window), "windows")
    total = windows.agg(F.sum(F.length("words") + F.length("item") + 100)).first()[0] or 0
    own = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    n_words, spans, found = (fresh(docs, n) for n in ("n_words", "hit_spans", "hit_items"))
    if total > block_bytes:
        rows = _joined(docs, windows, text_col, n_words, spans, found)
        return rows.select(*own, F.col(n_words).alias(names[0]), F.col(spans).alias(names[1]), F.col(found).alias(names[2]))

    known = [(r["item"], bytes(r["words"])) for r in windows.collect()]
    held = shared(docs.sparkSession, Index(known, _rarity(docs, text_col, known) if known else {}))
    fields = [T.StructField(spans, T.ArrayType(T.ArrayType(T.LongType()))), T.StructField(found, T.ArrayType(T.StringType())),
              T.StructField(n_words, T.LongType())]

    def make():
        index = held()

        def run(texts):
            words = [words_of(t) for t in texts]
            got = [index.hits(w) for w in words]
            return [[x[0] for x in got], [sorted(x[1]) for x in got], [len(w) for w in words]]
        return run

    as_spans = F.transform(spans, lambda s: F.struct(s[0].alias("start"), s[1].alias("end")))
    return (map_texts(docs, text_col, fields, make)
            .select(*own, F.col(n_words).alias(names[0]), as_spans.alias(names[1]), F.col(found).alias(names[2])))


def _window_hashes(words: list[bytes], sizes: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each size the hash of the window that starts at each word."""
    each = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    now = each
    for size in range(1, min(max(sizes), len(words)) + 1):
        if size > 1:
            now = (now[:-1] ^ np.uint64(0x27D4EB2F165667C5)) * np.uint64(0x9FB21C651E98DF25) + each[size - 1:]
            now ^= now >> np.uint64(29)
            now *= np.uint64(0xBF58476D1CE4E5B9)
            now ^= now >> np.uint64(32)
        if size in sizes:
            yield size, now


def _joined(docs: DataFrame, windows: DataFrame, text_col: str, n_words: str, spans: str, found: str) -> DataFrame:
    """``docs`` plus the three columns, by a join with the table of windows."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for joined in batch.column(1).to_pylist():
                w = joined.split(b" ")
                out.append((len(w), next(h for _, h in _window_hashes(w, {len(w)}))[0].astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int64())],
                names=["item", "words", "size", "hash"])

    windows = materialize(windows.select("item", "words").mapInArrow(hashed, "item string, words binary, size int, hash long"),
                          "hashed_windows")
    sizes = {r["size"] for r in windows.select("size").distinct().collect()}
    bits = min(MAX_BITS, 1 << (256 * windows.count()).bit_length())
    bit = F.col("hash").bitwiseAND(F.lit(bits - 1))
    cells = (windows.select(F.shiftright(bit, 6).alias("cell"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("bit"))
             .groupBy("cell").agg(F.bit_or("bit").alias("bit")).toArrow())
    bitmap = np.zeros(max(1, bits >> 6), np.int64)
    bitmap[cells["cell"].to_numpy()] = cells["bit"].to_numpy()
    held = shared(docs.sparkSession, bitmap.view(np.uint64))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, low = held(), np.uint64(bits - 1)
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for row in range(batch.num_rows):
                words = words_of(texts[row].as_py())
                if not words:
                    continue
                for size, hashes in _window_hashes(words, sizes):
                    at = hashes & low
                    hit = np.flatnonzero(known[at >> np.uint64(6)] >> (hashes & np.uint64(63)) & np.uint64(1))
                    for some in np.split(hit, range(10_000, len(hit), 10_000)) if len(hit) else ():
                        same = pa.array([row] * len(some), pa.int32())
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(same), batch.column(1).take(same), pa.array(some, pa.int64()),
                             pa.array(some + size, pa.int64()), pa.array(hashes[some].astype(np.int64), pa.int64()),
                             pa.array([b" ".join(words[i:i + size]) for i in some.tolist()], pa.binary())],
                            names=["k1", "k2", "start", "end", "hash", "words"])

    def count(texts):
        return [[len(words_of(t)) for t in texts]]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            out = [[{"start": a, "end": b} for a, b in _merged([(x["start"], x["end"]) for x in own])]
                   for own in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, kind), batch.column(3)],
                                             names=["k1", "k2", "spans", "items"])

    # 128 bits of hash stand for a text; its hits depend on nothing else.
    k1, k2 = F.xxhash64(text_col), F.xxhash64(F.lit(1), F.col(text_col))
    candidates = (docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
                  .mapInArrow(find, "k1 long, k2 long, start long, end long, hash long, words binary").distinct())
    hits = (candidates.join(windows, ["hash", "words"]).groupBy("k1", "k2")
            .agg(F.collect_set(F.struct("start", "end")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
            .mapInArrow(merge, "k1 long, k2 long, spans array<struct<start:long,end:long>>, items array<string>"))
    hits = materialize(hits, "hits").select(F.col("k1").alias("__k1_of_hits"), F.col("k2").alias("__k2_of_hits"),
                                            F.col("spans").alias(spans), F.col("items").alias(found))
    counted = map_texts(docs, text_col, [T.StructField(n_words, T.LongType())], lambda: count)
    none = {spans: F.array().cast(hits.schema[spans].dataType), found: F.array().cast("array<string>")}
    return (counted.join(hits, (k1 == F.col("__k1_of_hits")) & (k2 == F.col("__k2_of_hits")), "left")
            .withColumns({c: F.coalesce(F.col(c), empty) for c, empty in none.items()}))


def hit_words(spans):
    """Number of words inside any of the spans."""
    each = F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["end"] - 1)))
    return F.size(F.array_distinct(each)).cast("long")
