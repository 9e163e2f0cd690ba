"""Importance resampling towards a target's distribution of hashed n-grams.

Features are runs of 1 to 3 words; a feature's bucket is its CRC-32 modulo
``buckets``. A bucket's gain is the log ratio of its smoothed share in the
target to that in the corpus, a document's weight the sum over its features,
and the draw keeps the highest weights after Gumbel noise from the id.

CRC by position table. CRC-32 is affine: the CRC of n bytes is a constant of n,
XOR what each byte contributes by its value and its distance from the end. The
table holds those contributions for distances up to ``DEPTH``, so the CRCs of
all features of a stretch of text are one gather and one
``bitwise_xor.reduceat`` over the feature spans; nothing runs byte by byte.
A longer span folds blockwise: it is cut into blocks from its end, and a
block's value is carried over the zero bytes behind it by tables for powers of
two.

How it runs. One pass counts the buckets (map side, ``buckets`` rows a task), one pass
weighs the documents: no text is shuffled. The driver holds ``buckets`` gains.
The draw is a distributed numbering by score, so no task holds all documents.

Defined cases: a null or wordless text has no features, weight 0 and is not
eligible; a null id counts as empty text in the noise and comes last among ties;
repeated rows count, and compete, as often as they come; an empty target or
corpus has all counts 0; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starpipe.operators.keys import add_key
from starpipe.sources.io import materialize

#: Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
#: Bytes that the position table covers, and the length of a block of a longer span.
DEPTH = 64
#: Bytes of text, words and span bytes worked on at once.
TEXT_BYTES, SLICE_WORDS, SPAN_BYTES = 1 << 20, 1 << 17, 1 << 20
ONES = np.uint32(0xFFFFFFFF)

#: A-Z in lower case, digits, a-z and all bytes of other characters as they are, the rest a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _after_byte(state: np.ndarray) -> np.ndarray:
    """CRC states after eight steps of the shift register (one zero byte)."""
    for _ in range(8):
        state = np.where(state & np.uint32(1), (state >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), state >> np.uint32(1))
    return state.astype(np.uint32)


class PositionTable:
    """CRC-32 of many byte spans at once."""

    def __init__(self, depth: int = DEPTH):
        self.depth = depth
        rows = [_after_byte(np.arange(256, dtype=np.uint32))]
        for _ in range(depth - 1):
            rows.append(_after_byte(rows[-1]))
        self.by_distance = np.concatenate(rows)          # [distance from the end * 256 + byte]
        # _zeros[k][j]: where byte j of a state goes under 2**k zero bytes.
        self._zeros = [np.stack([_after_byte(np.arange(256, dtype=np.uint32) << np.uint32(8 * j)) for j in range(4)])]
        self.of_length = self.after_zeros(np.full(depth + 1, ONES), np.arange(depth + 1)) ^ ONES

    def _apply(self, k: int, state: np.ndarray) -> np.ndarray:
        while len(self._zeros) <= k:
            last = len(self._zeros) - 1
            self._zeros.append(np.stack([self._apply(last, self._zeros[last][j]) for j in range(4)]))
        t = self._zeros[k]
        return t[0][state & 255] ^ t[1][(state >> 8) & 255] ^ t[2][(state >> 16) & 255] ^ t[3][state >> 24]

    def after_zeros(self, state: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Each CRC state after its ``n`` zero bytes."""
        state, n, k = state.copy(), np.asarray(n, np.int64), 0
        while (left := n >> k).any():
            on = np.flatnonzero(left & 1)
            state[on] = self._apply(k, state[on])
            k += 1
        return state

    def _contributions(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The bytes' part of the CRC of spans of 1 to ``depth`` bytes."""
        out = np.empty(len(starts), np.uint32)
        lens = (ends - starts).astype(np.int32)
        behind = np.cumsum(lens, dtype=np.int64)
        a = 0
        while a < len(starts):
            done = int(behind[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(behind, done + SPAN_BYTES, side="right")))
            n = lens[a:b]
            first = np.cumsum(n, dtype=np.int32) - n
            nth = np.arange(first[-1] + n[-1], dtype=np.int32)
            origin = int(starts[a:b].min())
            byte = data[origin:][nth + np.repeat((starts[a:b] - origin).astype(np.int32) - first, n)]
            distance = np.repeat(first + n - 1, n) - nth
            out[a:b] = np.bitwise_xor.reduceat(self.by_distance[(distance << 8) + byte], first)
            a = b
        return out

    def crc(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRC-32 (unsigned) of each non-empty span ``data[start:end]``."""
        lens = ends - starts
        if not len(lens):
            return np.empty(0, np.uint32)
        if lens.max() <= self.depth:
            return self._contributions(data, starts, ends) ^ self.of_length[lens]
        blocks = -(-lens // self.depth)
        first = np.cumsum(blocks) - blocks
        behind = (np.arange(int(blocks.sum())) - np.repeat(first, blocks)) * self.depth   # bytes after the block
        block_ends = np.repeat(ends, blocks) - behind
        block_starts = np.maximum(np.repeat(starts, blocks), block_ends - self.depth)
        parts = self.after_zeros(self._contributions(data, block_starts, block_ends), behind)
        return np.bitwise_xor.reduceat(parts, first) ^ self.after_zeros(np.full(len(lens), ONES), lens) ^ ONES


def feature_buckets(texts: list[bytes | None], table: PositionTable, buckets: int, longest: int = 3
                    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of the texts' words: the text index of each word, and the text index and bucket
    of each feature that starts at one of them."""
    lens = np.array([len(t or b"") + 1 for t in texts], np.int64)
    raw = np.frombuffer(b" ".join([t or b"" for t in texts] + [b""]).translate(_FOLD), np.uint8)
    inside = raw != 32
    kept = inside.copy()
    kept[1:] |= inside[:-1]                               # each word and one space
    data = raw[kept]
    ends = np.flatnonzero(data == 32)
    starts = np.empty_like(ends)
    starts[:1], starts[1:] = 0, ends[:-1] + 1
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    text = np.searchsorted(np.cumsum(lens), np.flatnonzero(begins), side="right")
    for a in range(0, len(starts), SLICE_WORDS):
        b = min(a + SLICE_WORDS, len(starts))
        owners, found = [], []
        for n in range(longest):
            at = np.arange(a, min(b, len(starts) - n))
            at = at[text[at] == text[at + n]]
            owners.append(text[at])
            found.append(table.crc(data, starts[at], ends[at + n]) % np.uint32(buckets))
        yield text[a:b], np.concatenate(owners), np.concatenate(found)


def _groups(texts: Iterable[bytes | None]) -> Iterator[list[bytes | None]]:
    """The texts in lists of about ``TEXT_BYTES``."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t or b"")
        if size >= TEXT_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _texts(column: pa.Array) -> Iterator[bytes | None]:
    values = column.cast(pa.binary())
    return (v.as_py() for v in values)


def bucket_counts(texts: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = PositionTable(), np.zeros(buckets, np.int64)
        for batch in batches:
            for group in _groups(_texts(batch.column(0))):
                for _, _, found in feature_buckets(group, table, buckets):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    rows = (texts.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    s, t, buckets = corpus.astype(float), target.astype(float), len(corpus)
    ratio = (t + 1) * (float(corpus.sum()) + buckets) / ((s + 1) * (float(target.sum()) + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) for each document; no shuffle."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PositionTable()
        for batch in batches:
            out, ids = [], batch.column(0)
            for group in _groups(_texts(batch.column(1))):
                sums = np.zeros((3, len(group)), np.int64)
                for word_text, owner, found in feature_buckets(group, table, len(gain)):
                    sums[0] += np.bincount(word_text, minlength=len(group))
                    sums[1] += np.bincount(owner, minlength=len(group))
                    # Sums of a slice are whole numbers far below 2**53.
                    sums[2] += np.bincount(owner, gain[found], len(group)).astype(np.int64)
                out.append(sums)
            if out:
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, np.concatenate(out, axis=1))],
                                                 names=["id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def noise(id_col: str, seed: int):
    """Thousandths of Gumbel noise from the id's SHA-256, rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", buckets: int = 10_000, percent: int = 5, min_words: int = 20,
             seed: int = 42) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) for each document; ``rank`` counts the
    drawn ones from 1 and is null for the others. Of the documents with at least
    ``min_words`` words, ``percent`` in a hundred (rounded down) are drawn."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    weighed = materialize(
        weigh(docs, gain, id_col, text_col)
        .withColumns({"score": F.col("weight") + noise("id", seed), "short": F.col("n_words") < min_words}), "weighed")
    drawn = weighed.where("NOT short").count() * percent // 100
    place = add_key(weighed, "place", [("short", "asc"), ("score", "desc"), ("id", "asc")])
    return place.select("id", "n_words", "n_features", "weight", "score",
                        F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))
