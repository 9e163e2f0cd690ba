"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint is cut into ``blocks`` blocks. Two fingerprints at most d bits
apart differ in at most d blocks, so they agree on some choice of
``blocks - d`` blocks. Every distinct fingerprint is joined on each such
choice, and each candidate's Hamming distance is verified in the join.

A bucket of more than ``bucket_cap`` fingerprints (a big family of near copies)
is not expanded into pairs. Its members meet in midpoints instead: two
fingerprints at most d bits apart share a point within ceil(d/2) bits of one and floor(d/2)
bits of the other, and whoever shares such a point is at most d apart. A point
has a bounded number of members, so that way is exact and linear in the
number of fingerprints.

Everything after the fingerprints works on distinct fingerprints, so exact
copies cost one row however many there are.

Defined cases: a null or blank text has fingerprint zero and links like any
other; a null id takes part but is never a component id (a component of null
ids only has a null id); repeated rows come out as often as they came in;
extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starpipe.llm.common import connected_components, map_texts
from starpipe.sources.io import materialize

BITS = 64
SEED = 42


def fingerprint(text: bytes | None, shingle_words: int = 3) -> int:
    """SimHash of one text as a signed 64-bit integer."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle_words, len(words))
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in
                       zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)],
                      dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(docs: DataFrame, text_col: str, name: str, shingle_words: int = 3) -> DataFrame:
    """``docs`` plus its fingerprint (long) in column ``name``; no shuffle."""
    def make():
        return lambda texts: [[fingerprint(t, shingle_words) for t in texts]]
    return map_texts(docs, text_col, [T.StructField(name, T.LongType())], make)


def _block_masks(blocks: int, distance: int) -> list[int]:
    """For each choice of blocks that must agree, the signed 64-bit mask of its bits."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = []
    for kept in combinations(range(blocks), blocks - distance):
        m = sum(1 << b for i in kept for b in range(edges[i], edges[i + 1]))
        masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def _ball(radius: int) -> list[int]:
    """All 64-bit patterns of at most ``radius`` set bits, as signed integers."""
    out = []
    for r in range(radius + 1):
        for c in combinations(range(BITS), r):
            m = sum(1 << b for b in c)
            out.append(m - (1 << 64) if m >> 63 else m)
    return out


def links(prints: DataFrame, max_distance: int = 2, blocks: int = 6, bucket_cap: int = 64) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``prints(fp)`` whose components
    are those of "at most ``max_distance`` bits apart". Every edge is such a pair."""
    if not 0 <= max_distance < blocks:
        raise ValueError("max_distance must be from 0 to blocks - 1")
    masks = F.array(*[F.lit(m).cast("long") for m in _block_masks(blocks, max_distance)])
    keyed = prints.select("fp", F.posexplode(masks).alias("choice", "mask")).select(
        "fp", "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("block"))
    sizes = keyed.groupBy("choice", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(keyed.join(sizes, ["choice", "block"]), "blocks")

    left = shared.where(F.col("n") <= bucket_cap).select("choice", "block", F.col("fp").alias("a"))
    right = left.withColumnRenamed("a", "b")
    same = (left.choice == right.choice) & (left.block == right.block)
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    light = left.join(right, same & (F.col("a") < F.col("b")) & close).select("a", "b")

    crowded = shared.where(F.col("n") > bucket_cap).select("fp").distinct()
    far, near = (max_distance + 1) // 2, max_distance // 2
    point = F.explode(F.array(*[F.lit(m).cast("long") for m in _ball(far)])).alias("flip")
    met = (crowded.select("fp", point)
           .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"),
                   (F.bit_count("flip") <= near).alias("inner"))
           .groupBy("point")
           .agg(F.collect_list("fp").alias("fps"), F.min(F.when(F.col("inner"), F.col("fp"))).alias("a"))
           .where((F.size("fps") > 1) & F.col("a").isNotNull()))
    dense = met.select("a", F.explode("fps").alias("b")).where("a <> b")
    return light.union(dense).distinct()


def classes(prints: DataFrame, max_distance: int = 2, blocks: int = 6, bucket_cap: int = 64) -> DataFrame:
    """(fp, label) for distinct fingerprints ``prints(fp)``: equal labels are one component."""
    prints = materialize(prints.select("fp"), "distinct_prints")
    labels = connected_components(links(prints, max_distance, blocks, bucket_cap))
    return prints.join(labels, prints.fp == labels.node, "left").select("fp", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 3, max_distance: int = 2, blocks: int = 6,
                    bucket_cap: int = 64) -> DataFrame:
    """(id, fp, component_id) for each row: its fingerprint (long) and the
    smallest id that a chain of links reaches, its own included."""
    rows = materialize(
        with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                         "text", "fp", shingle_words).select("id", "fp"), "prints")
    ids = rows.groupBy("fp").agg(F.min("id").alias("id"))
    of = materialize(ids.join(classes(ids, max_distance, blocks, bucket_cap), "fp"), "classes")
    least = of.groupBy("label").agg(F.min("id").alias("component_id"))
    named = of.join(least, "label").select("fp", "component_id")
    return rows.join(named, "fp").select("id", "fp", "component_id")


def hex_fingerprint(col):
    return F.lower(F.lpad(F.hex(col), 16, "0"))
