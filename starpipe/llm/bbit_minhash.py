"""MinHash near-duplicates with b-bit signatures.

A document's set is its distinct shingles, as 64-bit hashes. ``bands * rows``
minima of seeded orders of that set are computed once. Each band's minima make
a bucket key; documents that share a bucket are candidates. Of every minimum
only the lowest ``BITS`` bits are kept, packed as bit planes: two signatures'
agreeing minima are counted by XOR, OR and bit count, and as unequal minima
agree in their low bits by chance once in ``2**BITS``, the estimate is
corrected for that. Candidates far below the threshold go; all others are
confirmed on the full sets.

Documents with equal sets are one entry (by a 128-bit digest of the set), so
exact copies cost one row however many there are. No bucket is expanded into
pairs first:

1. Of the entries that share a bucket, the full sets are kept, and the shingles
   that no other one has are counted: no link can share them. An entry with too many
   of its own is alone, and so is most of a family of copies that are edited too much.
2. Every other member of a bucket is a candidate with the bucket's first entry, the one with
   the smallest share of own shingles. Confirmed links give components.
3. Only in buckets that still hold several components, members of different
   components are candidates of each other. The members of buckets of more than
   ``bucket_cap`` entries are not paired by bucket but by their rarest shingles: with all
   shingles in one order, rarest first, two sets of the threshold's similarity have a common one
   among the first few of both, at places that leave enough behind them (``prefix_pairs``). That
   is exact, and copies that are edited too much to be links meet only where edits are the same.

Confirmation streams each candidate's set past the set that it is compared
with, so a task holds two sets. An entry with many candidates is dealt over
several tasks.

What can be missed: a pair of similarity s shares no bucket with probability
``(1 - s**rows)**bands`` (0.8, with 4 rows and 32 bands: 5e-8), a single one,
which may be crowded, with 1e-6, and the estimate, with a margin of six standard
deviations, refuses it with less.

Defined cases: a null or wordless text has an empty set and links with nothing;
a null id takes part but is never a component id (a component of null ids only
has a null id); repeated rows come out as often as they came in; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.llm.common import connected_components
from starpipe.sources.io import materialize

#: Low bits kept of each minimum, and the minima in one long of a bit plane.
BITS, LANES = 2, 64
#: Candidates compared with one copy of an entry's text.
PER_GROUP = 256
#: Standard deviations of the estimate that a candidate may lie below the threshold.
MARGIN = 6.0


def shingles(text: bytes | None, shingle_words: int) -> np.ndarray:
    """The distinct shingles' hashes, sorted."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle_words, len(words))
    h = xxhash.xxh64_intdigest
    return np.unique(np.array([h(joined[a:b]) for a, b in
                               zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)], "<u8"))


def _orders(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Constants of ``n`` orders of 64-bit hashes: x -> (x ^ b) * a, a odd, is one-to-one."""
    a = np.array([xxhash.xxh64_intdigest(b"times %d" % i) | 1 for i in range(n)], np.uint64)
    b = np.array([xxhash.xxh64_intdigest(b"flip %d" % i) for i in range(n)], np.uint64)
    return a, b


def minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of the set under each order."""
    out = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        np.minimum(out, ((hashes[at:at + 1024, None] ^ b) * a).min(axis=0), out=out)
    return out


def pack(values: np.ndarray) -> np.ndarray:
    """The values' lowest bits as bit planes: for each bit, 64 values a long."""
    planes = [np.packbits(((values >> np.uint64(k)) & np.uint64(1)).astype(bool), bitorder="little") for k in range(BITS)]
    return np.concatenate(planes).view("<i8")


def agreeing(left: str, right: str, n: int) -> Column:
    """How many of ``n`` minima agree in all kept bits, from two packed signatures."""
    longs, out = n // LANES, F.lit(n)
    for i in range(longs):
        differ = F.get(left, F.lit(i)).bitwiseXOR(F.get(right, F.lit(i)))
        for k in range(1, BITS):
            at = F.lit(k * longs + i)
            differ = differ.bitwiseOR(F.get(left, at).bitwiseXOR(F.get(right, at)))
        out = out - F.bit_count(differ)
    return out


def estimate(agree: Column, n: int) -> Column:
    """Similarity from agreeing minima, corrected for chance agreement in the kept bits."""
    chance = 2.0 ** -BITS
    return (agree / n - chance) / (1 - chance)


def _least_estimate(percent: int, n: int) -> float:
    """The threshold less ``MARGIN`` standard deviations of the estimate there."""
    s, chance = percent / 100, 2.0 ** -BITS
    p = s + (1 - s) * chance
    return s - MARGIN * (p * (1 - p) / n) ** 0.5 / (1 - chance)


def sign(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, bands: int, rows: int) -> DataFrame:
    """(row, id, text, n, digest, keys, sig) for each row, written once; ``row`` is unique."""
    if bands * rows % LANES:
        raise ValueError(f"bands * rows must be a multiple of {LANES}")
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _orders(bands * rows)
        for batch in batches:
            sizes, digests, keys, sigs = [], [], [], []
            for t in batch.column("text").cast(pa.binary()):
                own = shingles(t.as_py(), shingle_words)
                sizes.append(len(own))
                if not len(own):
                    digests.append(None), keys.append(None), sigs.append(None)
                    continue
                least = minima(own, a, b)
                digests.append(xxhash.xxh128_digest(own.tobytes()))
                keys.append([xxhash.xxh64_intdigest(x.tobytes(), i) - (1 << 63) for i, x in enumerate(least.reshape(bands, rows))])
                sigs.append(pack(least).tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int64()))],
                names=["row", "id", "text", "n", "digest", "keys", "sig"])

    return materialize(plain.mapInArrow(
        run, f"row long, id {plain.schema['id'].dataType.simpleString()}, text string, n long, digest binary, "
             "keys array<long>, sig array<long>"), "signed")


def set_table(texts: DataFrame, shingle_words: int) -> DataFrame:
    """(row, set) from ``texts(row, text)``: each set as sorted signed longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.sort(shingles(t.as_py(), shingle_words).view("<i8")) for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sets, pa.list_(pa.int64()))], names=["row", "set"])

    return texts.select("row", "text").mapInArrow(run, "row long, set array<long>")


def with_own(sets: DataFrame) -> DataFrame:
    """(row, n, own) from ``sets(row, set)``: the set's size and how many of its shingles no other set has."""
    single = (sets.select("row", F.explode("set").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("row").alias("row"))
              .where("c = 1").groupBy("row").agg(F.count(F.lit(1)).alias("own")))
    return (sets.select("row", F.size("set").cast("long").alias("n")).join(single, "row", "left")
            .select("row", "n", F.coalesce("own", F.lit(0)).alias("own")))


def _promising(left: tuple[str, str, str], right: tuple[str, str, str], percent: int, n: int) -> Column:
    """Whether a pair can be a link, from (size, own shingles, signature) of both: what two sets
    share is at most what either shares with any, and the estimate must not be far below the threshold."""
    (na, oa, sa), (nb, ob, sb) = left, right
    most = F.least(F.col(na) - F.col(oa), F.col(nb) - F.col(ob))
    return ((100 * most >= percent * (F.col(na) + F.col(nb) - most))
            & (estimate(agreeing(sa, sb, n), n) >= _least_estimate(percent, n)))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have ``100 * intersection >= percent * union``; ``sets(row, set)``."""
    pairs = materialize(pairs, "pairs")
    several = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / PER_GROUP))).alias("copy"), "n")
    dealt = (pairs.join(several.where("copy = 0").select("a", (F.floor((F.col("n") - 1) / PER_GROUP) + 1).alias("groups")), "a")
             .select("a", F.pmod(F.xxhash64("b"), F.col("groups")).alias("copy"), "b"))
    wanted = (several.select("a", "copy", F.lit(None).cast("long").alias("b"), F.col("a").alias("row"))
              .unionByName(dealt.select("a", "copy", "b", F.col("b").alias("row"))))
    rows = wanted.join(sets, "row").select("a", "copy", "b", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.empty(0, np.int64)
        for batch in batches:
            left, right = [], []
            a, b, held = batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("set")
            hashes, ends = held.values.to_numpy(), held.offsets.to_numpy()
            for i in range(batch.num_rows):
                other = hashes[ends[i]:ends[i + 1]]
                if b[i] is None:
                    own = other.copy()       # each group begins with the entry that the others are compared with
                    continue
                small, large = sorted((own, other), key=len)
                at = np.searchsorted(large, small)
                common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                if 100 * common >= percent * (len(own) + len(other) - common):
                    left.append(a[i])
                    right.append(b[i])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return (rows.repartition("a", "copy").sortWithinPartitions("a", "copy", F.col("b").asc_nulls_first())
            .mapInArrow(run, "a long, b long"))


def prefix_pairs(entries: DataFrame, sets: DataFrame, percent: int, near: Column) -> DataFrame:
    """(a, b), perhaps repeated: every pair of ``entries(row, label, n, own, sig)`` with different labels
    whose sets can have ``100 * intersection >= percent * union`` and that is ``near``.

    With a not larger than b, the overlap must reach ``percent / (100 + percent)`` of both sizes. If the first common
    shingle is at place i of a and j of b, the overlap is at most what follows. So i lies in the first ``index``
    places of a, which has no larger partner for less, and j in the first ``probe`` places of b."""
    tokens = entries.select("row").join(sets, "row").select("row", F.explode("set").alias("h"))
    shared = tokens.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    order = tokens.join(shared, "h").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("c", "h"))).alias("order"))
    # Shingles of one set alone come first and meet nothing: only their number counts.
    single = F.col("n") - F.size("order")
    probe = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    index = F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent)) + 1
    placed = materialize(entries.join(order, "row").withColumns({"single": single.cast("int"), "index": index, "reach": (probe - single).cast("int")})
                         .where("reach > 0").select("*", F.posexplode(F.expr("slice(order, 1, reach)")).alias("at", "x"))
                         .select("row", "label", "n", "own", "sig", "index", (F.col("single") + F.col("at")).alias("at"), F.col("x.h").alias("h")), "prefixes")

    def side(df: DataFrame, s: str) -> DataFrame:
        return df.select("h", F.col("row").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("label", "n", "own", "sig", "at")])

    left = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    enough = (100 * F.col("n_a") >= percent * F.col("n_b")) & ((100 + percent) * left >= percent * (F.col("n_a") + F.col("n_b")))
    met = side(placed.where("at < index"), "a").join(side(placed, "b"), "h").where(
        ordered & (F.col("label_a") != F.col("label_b")) & enough & near)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def links(entries: DataFrame, texts: DataFrame, shingle_words: int, percent: int, bands: int, rows: int, bucket_cap: int) -> DataFrame:
    """(a, b): confirmed links between entries ``entries(row, keys, sig)`` whose components are those of all links."""
    minima_n = bands * rows
    keyed = entries.select("row", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    met = materialize(keyed.join(sizes, "key"), "met")
    sets = materialize(set_table(texts.join(met.select("row").distinct(), "row", "left_semi"), shingle_words), "sets")
    able = materialize(with_own(sets).where(100 * (F.col("n") - F.col("own")) >= percent * F.col("n"))
                       .join(entries.select("row", "sig"), "row"), "able")

    # The first of a bucket is the entry with the least of its own: the likeliest to be linked with the others.
    held = met.join(able.select("row", (F.col("own") / F.col("n")).alias("share")), "row")
    firsts = (held.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("share", "row")).alias("f")).where("m > 1")
              .select("key", "m", F.col("f.row").alias("first")))
    shared = materialize(held.select("key", "row").join(firsts, "key"), "buckets")

    def side(name: str) -> DataFrame:
        return able.select(F.col("row").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "own", "sig")])

    near = _promising(("n_a", "own_a", "sig_a"), ("n_b", "own_b", "sig_b"), percent, minima_n)
    stars = shared.where("row <> first").select(F.col("first").alias("a"), F.col("row").alias("b")).distinct()
    tested = materialize(stars.join(side("a"), "a").join(side("b"), "b").where(near).select("a", "b"), "stars")
    found = materialize(confirm(tested, sets, percent), "links")

    labels = connected_components(found)
    named = shared.join(labels, shared.row == labels.node, "left").select("key", "row", "m", F.coalesce("label", "row").alias("label"))
    mixed = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    of_row = shared.groupBy("row").agg(F.sort_array(F.collect_list("key")).alias("keys"))   # at most ``bands`` a row
    open_ = materialize(named.join(mixed, "key").join(able, "row").join(of_row, "row"), "open_buckets")

    # Pairs of one bucket with different labels that can be links, tested in the join, each in the first bucket that it shares.
    x, y = (open_.where(F.col("m") <= bucket_cap).select("key", F.col("row").alias(s), F.col("label").alias(f"label_{s}"),
                                                         *[F.col(c).alias(f"{c}_{s}") for c in ("n", "own", "sig", "keys")]) for s in "ab")
    first = F.get(F.array_intersect("keys_a", "keys_b"), F.lit(0)) == F.col("key")
    light = (x.join(y, "key").where((F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b")) & near & first)
             .select("a", "b"))
    crowded = open_.where(F.col("m") > bucket_cap).groupBy("row").agg(*[F.first(c).alias(c) for c in ("label", "n", "own", "sig")])
    dense = prefix_pairs(crowded, sets, percent, near)
    # A pair that the stars tested is known, whether it is a link or not.
    known = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = light.unionByName(dense).distinct().join(known, ["a", "b"], "left_anti")
    return found.unionByName(confirm(rest, sets, percent))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    percent: int = 80, bands: int = 32, rows: int = 4, bucket_cap: int = 64) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row: the size of its set, the smallest id
    that a chain of links reaches, its own included, and whether that is its own id."""
    signed = sign(docs, id_col, text_col, shingle_words, bands, rows)
    entries = materialize(
        signed.where("n > 0").groupBy("digest").agg(
            F.min("id").alias("id"), F.min_by(F.struct("row", "keys", "sig"), "row").alias("e")).select("digest", "id", "e.*"), "entries")
    labels = connected_components(links(entries, signed.select("row", "text"), shingle_words, percent, bands, rows, bucket_cap))
    of = materialize(entries.join(labels, entries.row == labels.node, "left")
                     .select("digest", "id", F.coalesce("label", "row").alias("label")), "classes")
    least = of.groupBy("label").agg(F.min("id").alias("component_id"))
    named = of.join(least, "label").select("digest", "component_id")
    out = [F.col("id"), F.col("n").alias("n_shingles"), F.col("component_id"), F.col("id").eqNullSafe(F.col("component_id")).alias("kept")]
    linked = signed.where("n > 0").select("id", "n", "digest").join(named, "digest").select(*out)
    return linked.unionByName(signed.where("n = 0").select("id", "n", F.col("id").alias("component_id")).select(*out))
