"""Exact substring dedup by a common-prefix interval tree over a sparse suffix array.

Every byte covered by a string of ``length`` bytes that also starts elsewhere
is found; matches never cross documents.

Anchors. Of the ``gram``-byte strings in each window of ``length`` bytes, the one of least
hash (the leftmost of equals) is an anchor. The choice depends on the
window's bytes only, so equal windows hold the same anchor at the same place,
and only about one position in ``length / 2`` becomes a suffix of the array. What an anchor
can be part of is its context: up to ``length - gram`` bytes before it and ``length`` from it on.

Equal contexts. Anchors of equal context are counted, with partial sums before the shuffle;
all of them are covered whole, and one stands for them from here on. So
exact copies, however many, are one suffix.

Tree. The contexts of one anchor string, sorted by what follows, are a piece of an
enhanced suffix array. A stack scan over the common prefixes of neighbours gives the
intervals of the common-prefix tree, deepest first. In an interval of prefix r, those that
share the ``length - r`` bytes to the left repeat a string of ``length`` bytes. All
occurrences in an interval are compared by their left bytes at once, not only
neighbours, so every occurrence is found. A class that is followed by different bytes is
extended to the left while all its members agree; where they differ, it is a maximal
repeat. ``remove_repeats`` takes each context's reach to the right from the groups of this
scan, and its reach to the left from those of the same scan on the reversed left sides;
groups of wider intervals, which lengthen no span, are left out there.

Groups. ``repeat_groups`` outputs all of them: for every string of ``length`` bytes that
occurs more than once and is not always followed by the same byte (an end of text is unlike
any byte and any other end), all its occurrences, extended to the left until they differ, at
most to ``length - gram`` bytes before the anchor.

Crowded anchors, of more than ``crowd`` different contexts, are not held in one task. The
strings of ``length`` bytes around each are tested in ranges, by hashes that Spark counts: if the
whole stretch of a range repeats, so do all its strings; if what they have in common does
not, none does; other ranges are split again, down to single strings. That gives the
same bytes as the tree. Their groups are counted by Spark as well, a row for each string of
``length`` bytes around a context, and only those that repeat are kept.

Defined cases: a null text is empty; a text shorter than ``length`` keeps all bytes; repeated rows
repeat each other; ids need not be distinct (documents are told apart by id and text, and
equal ones share one result); extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.sources.io import materialize

LENGTH, GRAM = 400, 32
#: Bytes of a text that are hashed at once; positions in a piece must fit in 24 bits.
PIECE = 1 << 22
MIX = np.uint64(0x9FB21C651E98DF25)


def anchor_of_each(b: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the anchor of each ``length``-byte string of ``b`` lies, and the hashes of all grams."""
    h, low = _gram_hashes(b, gram), np.uint64((1 << 24) - 1)
    least = _window_minima((h & ~low) | np.arange(len(h), dtype=np.uint64), length - gram + 1) & low
    return least.astype(np.int64), h


def _gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram``-byte string (a power of two), by doubling."""
    h = (b.astype(np.uint64) + np.uint64(1)) * MIX
    h ^= h >> np.uint64(31)
    size, factor = 1, 0x100000001B3
    while size < gram:
        h = h[:len(h) - size] * np.uint64(factor) + h[size:]
        factor, size = factor * factor % (1 << 64), 2 * size
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each run of ``width`` keys."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors_of(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and gram hashes of the anchors. One at a piece's end may come from both pieces."""
    out = []
    for base in range(0, max(len(data) - length + 1, 0), PIECE):
        b = np.frombuffer(data, np.uint8, min(PIECE + length - 1, len(data) - base), base)
        least, h = anchor_of_each(b, length, gram)
        at = least[np.concatenate([[True], least[1:] != least[:-1]])]
        out.append((at + base, h[at]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    pos, once = np.unique(np.concatenate([x[0] for x in out]), return_index=True)
    return pos, np.concatenate([x[1] for x in out])[once]


def _key(id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text")]


def find_anchors(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, beyond: int = 0) -> DataFrame:
    """(id, th, pos, gram, hull) of ``texts(id, th, text)``; ``hull`` hashes the context and ``beyond`` bytes more."""
    id_type = texts.schema["id"].dataType.simpleString()
    before = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_of = xxhash.xxh3_64_intdigest
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows, cols = [], [[], [], []]
                for i, data in enumerate(some.column(2).cast(pa.binary()).to_pylist()):
                    pos, grams = anchors_of(data, length, gram)
                    rows.append(np.full(len(pos), i))
                    hulls = [hash_of(data[max(p - before, 0):p + length + beyond], min(p, before)) for p in pos.tolist()]
                    for c, x in zip(cols, (pos, grams.view(np.int64), np.array(hulls, np.uint64).view(np.int64)), strict=True):
                        c.append(x)
                of = pa.array(np.concatenate(rows).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(of), some.column(1).take(of), *[pa.array(np.concatenate(c).astype(np.int64)) for c in cols]],
                    names=["id", "th", "pos", "gram", "hull"])

    return texts.select("id", "th", "text").mapInArrow(
        run, f"id {id_type}, th long, pos long, gram long, hull long")


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n - 1
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """The common-prefix intervals (prefix, first, last) of a sorted array, children before
    their parents; ``lcp[i]`` is the common prefix of entries i and i + 1."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > value:
            prefix, first = stack.pop()
            yield prefix, first, i
        if value >= 0 and (not stack or stack[-1][0] < value):
            stack.append((value, first))


def maximal_repeats(sides: list[tuple[bytes, bytes]], length: int, counts: list[int] | None = None,
                    widest: bool = False) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes before, bytes from the anchor on, all members) of each maximal repeat of (after, before),
    sorted by ``after``; ``before`` is read outwards. An interval's class by the left bytes that make up
    ``length``, followed by different bytes, is extended to the left while all agree. ``counts``: how
    often each context occurs (once). ``widest``: leave out intervals whose members all have a group already."""
    lcp, told = [common(a[0], b[0]) for a, b in zip(sides, sides[1:], strict=False)], [False] * len(sides)
    around = [-1, *lcp, -1]
    # A context that ends with its text and occurs repeatedly is an interval of its own.
    leaves = [(len(sides[i][0]), i, i) for i, n in enumerate(counts or ())
              if n > 1 and max(around[i], around[i + 1]) < len(sides[i][0]) <= length]
    for prefix, first, last in chain(intervals(lcp), leaves):
        if not 0 < prefix <= length or widest and all(told[first:last + 1]):
            continue
        need, classes = length - prefix, {}
        for i in range(first, last + 1):
            if len(sides[i][1]) >= need:
                classes.setdefault(sides[i][1][:need], []).append(i)
        for members in classes.values():
            if len(members) == 1 and (counts is None or counts[members[0]] == 1):
                continue
            following = {sides[i][0][prefix:prefix + 1] for i in members}
            if len(following) > 1 or b"" in following:
                shared = sides[members[0]][1]
                for i in members:
                    told[i] = True
                    shared = shared[:common(shared, sides[i][1])]
                yield len(shared), prefix, members


def reaches(sides: list[tuple[bytes, bytes]], length: int) -> list[int]:
    """How far to the right each context's maximal repeats reach, or 0."""
    out = [0] * len(sides)
    for _, right, members in maximal_repeats(sides, length, widest=True):
        for i in members:
            out[i] = out[i] or right
    return out


def _dealt(contexts: DataFrame) -> DataFrame:
    """The suffix array of each gram's contexts, whole in one task."""
    cols = contexts.select("gram", "after", "before", "hull", "n", "id", "th", "pos")
    return cols.repartition("gram").sortWithinPartitions("gram", "after", "hull")


def _by_gram(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for _, group in groupby(rows, lambda r: r[0]):
        yield list({r[3]: r for r in group}.values())  # a repeated row's context comes once


def _tree(contexts: DataFrame, length: int) -> DataFrame:
    """(id, th, start, stop) covered by repeats among the contexts of each gram."""
    id_type = contexts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for own in _by_gram(batches):
            right = reaches([(r[1], r[2]) for r in own], length)
            turn = sorted(range(len(own)), key=lambda i: own[i][2])
            left = reaches([(own[i][2], own[i][1]) for i in turn], length)
            back = dict(zip(turn, left, strict=True))
            out += [(r[5], r[6], r[7] - back[i], r[7] + right[i]) for i, r in enumerate(own) if right[i] and r[4] == 1]
            if len(out) > 50_000:
                yield _spans(out, id_arrow)
                out = []
        yield _spans(out, id_arrow)

    from pyspark.sql.pandas.types import to_arrow_type
    id_arrow = to_arrow_type(contexts.schema["id"].dataType)
    return _dealt(contexts).mapInArrow(run, f"id {id_type}, th long, start long, stop long")


def _spans(rows: list[tuple], id_arrow: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(cols[0], id_arrow), *[pa.array(c, pa.int64()) for c in cols[1:]]],
                                      names=["id", "th", "start", "stop"])


def _cells(contexts: DataFrame, ranges: DataFrame, length: int, step: int) -> DataFrame:
    """Each range of offsets (how far before the anchor a string starts) in cells of ``step``: what all
    strings of a cell cover together (``whole``, null if the text ends within) and have in common (``core``)."""
    per = ranges.groupBy("gram", "hull").agg(F.collect_list(F.struct("lo", "hi", "n")).alias("ranges"))
    rows = contexts.join(per, ["gram", "hull"]).select("gram", "hull", "id", "th", "pos", "before", "after", "ranges")
    id_type = contexts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_of = xxhash.xxh3_128_digest
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some, of, out = batch.slice(at, 256), [], []
                cols = (some.column(i).to_pylist() for i in (5, 6, 7))
                for i, (before, after, own) in enumerate(zip(*cols, strict=True)):
                    data, left = before[::-1] + after, len(before)
                    for r in own:
                        for lo in range(r["lo"], r["hi"] + 1, step):
                            hi = min(lo + step - 1, r["hi"])
                            core = (left - lo, left - hi + length)
                            whole = (left - hi, left - lo + length)
                            if core[0] >= 0 and core[1] <= len(data):
                                of.append(i)
                                inside = whole[0] >= 0 and whole[1] <= len(data)
                                out.append((lo, hi, r["n"], hash_of(data[slice(*whole)]) if inside else None, hash_of(data[slice(*core)])))
                got, take = list(zip(*out, strict=True)) or [()] * 5, pa.array(of, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(i).take(take) for i in range(5)],
                     *[pa.array(c, t) for c, t in zip(got, [pa.int64()] * 3 + [pa.binary()] * 2, strict=True)]],
                    names=["gram", "hull", "id", "th", "pos", "lo", "hi", "n", "whole", "core"])

    return rows.mapInArrow(run, f"gram long, hull long, id {id_type}, th long, pos long, lo long, hi long, n long, "
                                "whole binary, core binary")


def _ranges(contexts: DataFrame, length: int, reach: int) -> DataFrame:
    """(id, th, start, stop) covered by repeats among crowded contexts, without holding a crowd in a task."""
    spans = contexts.limit(0).select("id", "th", F.col("pos").alias("start"), F.col("pos").alias("stop"))
    if contexts.isEmpty():
        return spans
    state = contexts.select("gram", "hull", F.lit(0).cast("long").alias("lo"), F.lit(reach).cast("long").alias("hi"), "n")
    step = reach + 1
    while step > 1:
        step = -(-step // 8)
        cells = materialize(_cells(contexts, state, length, step), "cells")
        alike = (cells.where("whole IS NOT NULL").groupBy("gram", "lo", "whole")
                 .agg(F.sum("n").alias("times"), F.min("hull").alias("rep")).where("times > 1"))
        told = materialize(cells.join(alike, ["gram", "lo", "whole"], "left"), "cells_told")
        spans = spans.union(told.where("times > 1 AND n = 1").select(
            "id", "th", F.greatest(F.col("pos") - F.col("hi"), F.lit(0)).alias("start"), (F.col("pos") - F.col("lo") + length).alias("stop")))
        # Those not covered go on, with one of each covered class as their partner.
        on = told.where("times IS NULL OR hull = rep").select(
            "gram", "hull", "lo", "hi", "core", F.coalesce("times", "n").alias("n"), F.col("times").isNull().alias("open"))
        cores = on.groupBy("gram", "lo", "core").agg(F.sum("n").alias("all"), F.max("open").alias("any_open")).where("all > 1 AND any_open")
        state = materialize(on.join(cores, ["gram", "lo", "core"], "left_semi").select("gram", "hull", "lo", "hi", "n"), "cell_state")
        if state.isEmpty():
            break
    return spans


def _with_context(wanted: DataFrame, texts: DataFrame, length: int, gram: int, beyond: int = 0) -> DataFrame:
    """``wanted`` plus the bytes ``before`` (outwards) and ``after`` each anchor."""
    per_doc = wanted.groupBy("id", "th").agg(F.collect_list(F.struct("pos", "gram", "hull", "n", "crowd")).alias("spots"))
    same = texts["id"].eqNullSafe(per_doc["id"]) & (texts["th"] == per_doc["th"])
    rows = texts.join(per_doc, same).select(texts["id"], texts["th"], "text", "spots")
    id_type = wanted.schema["id"].dataType.simpleString()
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                some = batch.slice(at, 1)
                data = some.column(2).cast(pa.binary())[0].as_py()
                spots = some.column(3).flatten()
                pos = spots.field("pos").to_pylist()
                for a in range(0, len(pos), 4096):
                    part, own = pos[a:a + 4096], spots.slice(a, 4096)
                    zero = pa.array([0] * len(part), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0).take(zero), some.column(1).take(zero), *[own.field(c) for c in ("pos", "gram", "hull", "n", "crowd")],
                         pa.array([data[max(p - reach, 0):p][::-1] for p in part], pa.binary()),
                         pa.array([data[p:p + length + beyond] for p in part], pa.binary())],
                        names=["id", "th", "pos", "gram", "hull", "n", "crowd", "before", "after"])

    return rows.mapInArrow(run, f"id {id_type}, th long, pos long, gram long, hull long, n long, crowd long, "
                                "before binary, after binary")


def _contexts(texts: DataFrame, length: int, gram: int, beyond: int = 0) -> tuple[DataFrame, DataFrame]:
    """The anchors, and the different contexts of those grams that occur more than once, with one
    anchor that stands for each, its number (``n``) and the number of the gram's contexts (``crowd``)."""
    if gram & (gram - 1) or not 1 <= gram <= length:
        raise ValueError("gram must be a power of two, at most length")
    long = texts.where(F.octet_length("text") >= length)
    anchors = materialize(find_anchors(long, length, gram, beyond), "anchors")
    contexts = anchors.groupBy("gram", "hull").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("th", "pos", "id")).alias("one"))
    grams = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("crowd"), F.sum("n").alias("all"))
    return anchors, materialize(contexts.join(grams.where(F.col("all") > 1), "gram"), "contexts")


def covered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
            crowd: int = 256) -> DataFrame:
    """(id, th, start, stop): byte ranges whose union is what repeated strings of ``length`` bytes cover;
    ``th`` is xxhash64 of the text."""
    texts = docs.select(*_key(id_col, text_col))
    anchors, known = _contexts(texts, length, gram)
    whole = anchors.join(known.where("n > 1").select("gram", "hull"), ["gram", "hull"]).select(
        "id", "th", F.greatest(F.col("pos") - (length - gram), F.lit(0)).alias("start"), (F.col("pos") + length).alias("stop"))
    wanted = known.where("crowd > 1").select("one.*", "gram", "hull", "n", "crowd")
    full = materialize(_with_context(wanted, texts, length, gram), "anchor_contexts")

    in_tree = _tree(full.where(F.col("crowd") <= crowd), length)
    in_ranges = _ranges(full.where(F.col("crowd") > crowd).dropDuplicates(["gram", "hull"]), length, length - gram)
    return whole.union(in_tree).union(in_ranges)


_MEMBER = "gram long, hull long, repeat long, before int, right int, n_occurrences long"


def _tree_groups(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The members of every maximal repeat among the contexts of each gram. A string that holds this
    anchor as a neighbour's, not as its own, is left to its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _by_gram(batches):
            counts, out = [r[4] for r in own], []
            for before, right, members in maximal_repeats([(r[1], r[2]) for r in own], length, counts):
                one = own[members[0]]
                string = one[2][:length - right][::-1] + one[1][:right]
                if anchors_of(string, length, gram)[0][0] == length - right:
                    name, n = xxhash.xxh3_64_intdigest(string), sum(counts[i] for i in members)
                    out += [(own[i][0], own[i][3], name, before, right, n) for i in members]
            if out:
                yield _members(out)

    return _dealt(contexts).mapInArrow(run, _MEMBER)


def _members(rows: list[tuple]) -> pa.RecordBatch:
    gram, hull, name, *rest = zip(*rows, strict=True)
    types = [pa.int32(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(gram), pa.array(hull), pa.array(np.array(name, np.uint64).view(np.int64)),
         *[pa.array(c, t) for c, t in zip(rest, types, strict=True)]],
        names=["gram", "hull", "repeat", "before", "right", "n_occurrences"])


def _crowd_groups(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The same for crowded grams: every string of ``length`` bytes around a context is a row, and
    Spark counts equal ones, so no crowd is held in a task."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = (batch.column(c).to_pylist() for c in ("before", "after"))
            for row, (before, after) in enumerate(zip(*cols, strict=True)):
                data, left = before[::-1] + after, len(before)
                starts = np.flatnonzero(anchor_of_each(np.frombuffer(data, np.uint8), length, gram)[0] == left)
                rights = (starts + length - left).tolist()
                names = [xxhash.xxh3_64_intdigest(data[left + r - length:left + r]) for r in rights]
                same = pa.array([row] * len(rights), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(same) for c in ("gram", "hull", "n")], pa.array(np.array(names, np.uint64).view(np.int64)),
                     pa.array(rights, pa.int32()), pa.array([after[r] if r < len(after) else -1 for r in rights], pa.int32()),
                     pa.array([before[length - r:] for r in rights], pa.binary())],
                    names=["gram", "hull", "n", "repeat", "right", "following", "further"])

    rows = contexts.select("gram", "hull", "n", "before", "after").mapInArrow(
        strings, "gram long, hull long, n long, repeat long, right int, following int, further binary")
    # The common beginning of the least and the greatest is common to all.
    alike = (rows.groupBy("gram", "repeat", "right").agg(
        F.sum("n").alias("n_occurrences"), F.min("following").alias("least"), F.max("following").alias("most"),
        F.min("further").alias("first"), F.max("further").alias("last"))
        .where("n_occurrences > 1 AND (least < most OR least = -1)"))

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = (batch.column(c).to_pylist() for c in ("first", "last", "right"))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("gram", "repeat", "right", "n_occurrences")],
                 pa.array([length - r + common(a, b) for a, b, r in zip(*ends, strict=True)], pa.int32())],
                names=["gram", "repeat", "right", "n_occurrences", "before"])

    groups = alike.mapInArrow(extended, "gram long, repeat long, right int, n_occurrences long, before int")
    return (rows.select("gram", "hull", "repeat", "right").join(groups, ["gram", "repeat", "right"])
            .select("gram", "hull", "repeat", "before", "right", "n_occurrences"))


def repeat_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                  crowd: int = 256) -> DataFrame:
    """(repeat, n_bytes, n_occurrences, id, th, start): a row for every occurrence of every maximal repeat
    of ``length`` bytes and more (see Groups above). ``repeat`` is the same number for all occurrences of
    a repeat, the hash of its last ``length`` bytes; ``th`` is xxhash64 of the text."""
    texts = docs.select(*_key(id_col, text_col))
    anchors, known = _contexts(texts, length, gram, beyond=1)
    full = materialize(_with_context(known.select("one.*", "gram", "hull", "n", "crowd"), texts, length, gram, beyond=1), "group_contexts")
    members = (_tree_groups(full.where(F.col("crowd") <= crowd), length, gram)
               .union(_crowd_groups(full.where(F.col("crowd") > crowd).dropDuplicates(["gram", "hull"]), length, gram)))
    return anchors.join(members, ["gram", "hull"]).select(
        "repeat", (F.col("before") + F.col("right")).cast("long").alias("n_bytes"), "n_occurrences", "id", "th",
        (F.col("pos") - F.col("before")).alias("start"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   crowd: int = 256, with_kept: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) for each document, and ``kept`` (its remaining bytes) if asked for."""
    spans = materialize(covered(docs, id_col, text_col, length, gram, crowd), "repeat_spans")
    per_doc = spans.groupBy("id", "th").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    texts = docs.select(*_key(id_col, text_col))
    same = texts["id"].eqNullSafe(per_doc["id"]) & (texts["th"] == per_doc["th"])
    rows = texts.join(per_doc, same, "left").select(texts["id"], "text", "spans")
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                out = []
                for data, spots in zip(some.column(1).cast(pa.binary()).to_pylist(), some.column(2), strict=True):
                    runs = merged(np.array(spots.values.field("start")), np.array(spots.values.field("stop")), len(data)) if spots.is_valid else []
                    sha, kept, done = hashlib.sha256(), [], 0
                    for a, b in [*runs, (len(data), len(data))]:
                        sha.update(data[done:a])
                        kept.append(data[done:a])
                        done = b
                    out.append((len(data), sum(b - a for a, b in runs), len(runs), sha.hexdigest(), b"".join(kept)))
                cols = list(zip(*out, strict=True)) or [()] * 5
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][:5 if with_kept else 4]
                yield pa.RecordBatch.from_arrays([some.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=False)]],
                                                 names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:6 if with_kept else 5])

    return rows.mapInArrow(run, f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept)


def merged(start: np.ndarray, stop: np.ndarray, end: int) -> list[tuple[int, int]]:
    """Maximal runs of the union, cut at ``end``."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(np.minimum(stop[order], end))
    cut = np.flatnonzero(start[1:] > reach[:-1])
    return list(zip(start[np.concatenate([[0], cut + 1])].tolist(), reach[np.concatenate([cut, [len(reach) - 1]])].tolist(), strict=True))
