"""Phrase collocation mining on sorted count streams.

A text is cut into pieces and words. A phrase is 2 to ``longest`` words of one
piece. Its score is the least, over its cuts in two parts, of how much oftener
it occurs than its parts' counts let expect. Everything is per language.

External stream layout. No table of counts is ever probed by hash:

1. *Blocks.* Each task turns its texts into blocks of about ``block_tokens``
   tokens of one language: the block's distinct words with their counts, and
   the tokens as numbers in the block.
2. *Words.* Word counts are summed. Words of ``min_count`` and more get dense
   numbers in the order (language, word); all others break a phrase, as no
   phrase that holds one is frequent. Each block gets the numbers of its own words: words
   travel in packed rows, one a block and bucket of a hash, to the packed words of that language and bucket.
   A bitmap, the same size for any corpus, keeps most of a block's other words at home.
3. *Pairs.* A block sums its equal pairs of neighbours. The pairs are laid in
   prefix order (range partitions, sorted), and one scan counts them. A run that
   touches an end of a part is summed with its other parts.
4. *Windows.* At every word a window of up to ``longest`` numbers begins; it ends
   before a pair that is not frequent, as no frequent phrase holds one. A block
   sums equal windows of three words and more, and they are laid in prefix order,
   too: there all windows that begin with a phrase follow one another, so one
   scan gives the counts of phrases of every length. Which pairs are frequent is
   told by a bitmap of ``PAIR_BITS`` bits, the same size for any corpus; a pair that it
   takes for frequent only makes windows longer, and never changes a count.
5. *Lockstep.* The frequent phrases are kept twice: in prefix order and in
   suffix order (by their words from last to first). Their prefixes (suffixes)
   are frequent as well and stand before them, so a scan that keeps the last phrase
   of each length meets every phrase together with the counts of all its left
   (right) parts, and every phrase with its extensions by one word. The two
   scans are merged on the phrase.

A hot word, or a hot window, is one row a block, and a run of a hot first word
may span any number of parts.

Defined cases: a null text is empty; a null language is ``und``; repeated rows
count as often as they come; an empty table gives no phrases; extra columns
are ignored. Sums are 64-bit integers, scores 38-digit decimals.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starpipe.llm.common import arrow_rows
from starpipe.llm.lm_interpolation import _grow, _mix, _shrink
from starpipe.operators.keys import add_key, range_layout
from starpipe.sources.io import materialize

#: A-Z in lower case; characters that end a piece become a line feed, a tab a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
#: Ways a language's candidates are split for the first choice of the best.
SPREAD = 256
#: Bits of the bitmap of frequent pairs (16 MB), a power of two, 32,768 at least.
PAIR_BITS = 1 << 27
#: Bits of the bitmap of frequent words, as for pairs.
WORD_BITS = 1 << 27
#: Frequent words for which a further bucket is made (to the next power of two).
BUCKET_WORDS = 1 << 16
#: Windows, or tokens, of a block for which a task makes work arrays at once; a first word with more windows is taken whole.
AT_ONCE = 1 << 18
#: Texts that a task hands to Python at a time.
TEXT_ROWS = 500
#: The same of packed rows, each of which carries up to a whole bucket of frequent words.
PACKED_ROWS = 4


def _tokens(text: bytes) -> list[bytes]:
    """Words, with the byte 0xFF (which no UTF-8 text holds) where a piece ends."""
    return text.translate(_FOLD).replace(b"\n", b" \xff ").split(b" ")


def make_blocks(docs: DataFrame, lang_col: str, text_col: str, block_tokens: int) -> DataFrame:
    """(block, lang, words, counts, total, tokens): blocks of texts of one language."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    schema = "block long, lang string, words array<string>, counts array<long>, total long, tokens binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial, held = TaskContext.get().partitionId(), 0, 0
        open_: dict[str, tuple[dict[bytes, int], list[np.ndarray]]] = {}
        size: dict[str, int] = {}

        def close(lang: str) -> pa.RecordBatch:
            nonlocal serial, held
            numbers, parts = open_.pop(lang)
            held -= size.pop(lang)
            tokens = np.concatenate(parts)
            counts = np.bincount(tokens, minlength=len(numbers))
            words = list(numbers)
            # 0 stays the break; the others are numbered by falling count, which packs well.
            order = np.concatenate([[0], 1 + np.argsort(-counts[1:], kind="stable")])
            rank = np.empty(len(order), "<u4")
            rank[order] = np.arange(len(order))
            serial += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + serial], pa.int64()), pa.array([lang]),
                 pa.array([[words[i].decode() for i in order[1:]]], pa.list_(pa.string())),
                 pa.array([counts[order[1:]]], pa.list_(pa.int64())), pa.array([int(counts[1:].sum())], pa.int64()),
                 pa.array([_shrink(rank[tokens])], pa.binary())],
                names=["block", "lang", "words", "counts", "total", "tokens"])

        for batch in batches:
            langs, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for i in range(batch.num_rows):
                text, lang = texts[i].as_py(), langs[i].as_py()
                if not text:
                    continue
                if lang not in open_:
                    open_[lang], size[lang] = ({b"\xff": 0}, []), 0
                numbers, parts = open_[lang]
                own = [numbers.setdefault(w, len(numbers)) for w in _tokens(text) if w]
                own.append(0)
                parts.append(np.array(own, "<u4"))
                size[lang] += len(own)
                held += len(own)
                if size[lang] >= block_tokens:
                    yield close(lang)
                elif held >= 2 * block_tokens:
                    yield close(max(size, key=size.get))
        for lang in list(open_):
            yield close(lang)

    return rows.mapInArrow(run, schema)


def _named(longest: int) -> list[str]:
    return [f"w{i}" for i in range(1, longest + 1)]


def _record(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(v)) for v in columns.values()], names=list(columns))


def _pair_place(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """A pair's bit in a bitmap of ``bits`` bits."""
    mixed = _mix(_mix(first.astype(np.uint64), second.astype(np.uint64)), np.uint64(0))
    return (mixed & np.uint64(bits - 1)).astype(np.int64)


def pair_bitmap(pairs: DataFrame, bits: int = PAIR_BITS) -> np.ndarray:
    """The bitmap of ``pairs(w1, w2)`` as bytes; at most ``bits`` bits reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _record({"bit": _pair_place(batch.column("w1").to_numpy(), batch.column("w2").to_numpy(), bits) + 1})

    return _bitmap(pairs.select("w1", "w2").mapInArrow(run, "bit long"), bits)


def _bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of ``places(bit)``, which count from 1, as bytes."""
    pieces = (places.groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("piece")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in pieces:      # buckets count from 1; each is 4,096 bytes
        out[(r["bucket"] - 1) * 4096:r["bucket"] * 4096] = np.frombuffer(r["piece"], np.uint8)
    return out


def own_numbers(blocks: DataFrame, words: DataFrame, buckets: int | None = None, bits: int = WORD_BITS) -> DataFrame:
    """(block, own): for each block, the places and numbers of those of its words that ``words(lang, word, id)`` has."""
    if buckets is None:
        buckets = 1 << (words.count() // BUCKET_WORDS).bit_length()
    crc = F.crc32(F.concat(F.col("lang"), F.lit("\0"), F.col("word")).cast("binary"))
    bitmap = words.sparkSession.sparkContext.broadcast(_bitmap(words.select((crc % bits + 1).alias("bit")), bits))
    packed = (words.groupBy("lang", (crc % buckets).cast("int").alias("bucket"))
              .agg(F.collect_list(F.struct("word", "id")).alias("x")).select("lang", "bucket", "x.word", "x.id"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lang, own = batch.column("lang")[i].as_py(), batch.column("words")[i].values
                before = zlib.crc32(lang.encode() + b"\0")
                mixed = np.array([zlib.crc32(w, before) for w in own.cast(pa.binary()).to_pylist()], np.int64)
                bit = mixed % bits
                at = np.flatnonzero((bitmap.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                at = at[np.argsort(mixed[at] % buckets, kind="stable")]
                some, first = np.unique(mixed[at] % buckets, return_index=True)
                cuts = pa.array([*first.tolist(), len(at)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("block")[i].as_py()] * len(some), pa.int64()), pa.array([lang] * len(some), pa.string()),
                     pa.array(some, pa.int32()), pa.ListArray.from_arrays(cuts, pa.array(at, pa.int64())),
                     pa.ListArray.from_arrays(cuts, own.take(pa.array(at)).cast(pa.string()))],
                    names=["block", "lang", "bucket", "at", "words"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at, own, word, ids = (batch.column(c)[i].values for c in ("at", "words", "word", "id"))
                place = pc.index_in(own, value_set=word)
                met = place.is_valid()
                pairs = pa.StructArray.from_arrays([at.filter(met), ids.take(place.drop_null())], names=["at", "id"])
                if len(pairs):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("block").slice(i, 1), pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pairs)],
                        names=["block", "own"])

    sent = blocks.select("block", "lang", "words").mapInArrow(split, "block long, lang string, bucket int, at array<long>, words array<string>")
    # Never a broadcast: both Python steps would run in one task, with two workers for each core, which stay and keep their memory.
    return (sent.join(packed.hint("merge"), ["lang", "bucket"]).select("block", "at", "words", "word", "id")
            .mapInArrow(match, "block long, own array<struct<at: long, id: long>>")
            .groupBy("block").agg(F.flatten(F.collect_list("own")).alias("own")))


def windows(numbered: DataFrame, longest: int, shortest: int = 2, bitmap: np.ndarray | None = None) -> DataFrame:
    """(w1.., n): each block's different windows of ``shortest`` words and more, in prefix order,
    with their count. A window ends before a pair that is not in the ``bitmap``."""
    names = _named(longest)
    held = None if bitmap is None else numbered.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = _grow(batch.column("tokens")[i].as_py(), "<u4")
                own = batch.column("own")[i].values
                at, ids = own.field("at").to_numpy(), own.field("id").to_numpy()
                order = np.argsort(ids)
                place = np.zeros(max(int(tokens.max()), int(at.max()) + 1) + 1, np.int32)
                place[at[order] + 1] = np.arange(1, len(order) + 1)      # numbers in the block, in the order of ids
                ids = np.concatenate([[0], ids[order]])
                seq = np.zeros(len(tokens) + longest, np.int32)
                for a in range(0, len(tokens), AT_ONCE):
                    seq[a:a + AT_ONCE][:len(tokens) - a] = place[tokens[a:a + AT_ONCE]]
                link = (seq[:-1] > 0) & (seq[1:] > 0)
                for a in range(0, len(link) if held is not None else 0, AT_ONCE):
                    joint = a + np.flatnonzero(link[a:a + AT_ONCE])
                    bit = _pair_place(ids[seq[joint]], ids[seq[joint + 1]], 8 * len(held.value))
                    link[joint] = (held.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
                begins = link.copy()
                for k in range(1, shortest - 1):
                    begins[:-k] &= link[k:]
                firsts = np.where(begins, seq[:-1], 0)
                size = sum(np.bincount(firsts[a:a + AT_ONCE], minlength=len(ids)) for a in range(0, len(firsts), AT_ONCE))
                size[0] = 0
                ends, word = np.cumsum(size), 1
                while word < len(ids):
                    # The windows of some first words at a time; equal windows have the same first word.
                    beyond = max(word + 1, int(np.searchsorted(ends, ends[word - 1] + AT_ONCE, "right")))
                    begin = np.flatnonzero((firsts >= word) & (firsts < beyond))
                    word = beyond
                    if not len(begin):
                        continue
                    cols = np.empty((longest, len(begin)), np.int32)
                    going, code = np.ones(len(begin), bool), np.zeros(len(begin), np.int64)
                    for k in range(longest):
                        if k:
                            going &= link[begin + k - 1]
                        cols[k] = np.where(going, seq[begin + k], 0)
                        # Equal codes are equal windows so far, and codes keep their order.
                        values, first, code, n = np.unique(code * len(ids) + cols[k], return_index=True, return_inverse=True,
                                                           return_counts=True)
                    for a in range(0, len(first), 1 << 16):
                        part = first[a:a + (1 << 16)]
                        yield _record({**{w: ids[cols[k][part]] for k, w in enumerate(names)}, "n": n[a:a + (1 << 16)].astype(np.int64)})

    return numbered.mapInArrow(run, ", ".join(f"{w} long" for w in [*names, "n"]))


def _prefix_counts(ordered: DataFrame, longest: int, min_count: int, shortest: int = 2) -> DataFrame:
    """(w1.., a): counts of phrases of ``shortest`` words and more, from windows in prefix order. What
    touches an end of a partition comes with any count, all else with ``min_count`` and more."""
    names = _named(longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, list] = {}      # length -> [phrase, count, touches the start]

        def rows(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            phrases = np.concatenate([p for p, _ in found], axis=0)
            return _record({**{w: phrases[:, k] for k, w in enumerate(names)}, "a": np.concatenate([c for _, c in found])})

        def closed(k: int) -> list[tuple[np.ndarray, np.ndarray]]:
            phrase, count, at_start = open_.pop(k)
            return [(phrase[None], np.array([count], np.int64))] if at_start or count >= min_count else []

        first_ever = True
        for batch in batches:
            if not batch.num_rows:
                continue
            w = np.stack([batch.column(c).to_numpy() for c in names], axis=1)
            n, found = batch.column("n").to_numpy(), []
            for k in range(shortest, longest + 1):
                on = w[:, k - 1] > 0
                new = np.concatenate([[True], (w[1:, :k] != w[:-1, :k]).any(axis=1)])
                starts = np.flatnonzero(new)
                counts = np.add.reduceat(n, starts)
                live = on[starts]
                phrases = np.where(np.arange(longest) < k, w[starts], 0)
                if k in open_ and live[0] and (open_[k][0] == phrases[0]).all():
                    open_[k][1] += int(counts[0])
                    joined = True
                else:
                    if k in open_:
                        found += closed(k)
                    if live[0]:
                        open_[k] = [phrases[0], int(counts[0]), first_ever]
                    joined = False
                if len(starts) > 1:
                    if k in open_:
                        found += closed(k)
                    inner = np.flatnonzero(live[1:-1] & (counts[1:-1] >= min_count)) + 1
                    if len(inner):
                        found.append((phrases[inner], counts[inner]))
                    if live[-1]:
                        open_[k] = [phrases[-1], int(counts[-1]), False]
                elif not joined and not live[0]:
                    open_.pop(k, None)
            first_ever = False
            if found:
                yield rows(found)
        last = [(p[None], np.array([c], np.int64)) for p, c, _ in open_.values()]
        if last:
            yield rows(last)

    return ordered.mapInArrow(run, ", ".join(f"{w} long" for w in [*names, "a"]))


def frequent_phrases(blocks: DataFrame, words: DataFrame, longest: int, min_count: int) -> DataFrame:
    """(w1.., a): the count of every phrase of 1 to ``longest`` words with ``min_count`` and more."""
    names = _named(longest)
    own = own_numbers(blocks, words)
    with arrow_rows(blocks.sparkSession, PACKED_ROWS):
        numbered = materialize(blocks.select("block", "tokens").join(own, "block").select("tokens", "own"), "numbered")

    def counted(stream: DataFrame, shortest: int, size: int) -> DataFrame:
        keys = names[:size]
        ordered = stream.repartitionByRange(*keys).sortWithinPartitions(*keys)
        return (_prefix_counts(ordered, size, min_count, shortest).groupBy(*keys).agg(F.sum("a").alias("a"))
                .where(F.col("a") >= min_count)
                .select(*keys, *[F.lit(0).cast("long").alias(w) for w in names[size:]], "a"))

    pairs = materialize(counted(windows(numbered, 2), 2, 2), "pairs")
    single = words.select(F.col("id").alias("w1"), *[F.lit(0).cast("long").alias(w) for w in names[1:]], F.col("n").alias("a"))
    found = pairs.unionByName(single)
    if longest > 2:
        found = found.unionByName(counted(windows(numbered, longest, 3, pair_bitmap(pairs)), 3, longest))
    return materialize(found, "phrases")


def _lockstep(phrases: DataFrame, longest: int, reverse: bool) -> DataFrame:
    """Scan the phrases in prefix order (``reverse``: in suffix order). (w1.., a, c1.., ext):
    ``c<k>`` is the count of the first (last) k words of a longer phrase, ``ext`` the greatest
    count of a phrase one word longer at the other end. A phrase with ext can come in several
    rows, all but one without a and c."""
    names, size = _named(longest), sum((F.col(w) > 0).cast("int") for w in _named(longest))
    u = [f"u{i}" for i in range(1, longest + 1)]
    backwards = F.reverse(F.filter(F.array(*names), lambda x: x > 0))
    key = [F.coalesce(F.get(backwards, F.lit(i)), F.lit(0)).alias(c) if reverse else F.col(names[i]).alias(c) for i, c in enumerate(u)]
    laid = range_layout(phrases.select(*key, "a"), u, unique=True)

    # The first phrase of a part has its prefixes in earlier parts: at most longest - 1 counts a part.
    first = laid.groupBy("_part").agg(F.min_by(F.struct(*u), "_row").alias("f")).select("_part", "f.*")
    size = sum((F.col(c) > 0).cast("int") for c in u)
    cut = [first.select("_part", F.lit(k).alias("k"), size.alias("size"),
                        *[F.col(c) if i < k else F.lit(0).cast("long").alias(c) for i, c in enumerate(u)]).where(F.col("size") > k)
           for k in range(1, longest)]
    wanted = cut[0]
    for c in cut[1:]:
        wanted = wanted.unionByName(c)
    before: dict[int, dict[int, int]] = {}
    for r in wanted.join(laid.select(*u, "a"), u).select("_part", "k", "a").collect():
        before.setdefault(r["_part"], {})[r["k"]] = r["a"]

    counts = [f"c{k}" for k in range(1, longest)]
    out = [*u, "a", *counts, "ext"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = None, {}        # last[k]: (count, phrase) of the last phrase of length k
        for batch in batches:
            parts = batch.column("_part").to_numpy()
            edges = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if hi == lo:
                    continue
                if parts[lo] != part:
                    part = parts[lo]
                    last = {k: (a, None) for k, a in before.get(int(part), {}).items()}
                rows = batch.slice(lo, hi - lo)
                key = np.stack([rows.column(c).to_numpy() for c in u], axis=1)
                a = rows.column("a").to_numpy()
                length = (key > 0).sum(axis=1)
                ext = np.zeros(len(a), np.int64)
                cols, carried = {}, []
                for k in range(1, longest):
                    seen = np.maximum.accumulate(np.where(length == k, np.arange(len(a)), -1))
                    of = np.where(seen >= 0, a[seen], last.get(k, (0, None))[0])
                    cols[f"c{k}"] = np.where(length > k, of, 0)
                    child = length == k + 1
                    np.maximum.at(ext, seen[child & (seen >= 0)], a[child & (seen >= 0)])
                    outside = child & (seen < 0)
                    if outside.any():
                        carried.append((np.where(np.arange(longest) < k, key[np.flatnonzero(outside)[0]], 0), int(a[outside].max())))
                for k in range(1, longest):
                    own = np.flatnonzero(length == k)
                    if len(own):
                        last[k] = (int(a[own[-1]]), None)
                yield _record({**{c: key[:, i] for i, c in enumerate(u)}, "a": a, **cols, "ext": ext})
                if carried:
                    none = np.zeros(len(carried), np.int64)
                    keys = np.stack([p for p, _ in carried])
                    yield _record({**{c: keys[:, i] for i, c in enumerate(u)}, "a": none, **{c: none for c in counts},
                                   "ext": np.array([e for _, e in carried], np.int64)})

    scanned = (laid.repartition("_part").sortWithinPartitions("_part", "_row").select("_part", *u, "a")
               .mapInArrow(run, ", ".join(f"{c} long" for c in out)))
    forwards = F.reverse(F.filter(F.array(*u), lambda x: x > 0))
    words = [F.coalesce(F.get(forwards, F.lit(i)), F.lit(0)).alias(w) if reverse else F.col(u[i]).alias(w) for i, w in enumerate(names)]
    return scanned.select(*words, "a", *counts, "ext")


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exact."""
    wide = [c.cast("decimal(38,0)") for c in (a, n, left, right)]
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide[0] * wide[1], wide[2] * wide[3])


def candidates(phrases: DataFrame, longest: int, keep_percent: int = 100) -> DataFrame:
    """(w1.., size, a, lefts, rights) for phrases of two words and more that no longer candidate
    covers; ``lefts[k - 1]`` and ``rights[k - 1]`` are the counts of the first and last k words."""
    names, counts = _named(longest), [f"c{k}" for k in range(1, longest)]
    fill = F.lit(0).cast("long")
    left = _lockstep(phrases, longest, False).select(*names, "a", "ext", *[F.col(c).alias(f"l{c}") for c in counts],
                                                    *[fill.alias(f"r{c}") for c in counts])
    right = _lockstep(phrases, longest, True).select(*names, "a", "ext", *[fill.alias(f"l{c}") for c in counts],
                                                     *[F.col(c).alias(f"r{c}") for c in counts])
    met = left.unionByName(right).groupBy(*names).agg(
        F.max("a").alias("a"), F.max("ext").alias("ext"), *[F.max(f"{s}{c}").alias(f"{s}{c}") for s in "lr" for c in counts])
    # The count of a longer phrase is at most that of one that is longer by one word: that one decides.
    return (met.where((F.col("w2") > 0) & ((F.col("ext") == 0) | (100 * F.col("ext") < keep_percent * F.col("a"))))
            .select(*names, sum((F.col(w) > 0).cast("int") for w in names).alias("size"), "a",
                    F.array(*[f"l{c}" for c in counts]).alias("lefts"), F.array(*[f"r{c}" for c in counts]).alias("rights")))


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = 5, min_count: int = 100,
         keep_percent: int = 100, top: int = 2000, block_tokens: int = 1_500_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best ``top`` phrases. A candidate goes
    when a longer one that holds it has ``keep_percent`` of its count or more."""
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    names = _named(longest)
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        blocks = materialize(make_blocks(docs, lang_col, text_col, block_tokens), "phrase_blocks")
    sums = (blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
            .groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("n")).where(F.col("n") >= min_count))
    words = materialize(add_key(materialize(sums, "frequent_words"), "id", ["lang", "word"], unique=True), "words")
    totals = blocks.groupBy("lang").agg(F.sum("total").alias("total"))

    rows = (candidates(frequent_phrases(blocks, words, longest, min_count), longest, keep_percent)
            .join(words.select(F.col("id").alias("w1"), "lang"), "w1").join(totals, "lang"))
    cuts = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        score(F.col("a"), F.col("total"), F.get("lefts", k - 1), F.get("rights", F.col("size") - k - 1)).alias("score"),
        k.alias("k"), F.get("lefts", k - 1).alias("l"), F.get("rights", F.col("size") - k - 1).alias("r")))
    scored = materialize(rows.withColumn("cut", F.array_min(cuts)).select(
        "lang", *names, "size", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score"), "scored")

    best = [F.col("score").desc(), F.col("a").desc()]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64(*names), F.lit(SPREAD)))
    some = salted.withColumn("at", F.rank().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("at") <= top)
    few = some.withColumn("at", F.rank().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("at") <= top).drop("salt", "at")
    few = materialize(few.withColumn("key", F.monotonically_increasing_id()), "best")
    text = (few.select("key", F.posexplode(F.array(*names)).alias("at", "id")).where("id > 0")
            .join(words.select("id", "word"), "id").groupBy("key")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*best, F.col("phrase").asc()))
    return (few.join(text, "key").withColumn("rank", place.cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
