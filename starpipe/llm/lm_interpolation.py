"""Language-model scoring by deleted interpolation.

An n-gram's maximum-likelihood estimates of all orders, and a uniform share for
unknown words, are mixed with weights that depend on how often the context
was seen (buckets of powers of two). The weights are learned by
expectation-maximisation on held-out counts: a tenth of the training documents
is held out, the others give the counts for it. The final estimates use all
training documents.

How it runs. Each task turns its documents into blocks of about
``block_tokens`` tokens: the block's distinct words by hash, and each token as a
frequency rank in the block. A block asks for the counts of its distinct
n-grams: sorted hashes, dealt over ranges of the hash. Each range sums the
training blocks' counts and answers every block that asked. So a frequent
n-gram costs a few bytes a block, wherever it occurs, and no key is hot. The
answers meet their block, which scores its documents. Held-out tokens reach
the driver only as a histogram whose size is bounded by the cells of the
estimates, and EM runs on that.

Words and n-grams are compared by 64-bit hash.

Defined cases: a null or blank text is the end token alone; a null id counts as
empty text in the folds; without training documents all counts are 0 and
every word is unknown; repeated rows are counted and scored as often as they
come; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starpipe.sources.io import materialize

KEPT, DELETED, TEST = 0, 1, 2
END, START = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
BUCKETS = 24
#: Steps of an estimate's binary logarithm in the held-out histogram.
STEPS = 4


def _shrink(a: np.ndarray) -> bytes:
    """An integer array as compressed byte planes."""
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.compress(raw.tobytes(), 1)


def _grow(blob: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob, 1 << 31), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def _steps(a: np.ndarray) -> bytes:
    """A sorted hash array as compressed differences."""
    return _shrink(np.diff(a, prepend=a.dtype.type(0)))


def _unsteps(blob: bytes) -> np.ndarray:
    return np.cumsum(_grow(blob, "<u8"), dtype="<u8")


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ np.uint64(0x27D4EB2F165667C5)) * np.uint64(0x9FB21C651E98DF25) + b * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _grams(hashes: np.ndarray, starts: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order the hash of the n-gram that ends at each token."""
    out = [hashes]
    for _ in range(1, order):
        before = np.empty_like(hashes)
        before[1:] = out[-1][:-1]
        before[starts] = START
        out.append(_mix(before, hashes))
    return out


def make_blocks(docs: DataFrame, role: Column, id_col: str, text_col: str, block_tokens: int) -> DataFrame:
    """(block, role, ids, lens, words, tokens): blocks of documents of one role."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), role.cast("int").alias("role"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        hash_of = xxhash.xxh64_intdigest
        open_: dict[int, list] = {}
        id_arrow = None

        def close(role: int) -> pa.RecordBatch:
            nonlocal serial
            ids, hashes, _ = open_.pop(role)
            lens = np.array([len(h) for h in hashes], np.int64)
            words, at, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            by_rank = rank[at].astype("<u4")
            serial += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + serial], pa.int64()), pa.array([role], pa.int32()),
                 pa.array([ids], pa.list_(id_arrow)), pa.array([lens.tolist()], pa.list_(pa.int64())),
                 pa.array([_steps(words) + b""], pa.binary()), pa.array([_shrink(order.astype("<u4"))], pa.binary()),
                 pa.array([_shrink(by_rank)], pa.binary())],
                names=["block", "role", "ids", "lens", "words", "ranks", "tokens"])

        for batch in batches:
            id_arrow = batch.column(0).type
            texts = batch.column(1).cast(pa.binary())
            for i, (page, role) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                words = (texts[i].as_py() or b"").lower().split()
                own = np.empty(len(words) + 1, "<u8")
                own[:-1] = [hash_of(w) for w in words]
                own[-1] = END
                now = open_.setdefault(role, [[], [], 0])
                now[0].append(page)
                now[1].append(own)
                now[2] += len(own)
                if now[2] >= block_tokens:
                    yield close(role)
        for role in list(open_):
            yield close(role)

    return rows.mapInArrow(run, f"block long, role int, ids array<{id_type}>, lens array<long>, words binary, "
                                "ranks binary, tokens binary")


def _opened(words: bytes, ranks: bytes, tokens: bytes, lens, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """A block's n-gram hashes by order, and its documents' first tokens."""
    by_rank = _unsteps(words)[_grow(ranks, "<u4")]
    lens = np.asarray(lens, np.int64)
    starts = np.cumsum(lens) - lens
    return _grams(by_rank[_grow(tokens, "<u4")], starts, order), starts


def _requests(blocks: DataFrame, order: int, bits: int) -> DataFrame:
    """(n, part, block, role, hashes, counts): what each block asks of each hash range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                grams, _ = _opened(r["words"], r["ranks"], r["tokens"], r["lens"], order)
                for n, hashes in enumerate(grams, 1):
                    keys, counts = np.unique(hashes, return_counts=True)
                    edges = np.searchsorted(keys, (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))) if bits else []
                    cuts = [0, *map(int, edges), len(keys)]
                    out = [(p, _steps(keys[a:b]), _shrink(counts[a:b].astype("<u4")))
                           for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
                    k = len(out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n] * k, pa.int32()), pa.array([x[0] for x in out], pa.int64()),
                         pa.array([r["block"]] * k, pa.int64()), pa.array([r["role"]] * k, pa.int32()),
                         pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary())],
                        names=["n", "part", "block", "role", "hashes", "counts"])

    return blocks.select("block", "role", "lens", "words", "ranks", "tokens").mapInArrow(
        run, "n int, part long, block long, role int, hashes binary, counts binary")


ANSWER = "block long, role int, n int, part long, seen binary, kept binary, total long, kept_total long, kinds long"


def _answers(requests: DataFrame) -> DataFrame:
    """For each request the training counts of its n-grams, in its order (``kept`` only for
    held-out blocks), in 64 bits; and a row without a block with the range's sums."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        hashes = [_unsteps(r["hashes"]) for r in rows]
        keys, at = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.concatenate([_grow(r["counts"], "<u4") if r["role"] != TEST else np.zeros(len(h), "<u4")
                                 for r, h in zip(rows, hashes, strict=True)])
        kept_only = np.concatenate([np.full(len(h), r["role"] == KEPT) for r, h in zip(rows, hashes, strict=True)])
        seen = np.bincount(at, counts, len(keys)).astype("<i8")
        kept = np.bincount(at, counts * kept_only, len(keys)).astype("<i8")
        out, a = [], 0
        for r, h in zip(rows, hashes, strict=True):
            own = at[a:a + len(h)]
            a += len(h)
            out.append({"block": r["block"], "role": r["role"], "n": r["n"], "part": r["part"], "seen": _shrink(seen[own]),
                        "kept": _shrink(kept[own]) if r["role"] == DELETED else None,
                        "total": None, "kept_total": None, "kinds": None})
        out.append({"block": None, "role": None, "n": rows[0]["n"], "part": rows[0]["part"], "seen": None, "kept": None,
                    "total": int(seen.sum(dtype=np.int64)), "kept_total": int(kept.sum(dtype=np.int64)), "kinds": int((seen > 0).sum())})
        return pa.Table.from_pylist(out, pa.schema([
            ("block", pa.int64()), ("role", pa.int32()), ("n", pa.int32()), ("part", pa.int64()), ("seen", pa.binary()),
            ("kept", pa.binary()), ("total", pa.int64()), ("kept_total", pa.int64()), ("kinds", pa.int64())]))

    return requests.groupBy("n", "part").applyInArrow(run, ANSWER)


@dataclass(frozen=True)
class Sizes:
    tokens: int        # N, all training tokens
    kinds: int         # V, distinct ones
    docs: int          # training documents
    kept_tokens: int
    kept_docs: int


def _estimates(rows: list[dict], order: int, col: str, tokens: int, docs: int):
    """A block's counts and ML estimates by order for each token, and the context's count."""
    body = next(r for r in rows if r["tokens"] is not None)
    grams, starts = _opened(body["words"], body["ranks"], body["tokens"], body["lens"], order)
    counts = []
    for n, hashes in enumerate(grams, 1):
        own = sorted((r["part"], r[col]) for r in rows if r["n"] == n)
        by_key = np.concatenate([_grow(x, "<i8") for _, x in own])
        counts.append(by_key[np.unique(hashes, return_inverse=True)[1]])
    estimates, context = [counts[0] / max(tokens, 1)], np.full(len(counts[0]), tokens)
    for n in range(1, order):
        context = np.empty(len(counts[0]), np.int64)
        context[1:] = counts[n - 1][:-1]
        context[starts] = docs
        estimates.append(np.divide(counts[n], context, out=np.zeros(len(context)), where=context > 0))
    return body, starts, counts[0], np.stack(estimates), context


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(context + 1.0).astype(np.int64), BUCKETS - 1)


def _by_block(blocks: DataFrame, answers: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over each block's rows: its body and its answers."""
    body = blocks.withColumns({c: F.lit(None).cast(t) for c, t in (("n", "int"), ("part", "long"), ("seen", "binary"), ("kept", "binary"))})
    none = {c: F.lit(None).cast(blocks.schema[c].dataType) for c in ("ids", "lens", "words", "ranks", "tokens")}
    return body.unionByName(answers.withColumns(none).select(*body.columns)).groupBy("block").applyInArrow(
        lambda table: run(table.to_pylist()), schema)


def _histogram(blocks: DataFrame, answers: DataFrame, order: int, sizes: Sizes) -> np.ndarray:
    """Held-out tokens by bucket and estimates' cells: rows of (bucket, tokens, mean estimate by order)."""
    base = 512

    def run(rows: list[dict]) -> pa.Table:
        _, _, _, f, context = _estimates(rows, order, "kept", sizes.kept_tokens, sizes.kept_docs)
        cell = _bucket(context)
        for e in f:
            step = np.where(e > 0, np.round(STEPS * np.log2(np.maximum(e, 1e-30))) + base // 2 + 200, 0).clip(0, base - 1)
            cell = cell * base + step.astype(np.int64)
        cells, at, n = np.unique(cell, return_inverse=True, return_counts=True)
        sums = [np.bincount(at, e, len(cells)) for e in f]
        return pa.table({"cell": cells, "n": n, "sums": pa.array(np.stack(sums).T.tolist(), pa.list_(pa.float64()))})

    each = _by_block(blocks, answers, run, "cell long, n long, sums array<double>")
    rows = each.groupBy("cell").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(order)]).collect()
    return np.array([[r["cell"] // base ** order, r["n"], *[r[f"s{i}"] / r["n"] for i in range(order)]] for r in rows]).reshape(-1, order + 2)


def learn_weights(histogram: np.ndarray, order: int, kinds: int, rounds: int = 60, prior: float = 50.0) -> np.ndarray:
    """EM: (buckets, order + 1) mixture weights, the uniform share first, so that the mixture sums to 1
    after every context. Each bucket starts from, and with few tokens stays near, the weights of all
    tokens together."""
    def em(f: np.ndarray, n: np.ndarray, start: np.ndarray, pull: float) -> np.ndarray:
        w = start
        for _ in range(rounds):
            share = f * w
            share /= share.sum(1, keepdims=True)
            got = (share * n[:, None]).sum(0) + pull * start
            w = got / got.sum()
        return w

    flat = np.full(order + 1, 1 / (order + 1))
    weights = np.tile(flat, (BUCKETS, 1))
    if len(histogram):
        f = np.hstack([np.full((len(histogram), 1), 1 / (kinds + 1)), histogram[:, 2:]])
        n, bucket = histogram[:, 1], histogram[:, 0].astype(int)
        everywhere = em(f, n, flat, 1.0)
        for b in range(BUCKETS):
            own = bucket == b
            weights[b] = em(f[own], n[own], everywhere, prior) if own.any() else everywhere
    # Bucket 0 is contexts never seen: they have no estimate of the highest order to give a share to.
    weights[0, -1] = 0
    weights[0] /= weights[0].sum()
    return weights


def score(docs: DataFrame, is_training: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
          block_tokens: int = 1_500_000, range_keys: int = 1_000_000) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) for each document; the model learns
    from those where ``is_training`` holds."""
    if not 1 <= order <= 3:
        raise ValueError("order must be 1, 2 or 3")
    deleted = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(17)), F.lit(10)) == 0
    role = F.when(~F.coalesce(is_training, F.lit(False)), TEST).when(deleted, DELETED).otherwise(KEPT)
    blocks = materialize(make_blocks(docs, role, id_col, text_col, block_tokens), "lm_blocks")
    shape = blocks.groupBy("role").agg(F.sum(F.size("lens")).alias("docs"), F.sum(F.aggregate(
        "lens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("tokens")).collect()
    docs_of = {r["role"]: r["docs"] for r in shape}
    ranges = max(1, -(-sum(r["tokens"] for r in shape) // range_keys))
    answers = materialize(_answers(_requests(blocks, order, (ranges - 1).bit_length())), "lm_answers")
    sums = answers.where("block IS NULL AND n = 1").agg(F.sum("total"), F.sum("kept_total"), F.sum("kinds")).first()
    sizes = Sizes(sums[0] or 0, sums[2] or 0, docs_of.get(KEPT, 0) + docs_of.get(DELETED, 0), sums[1] or 0, docs_of.get(KEPT, 0))
    own = answers.where("block IS NOT NULL").select("block", "role", "n", "part", "seen", "kept")
    held_out = F.col("role") == DELETED
    weights = learn_weights(_histogram(blocks.where(held_out), own.where(held_out), order, sizes), order, sizes.kinds)
    id_type = blocks.schema["ids"].dataType.elementType

    def run(rows: list[dict]) -> pa.Table:
        body, starts, seen, f, context = _estimates(rows, order, "seen", sizes.tokens, sizes.docs)
        w = weights[_bucket(context)]
        p = w[:, 0] / (sizes.kinds + 1) + (w[:, 1:] * f.T).sum(1)
        base = np.log10((seen + 0.5) / (sizes.tokens + 0.5 * (sizes.kinds + 1)))
        return pa.table({
            "id": pa.array(body["ids"], to_arrow_type(id_type)), "n_tokens": pa.array(body["lens"], pa.int64()),
            "n_known": np.add.reduceat((seen > 0).astype(np.int64), starts),
            "train_tokens": np.full(len(starts), sizes.tokens, np.int64),
            "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(np.log10(p), starts)})

    from pyspark.sql.pandas.types import to_arrow_type
    return _by_block(blocks, own.withColumn("kept", F.lit(None).cast("binary")), run,
                     f"id {id_type.simpleString()}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
