"""The registered queries of this subpackage: thin digests of each operator's rows."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.llm import (bbit_minhash, drr_packing, ecoc_langid, hash_tree, importance_resampling, lm_interpolation,
                          phrase_streams, prefix_decontam, quality_cascade, repeat_tree, secret_ownership, simhash_blocks, warc_chunks)
from starpipe.llm.common import doc_fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    """The tokenizer's JSON; the driver reads it, tasks get its text."""
    import public_tokenizers
    return Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = doc_fold("doc_id", 5) == 1
    rows = lm_interpolation.score(docs, ~held_out).withColumnRenamed("id", "doc_id")
    return rows.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hash_tree.with_slots(hash_tree.assign(table(spark, sf_dir, "documents"), hash_tree.layout(24)))
    return rows.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_cascade.cascade(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept")


def op4_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = doc_fold("doc_id", 4) == 2
    model = ecoc_langid.fit(docs.where(~held_out))
    rows = ecoc_langid.predict(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op5_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prefix_decontam.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                              table(spark, sf_dir, "benchmark"))
    n_hit = prefix_decontam.hit_words(F.col("hit_spans"))
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                       (n_hit > 0).alias("contaminated"))


def op6_chunked_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc_chunks.archive_path(spark)
    warc_chunks.write(table(spark, sf_dir, "pages"), path)
    rows = warc_chunks.records(warc_chunks.read(spark, path))
    return rows.select(F.col("id").alias("page_id"), F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                       F.col("type").alias("record_type"), "refers_to")


def op7_deficit_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drr_packing.pack(table(spark, sf_dir, "documents"), word_tokenizer()).withColumnRenamed("id", "doc_id")


def op8_pigeonhole_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_blocks.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), simhash_blocks.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op9_interval_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_tree.remove_repeats(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_ownership_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_ownership.scan(table(spark, sf_dir, "documents"), repo_col=None)
    return rows.select(F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex",
                       F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans", "n_live", "n_example")


def op11_position_crc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank", "n_words")


def op12_count_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_streams.mine(table(spark, sf_dir, "documents"))


def op13_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbit_minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4).withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (
    op1_deleted_interpolation, op2_hash_tree, op3_rule_cascade, op4_output_codes, op5_prefix_join, op6_chunked_warc,
    op7_deficit_round_robin, op8_pigeonhole_blocks, op9_interval_tree, op10_ownership_frequency,
    op11_position_crc, op12_count_streams, op13_bbit_minhash)}

# DuckDB SQL where it can express a query. It has no crc32 or xxhash64 and no tokenizer; the tests
# hold the others against brute force.
_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FOLDED_WORDS = f"regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: Kinds of op10 for RE2: no look-behind, so group 1 is what stands before a match and belongs to the text
#: between matches; group 2 is the rest of the match, group 3 the value.
_SECRETS = {
    "assign": (r"""()(([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
               r"""[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))""", 4),
    "access": (r"()((AKIA[A-Z0-9]+))", 3),
    "hex": (r"()(([0-9a-f]{32,}))", 3),
    "vcs": (r"()((gh[pousr]_[A-Za-z0-9]{36,}))", 3),
    "chat": (r"()((xox[abprs]-[A-Za-z0-9-]{10,}))", 3),
    "cloud": (r"()((AIza[A-Za-z0-9_-]{35}))", 3),
    "jwt": (r"(^|[^A-Za-z0-9_-])((eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}))", 3),
    "login": (r"()(://[^/\x20\x09-\x0D:@]{1,64}:([^/\x20\x09-\x0D:@]{3,64})@)", 3),
    "bearer": (r"()([Bb]earer\x20+([A-Za-z0-9+/_.=-]{16,}))", 3),
}
_SECRET_MATCHES = " UNION ALL ".join(
    f"SELECT doc_id, source, {number} AS kind, '{name}' AS name, string_split_regex(text, '{pattern}') AS gaps, "
    + ", ".join(f"regexp_extract_all(text, '{pattern}', {group}) AS {alias}" for group, alias in ((1, "leads"), (2, "found"), (value, "vals")))
    + f" FROM t WHERE regexp_matches(text, '{pattern}')" for number, (name, (pattern, value)) in enumerate(_SECRETS.items()))

ORACLE_SQL: dict[str, str] = {
    "op3_rule_cascade": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t) x),
many AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
inside AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM many) x GROUP BY doc_id),
f AS (SELECT t.doc_id, text, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
             len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
               - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
             coalesce(inside.n, 0) AS n_repeat_words
      FROM t LEFT JOIN inside ON t.doc_id = inside.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 10 > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR (n_dup_lines >= 3 AND n_dup_lines * 10 > 3 * len(string_split(text, chr(10))))
            OR length(regexp_replace(text, '[^A-Z]+', '', 'g')) * 2 > word_chars
            OR length(regexp_replace(text, '[^0-9]+', '', 'g')) * 10 > 3 * word_chars
            OR length(regexp_replace(text, '[^\p{L}]+', '', 'g')) * 2 < word_chars) AS kept
FROM b""",
    "op5_prefix_join": f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_FOLDED_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item, list_slice(w, i, i + 9) AS g
         FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0) x),
docs AS (SELECT doc_id, {_FOLDED_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT len(g) AS n FROM wins),
grams AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS g
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n) x),
found AS (SELECT doc_id, i, n, item FROM grams JOIN wins USING (g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) x GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item FROM found) x GROUP BY doc_id)
SELECT docs.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit ON docs.doc_id = hit.doc_id LEFT JOIN named ON docs.doc_id = named.doc_id""",
    "op6_chunked_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
o AS (SELECT page_id, html, max(page_id) OVER (PARTITION BY html) AS owner,
             CAST(CAST(unhex(sha1(html)) AS BIT) AS VARCHAR) AS bits FROM p)
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
         + 16 * CAST(substr(bits, 5 * j + 1, 1) AS INTEGER) + 8 * CAST(substr(bits, 5 * j + 2, 1) AS INTEGER)
         + 4 * CAST(substr(bits, 5 * j + 3, 1) AS INTEGER) + 2 * CAST(substr(bits, 5 * j + 4, 1) AS INTEGER)
         + CAST(substr(bits, 5 * j + 5, 1) AS INTEGER) AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM o""",
    "op10_ownership_frequency": f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
m AS ({_SECRET_MATCHES}),
e AS (SELECT doc_id, source, kind, name, i, found[i] AS hit, vals[i] AS val, length(gaps[i]) + length(leads[i]) AS gap
      FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m) x),
placed AS (SELECT *, sum(gap + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM e),
c AS (SELECT doc_id, source, kind, name, stop - length(hit) AS start, stop, val FROM placed
      WHERE length(val) >= CASE name WHEN 'assign' THEN 8 WHEN 'access' THEN 16 WHEN 'hex' THEN 32 ELSE 1 END),
o AS (SELECT val, count(DISTINCT source) <= 3 AS live FROM c GROUP BY val),
s AS (SELECT c.*, live, kind < 3 AS base, concat_ws(':', name, CAST(start AS VARCHAR), CAST(stop AS VARCHAR)) AS entry
      FROM c JOIN o ON c.val = o.val),
g AS (SELECT doc_id, count(*) FILTER (WHERE name = 'assign') AS n_assign, count(*) FILTER (WHERE name = 'access') AS n_access,
             count(*) FILTER (WHERE name = 'hex') AS n_hex,
             string_agg(entry, ',' ORDER BY start, kind, stop) FILTER (WHERE base) AS base_spans,
             string_agg(entry, ',' ORDER BY start, kind, stop) FILTER (WHERE base OR live) AS spans,
             count(DISTINCT val) FILTER (WHERE live) AS n_live, count(DISTINCT val) FILTER (WHERE NOT live) AS n_example
      FROM s GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM t LEFT JOIN g ON t.doc_id = g.doc_id""",
}
