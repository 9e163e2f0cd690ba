"""The training-corpus pipeline: documents in, packed token sequences out.

Five stages, each an operator of ``starpipe.llm`` applied to all that the
stage before it kept. Each result is written as Parquet to the session's
shared folder and read again for the next stage, so a lost executor costs
part of one stage only.

1. ``language_id``: learns from the labelled documents and drops those without
   a language: no letters, or two codewords too close to tell.
2. ``near_duplicates``: keeps one document of each SimHash group, the one with
   the smallest id (of equal ids, one; null ids last).
3. ``decontaminate``: drops documents that hold a window of a benchmark item.
4. ``secret_scan``: drops documents that hold a live-looking credential.
5. ``packing``: packs the rest into windows of 2048 tokens.

Defined cases: a null or empty text has no letters and goes in stage 1;
repeated rows are near duplicates of each other; an empty table stays empty
through every stage; extra columns stay up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.llm import drr_packing, ecoc_langid, prefix_decontam, secret_ownership, simhash_blocks
from starpipe.llm.common import fresh
from starpipe.llm.queries import word_tokenizer
from starpipe.sources.io import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = ecoc_langid.fit(docs)
    names = tuple(fresh(docs, n) for n in ("lang_pred", "lang_score", "ambiguous"))
    return (ecoc_langid.predict(docs, model, names=names)
            .where((F.col(names[0]) != "und") & ~F.col(names[2])).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    fp, row = fresh(docs, "fp"), fresh(docs, "row")
    # Row numbers are fixed once they are written.
    rows = materialize(simhash_blocks.with_fingerprint(docs, "text", fp).withColumn(row, F.monotonically_increasing_id()),
                       "fingerprinted")
    narrow = rows.select(F.col("doc_id").alias("id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    first = (narrow.join(simhash_blocks.classes(narrow.select("fp").distinct()), "fp")
             .groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("keep")))
    return rows.join(first.select(F.col("keep.row").alias(row)), row, "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = tuple(fresh(docs, n) for n in ("n_words", "hit_spans", "items"))
    found = prefix_decontam.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), names=names)
    return found.where(F.size(names[1]) == 0).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_ownership.drop_live(docs, repo_col=None)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drr_packing.pack(docs, word_tokenizer()).withColumnRenamed("id", "doc_id")


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("secret_scan", secret_scan), ("packing", packing)]

#: Language models, fingerprints and tokenizers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
