import pytest

SF = "/root/testdata/sf0.001"

#: Columns that operators use inside, or return, under other meanings.
CLASH = ("id", "fp", "th", "spans", "items", "n_words", "score", "label", "row", "block", "__fp", "__f", "part", "value", "N_Words")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs or with lang and source, plus clashing columns."""
    def make(rows):
        full = [(*r, *("en", "src0")[len(r) - 2:]) for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        seen = {"doc_id", "text", "lang", "source"}
        for c in CLASH:
            if c.lower() not in seen:
                seen.add(c.lower())
                from pyspark.sql import functions as F
                df = df.withColumn(c, F.lit("clash"))
        return df
    return make
