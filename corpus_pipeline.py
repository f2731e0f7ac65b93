"""From raw documents to token ids: the stages of a training corpus, each with one operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame.  All but the last return the columns of ``documents`` (``n_chars``, where it is there, is kept
in step with the text); the last returns ``doc_id, n_tokens, ids, same`` -- ``same`` tells that the
decoded ids are the text, byte for byte.

1. language: documents without a letter go, and those with less than ``MIN_LANGUAGE`` of their letters in words that
   are labelled with a learned language; without any label all with a letter stay.  A null ``lang`` becomes the language found.
2. near duplicates: five-word shingles, similarity 0.8 or more; one document of each group stays.
3. benchmark decontamination: passages of ten words or more that a benchmark item has are cut out.
4. personal data: checked numbers, dates and names of accounts become pseudonyms of the same format.
5. byte-level BPE: encoded, and decoded as a check.

Null and empty texts have no letter and go with stage 1; extra columns pass all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.llm import bpe, decontaminate, jaccard, language, pii
from strata.llm.entries import PII_KEY, table
from strata.session import scratch_path

MIN_LANGUAGE = 0.3


def _in_step(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.reject(docs, language.fit(docs), min_score=MIN_LANGUAGE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _in_step(decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark")))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _in_step(pii.pseudonymise(docs, PII_KEY))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode(docs.withColumn("sha", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)),
                       keep=["doc_id", "sha"])
    coded = coded.select("row.*", "ids", F.size("ids").cast("long").alias("n_tokens"))
    return bpe.decode(coded).select(
        "row.doc_id", "row.n_tokens", "row.ids", (F.sha2("bytes", 256) == F.col("row.sha")).alias("same"))


STAGES = [
    ("language", by_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", without_benchmark),
    ("personal_data", pseudonyms),
    ("byte_bpe", tokens),
]

ORACLE_SQL = None        # near duplicates and pseudonyms have no SQL; the tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_path(spark, "corpus")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
