"""The registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.llm import alignment, audit, bpe, chat, decontaminate, jaccard, language, lm, pii, quality, substrings, vectors, warc
from strata.llm.oracles import ORACLE_SQL  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row")["doc_id"].alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vectors.search(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


PII_KEY = "strata corpus pseudonyms 1"       # of the registered queries; a real corpus has a secret one


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 toxic, 1 poor, 2 good; selected are documents that are good with probability 1/2 or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, 0).when(
        F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))
    found = quality.score(docs, quality.fit(docs, ratings), keep=["doc_id"])
    return found.select(F.col("row")["doc_id"].alias("doc_id"), "expected_grade",
                        F.get("tails", F.lit(0)).alias("p_ge_1"), F.get("tails", F.lit(1)).alias("p_ge_2"),
                        (F.get("tails", F.lit(1)) >= 0.5).alias("selected"))


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm.fit(docs.where(fifth() != 1))
    return lm.score(docs, model).withColumnRenamed("id", "doc_id").select(
        "doc_id", (fifth() == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), keep=["doc_id"])
    coded = coded.select(
        "ids", F.col("row")["doc_id"].alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"))
    return bpe.decode(coded, keep=["doc_id", "n_tokens", "ids_sha256"]).select(
        "row.*", F.sha2("bytes", 256).alias("decoded_sha256"))


def fifth(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_and_render(table(spark, sf_dir, "conversations")).select(
        F.col("id").alias("conv_id"), F.col("segment").cast("long").alias("segment"), "n_turns", "text")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", fifth().alias("part"))
    model = language.fit(docs.where("part != 0"))
    return language.predict(docs, model, keep=["doc_id", "part"]).select(
        F.col("row")["doc_id"].alias("doc_id"), (F.col("row")["part"] == 0).alias("held_out"),
        "lang_pred", "score")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "n_links")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    return warc.round_trip(pages).select(
        warc.page_id(F.col("record_id")).cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), warc.page_id(F.col("refers_to")).cast(kind).alias("refers_to"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(F.col("row")["doc_id"].cast("long").alias("doc_id"), "n_words", "n_removed",
                        F.sha2("text", 256).alias("kept_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.aligned_and_scored(table(spark, sf_dir, "documents"), keep=["doc_id"], digest=True)
    return found.select(F.col("row")["doc_id"].cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best",
                        "count_sum", "groups_sha256")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_neighbours": op2_neighbours,
    "op3_pseudonyms": op3_pseudonyms,
    "op4_quality": op4_quality,
    "op5_pitman_yor": op5_pitman_yor,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_chat_format": op7_chat_format,
    "op8_language": op8_language,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_warc": op10_warc,
    "op11_filter_audit": op11_filter_audit,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_token_alignment": op13_token_alignment,
}
