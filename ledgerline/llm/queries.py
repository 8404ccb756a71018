"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .balltree import top_k
from .bpe import bpe_encode_decode
from .chat import digest_conversations, format_conversations
from .common import crc32_mod, table
from .covertree import near_duplicates
from .jaccard import ngram_jaccard_join
from .langid import identify_languages, train as train_langid
from .linededup import dedup_lines
from .mixing import mix_sources
from .secrets import digest_columns, scan_secrets
from .spelling import group_variants
from .toxicity import learn as learn_toxicity, score_texts
from .urls import Rule, filter_urls
from .vectorcode import compress


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_jaccard_join(table(spark, sf_dir, "documents"))
    return joined.documents().select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"), "class_id", "n_links")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("comp").alias("component_id"), F.coalesce(F.col("id") == F.col("comp"), F.lit(True)).alias("kept"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).cast("long").alias("taken")
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken, "rate", "copies")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc32_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    known = labels.where(~held_out & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    net = learn_toxicity(docs.select("doc_id", "text").join(known, "doc_id"))
    scored = score_texts(docs, net).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(scan_secrets(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def vocabulary_path() -> str:
    """The public vocabulary that the contract of op5 names, in its installed place."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op5_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode_decode(table(spark, sf_dir, "documents"), vocabulary_path()).withColumnRenamed("id", "doc_id")


#: Fixed rules of the contract of op7.
RULES = [Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"), Rule("allow", "com/fr/"), Rule("block", "com/de/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), RULES).withColumnRenamed("id", "page_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_langid(docs.where(crc32_mod(F.col("doc_id"), 4) != 2), "doc_id", "text", "lang")
    found = identify_languages(docs, model)
    held_out = F.coalesce(crc32_mod(F.col("id"), 4) == 2, F.lit(False))
    return found.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score", "mixture")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = F.when(F.col("text").isNull() | (F.col("text") == ""), 0).otherwise(F.size(F.split("text", "\n")))
    return kept.select("doc_id", n.cast("long").alias("n_kept"), F.col("_ll_dropped").cast("long").alias("n_dropped"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op11_vector_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = compress(table(spark, sf_dir, "embeddings"))
    rows = coded.with_label_errors().withColumnRenamed("id", "vec_id")
    return rows.select("vec_id", "code", "error", "label_error", F.lit(coded.codebooks_sha256()).alias("codebooks_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents"))


#: Fixed rows of the contract of op13: a conversation whose texts hold control strings.
PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    return digest_conversations(format_conversations(given.unionByName(planted)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_toxicity": op3_toxicity,
    "op4_secret_scan": op4_secret_scan,
    "op5_bpe_encode_decode": op5_bpe_encode_decode,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_url_filter": op7_url_filter,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_vector_code": op11_vector_code,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_chat_format": op13_chat_format,
}
