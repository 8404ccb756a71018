"""A corpus pipeline of five operators: language ID, line dedup, near-duplicate join, source mixing, BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` applies them to `documents`, each
one's rows written as Parquet and read again for the next. All but the last return the columns of their input.

Nulls, empty and repeated rows: a null or letterless text is rejected by the first stage, so later stages
see texts only; a document whose lines are all dropped goes (one instance of each line stays elsewhere);
rows that repeat an id are one document for the near-duplicate stage, which keeps or drops all its texts
(one row of each) and every row without an id; a document that the mix takes
twice is two equal rows. Extra columns are carried along; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.bpe import bpe_encode_decode
from ledgerline.llm.common import crc32_mod, scratch, stored, table
from ledgerline.llm.jaccard import ngram_jaccard_join
from ledgerline.llm.langid import identify_languages, train
from ledgerline.llm.linededup import dedup_lines
from ledgerline.llm.mixing import mix_sources
from ledgerline.llm.queries import vocabulary_path
from ledgerline.operators.joins import join_bounded

#: A document is rejected if no language has at least this share of it.
MIN_SHARE = 0.4


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those that no learned language makes up a fair share of."""
    with scratch(docs.sparkSession):
        model = train(docs.where(crc32_mod(F.col("doc_id"), 4) != 2), "doc_id", "text", "lang")
        keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("digest")).alias("key"), "text")
        found = identify_languages(keyed, model, "key", "text")
        bad = stored(found.where((F.col("lang_pred") == "und") | (F.col("score") < MIN_SHARE)).select("id.*").distinct(), "rejected", keep=True)
    bad = bad.select(F.col("doc_id").alias("_ll_id"), F.col("digest").alias("_ll_digest"))
    return join_bounded(docs, bad, docs["doc_id"].eqNullSafe(bad["_ll_id"]) & (F.xxhash64(docs["text"]) == bad["_ll_digest"]), "left_anti")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines; a document that has nothing left goes."""
    kept = dedup_lines(docs)
    return kept.where((F.col("_ll_dropped") == 0) | (F.col("text") != "")).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest document of each group of near copies."""
    with scratch(docs.sparkSession):
        groups = ngram_jaccard_join(docs).documents()
        gone = stored(groups.where("id <> comp").select(F.col("id").alias("_ll_id")).distinct(), "near_copies", keep=True)
        single = groups.groupBy("id").count().where("count > 1").isEmpty()
    kept = join_bounded(docs, gone, docs["doc_id"] == gone["_ll_id"], "left_anti")
    if single:
        return kept
    # rows without an id took no part; texts of one id that differ all stay
    known = kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    return known.unionAll(kept.where("doc_id is null"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats every document as often as the mix takes it (0, 1 or 2 times)."""
    with scratch(docs.sparkSession):
        mixed = mix_sources(docs)
        times = mixed.groupBy("id", "digest", "source").agg(F.sum("copies").alias("_ll_times"), F.count(F.lit(1)).alias("_ll_rows"))
        times = stored(times.withColumnsRenamed({"id": "_ll_id", "digest": "_ll_digest", "source": "_ll_source"}), "times", keep=True)
    single = times.where("_ll_rows > 1").isEmpty()
    rows = docs if single else docs.dropDuplicates(["doc_id", "text", "source"])
    on = rows["doc_id"].eqNullSafe(times["_ll_id"]) & (F.xxhash64(rows["text"]) == times["_ll_digest"]) & rows["source"].eqNullSafe(times["_ll_source"])
    taken = join_bounded(rows, times.where("_ll_times > 0"), on)
    repeated = taken.withColumn("_ll_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_ll_times"))))
    return repeated.select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of ids and decoded text."""
    return bpe_encode_decode(docs, vocabulary_path(), full=True).drop("decoded").withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("source_mixing", mixing_stage),
    ("bpe", token_stage),
]

#: Expectation-maximisation, Newton's iterations and BPE are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
