"""Queries over whole tables, one per operator, and SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import bpe, chat, decontaminate, language, lines, neighbours, ngram_join, periodic_runs, pii, ranked_search, sharding, token_files, warc
from sieveline.session import read_table


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_files.token_output(docs, public_tokenizers.path("word_bpe_49k.json"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pii.find_pii(docs)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return ngram_join.near_copies(docs)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = language.predictions(docs.select("doc_id", "text"), language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lines.remove_widespread_lines(docs).select("doc_id", "text", "n_lines", "n_removed_lines")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return sharding.place(docs.select("doc_id", "source"), "doc_id")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), keep_ids=False)


def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return chat.format_preferences(chat.random_negatives(chat.turns_of(conversations)))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.digests(periodic_runs.find_runs(periodic_runs.plant_repeats(docs)))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(read_table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_pii": op2_pii,
    "op3_decontamination": op3_decontamination,
    "op4_ngram_join": op4_ngram_join,
    "op5_language": op5_language,
    "op6_line_dedup": op6_line_dedup,
    "op7_sharding": op7_sharding,
    "op8_neighbours": op8_neighbours,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_preferences": op10_preferences,
    "op11_ranked_search": op11_ranked_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_warc": op13_warc,
}
ORACLES = {
    "op6_line_dedup": lines.ORACLE,
    "op7_sharding": sharding.oracle(),
    "op10_preferences": chat.ORACLE,
    "op11_ranked_search": ranked_search.ORACLE,
    "op13_warc": warc.ORACLE,
}
