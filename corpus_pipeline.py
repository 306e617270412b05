"""A training corpus in five stages, each over all that its predecessor kept.

run() applies the stages one after the other; each result is written to the shared folder and read again, so
a lost executor costs no more than the stage that runs. What a stage read is deleted once its own result stands.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import bpe, decontaminate, language, lines, ngram_join
from sieveline.session import Scratch, cut, few, read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text, or without a letter, are in no language and go; a missing language is filled in.

    The prediction rejects nothing else: its language fills a null lang, which run() returns.
    """
    found = language.predictions(docs, language.fit(docs))
    kept = found.filter(F.col("lang_pred") != language.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found on many sites go, but for the first place of each; so do documents of which nothing is left."""
    cleaned = lines.remove_widespread_lines(docs)
    kept = cleaned.filter((F.col("n_removed_lines") == 0) | (F.length(F.trim(F.regexp_replace("text", r"\s+", " "))) > 0))
    changed = F.when(F.col("n_removed_lines") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(*COLUMNS)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least doc_id.

    Of rows that share a doc_id and a text one stays; rows that share a doc_id alone stay or go together.
    Documents without a doc_id cannot be told apart, and stay.
    """
    found = ngram_join.near_copies(docs)
    copies = cut(found.filter(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct(), "near-copies")
    kept = docs.join(few(copies), "doc_id", "left_anti").select(*COLUMNS)
    again = cut(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND doc_id IS NOT NULL").select("doc_id"), "repeated-ids")
    if again.isEmpty():
        return kept
    once = kept.join(few(again), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(few(again), "doc_id", "left_anti").unionByName(once).select(*COLUMNS)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or nearly so, go."""
    return decontaminate.without_contamination(docs, read_table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left and where each token's bytes end, with their hashes and the document's language."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), carry=("lang",))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", join_near_copies),
    ("benchmark decontamination", decontaminate_benchmark),
    ("byte-level BPE", encode_tokens),
]

ORACLE_SQL = None  # a language classifier and token ids have no SQL; tests/llm holds run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    with Scratch(spark) as held:
        for n, (name, stage) in enumerate(STAGES[:-1]):
            with Scratch(spark) as own:  # what a stage cuts on its way goes once its result stands
                kept = own.keep(cut(stage(spark, docs, sf_dir), f"pipeline-{n}-{name.replace(' ', '-')}"))
            held.drop(docs)
            docs = kept
        held.keep(docs)  # the last stage is still to be computed from it
    return STAGES[-1][1](spark, docs, sf_dir)
