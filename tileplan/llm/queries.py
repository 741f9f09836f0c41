"""The operators applied to their whole tables, as registered queries."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tileplan.llm import (jaccard, langid, mixing, neighbours, packing, pages, passages, pseudonyms, repeats, rules,
                          spelling, sql, tokenfiles, tries)
from tileplan.llm.tables import mounted, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PSEUDONYM_KEY = "tileplan"  # a production job passes its own secret


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept", "quality")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn(
        "held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0)
    known = langid.profiles(docs.where(~F.col("held_out")))
    return langid.predicted(docs.drop("lang"), known)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.copies(docs.withColumn("size", mixing.words_in(F.col("text"))).drop("text"), text=None).select(
        "doc_id", "size", "source_size", "target", "taken")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = neighbours.usable(table(spark, sf_dir, "embeddings"))
    return neighbours.search(vectors, vectors.where(F.col("id") % 50 == 0))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packed(docs, TOKENIZER, end_id=2)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = mounted(spark, "tokens")
    index = tokenfiles.write_tokens(docs, folder, TOKENIZER, end_id=0)
    return tokenfiles.read_tokens(docs, folder, index)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.trie(tries.rebuilt(tries.sequences(table(spark, sf_dir, "conversations"))))


def op13_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.without_passages(table(spark, sf_dir, "documents")).drop("spans")


QUERIES = {f.__name__: f for f in (
    op1_repeats, op2_jaccard, op3_html, op4_quality_rules, op5_language, op6_mixing, op7_neighbours, op8_packing, op9_token_files,
    op10_pii, op11_spelling, op12_prefix_trie, op13_passages)}
ORACLE: dict[str, str] = dict(sql.ORACLE)
