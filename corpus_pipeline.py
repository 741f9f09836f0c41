"""From documents to packed training sequences: five stages, each written and read again by the next.

Quality rules reject documents, the Jaccard join leaves one document of each group of near copies, personal data become
pseudonyms, sources are mixed to their weights (a document taken twice is there twice), and the pieces of all documents
are packed. Every stage works on all its predecessor kept and passes on the columns of documents, whatever they are
called; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tileplan.llm import jaccard, mixing, packing, pseudonyms, rules
from tileplan.llm.queries import PSEUDONYM_KEY, TOKENIZER
from tileplan.llm.tables import table, written

NEEDED = ("doc_id", "text", "source")


def aside(docs: DataFrame) -> DataFrame:
    """The columns that stages read, and all others in one, so that no name of theirs can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in NEEDED]
    return docs.select(*NEEDED, (F.struct(*rest) if rest else F.lit(None).cast("string")).alias("_rest"))


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c) if c in NEEDED else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return restored(rules.quality(aside(docs)).where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component stays; repeated rows stay once; rows without an id stay."""
    found = jaccard.join(docs)
    kept = written(found.where("doc_id = component_id").select("doc_id").distinct(), "kept")
    named = docs.join(kept, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return named.union(docs.where("doc_id IS NULL"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    changed = pseudonyms.pseudonymised(aside(docs), PSEUDONYM_KEY)
    out = restored(changed, docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = mixing.copies(aside(docs)).where("copies > 0")
    return restored(taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, TOKENIZER, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("mixing", mixed),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None  # posteriors, Newton's steps and byte-level tokens are not SQL; the tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
