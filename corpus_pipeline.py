"""A corpus pipeline: stages over ``documents``, each by one operator of ``nightgrid.llm``.

Every stage works on all rows that the one before kept.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from nightgrid.llm.bpe import encode_documents
from nightgrid.llm.common import table, written
from nightgrid.llm.decontamination import find_contamination
from nightgrid.llm.language_id import identify, learn_outside_fold
from nightgrid.llm.pii import find_pii
from nightgrid.llm.simhash import similar_documents
from nightgrid.packaging import ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are null, have no letter, or whose language is not clear."""
    ship_package(spark)
    found = identify(docs, learn_outside_fold(docs))
    return found.where(~F.col("rejected")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of similar texts the row with the smallest doc_id, null ids last.

    Rows are told apart by id and text, so rows that share an id but not a text are
    judged each by itself, and rows equal in both leave one.
    """
    ship_package(spark)
    marked = docs.withColumn("__llm_hash", F.xxhash64("text"))
    place = F.struct(F.isnull("doc_id").alias("unknown"), "doc_id", "__llm_hash")
    grouped = similar_documents(marked.select(place.alias("__llm_row"), "text"), key="__llm_row")
    firsts = grouped.where(F.col("__llm_row").eqNullSafe(F.col("component_id"))).select(
        F.col("__llm_row.__llm_hash").alias("__llm_first"), F.col("__llm_row.doc_id").alias("__llm_id")
    ).distinct()
    same = (F.col("__llm_hash") == F.col("__llm_first")) & F.col("doc_id").eqNullSafe(F.col("__llm_id"))
    return marked.join(firsts, same, "left_semi").dropDuplicates(["__llm_hash", "doc_id"]).select(COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten words running of a benchmark item, or a whole short one."""
    ship_package(spark)
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.col("n_hit") == 0).select(COLUMNS)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; ``n_chars`` follows the new text."""
    ship_package(spark)
    found = find_pii(docs.drop("redacted"), redact=True)
    return found.select(
        "doc_id", F.col("redacted").alias("text"), "lang", "source",
        F.length("redacted").cast(docs.schema["n_chars"].dataType).alias("n_chars"),
    )


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids, checked by decoding: ids of texts that come back unchanged."""
    ship_package(spark)
    found = encode_documents(docs)
    sound = F.when(F.col("decoded") == F.col("text"), F.col("token_ids")).otherwise(
        F.raise_error(F.concat(F.lit("ids do not decode to the text of document "), F.col("doc_id").cast("string")))
    )
    return found.select("doc_id", "lang", "source", "n_chars", "n_tokens", sound.alias("token_ids"), "ids_sha256")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("bpe", encode_tokens),
]

#: Compression, fingerprints, trained trees and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written and read again."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
