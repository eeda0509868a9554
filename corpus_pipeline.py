"""Pipeline over documents: stages applied in order, each reading what the one before wrote.

Every stage reads the columns of documents and drops others. Null texts are rejected by the
first stage; later ones pass them on as they are, as they do rows without an id. Repeated rows
are copies, of which the second stage keeps one. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm import byte_bpe, decontaminate, language_id, near_dups, pii
from tidemark.session import written


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter are rejected; a missing ``lang`` is filled in."""
    docs = docs.select(*COLUMNS)
    found = language_id.identify(docs, language_id.fit(docs)).where(F.col("lang_pred") != language_id.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dups.one_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def decontamination(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified test item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.annotate(docs.select(*COLUMNS), items).where(F.size("leaks") == 0).select(*COLUMNS)


def personal_data(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by their kind; ``n_chars`` follows the text."""
    redacted = pii.redact(docs.select(*COLUMNS), pii.fit(docs))
    kind = docs.schema["n_chars"].dataType
    return redacted.withColumn("n_chars", F.length("text").cast(kind)).select(*COLUMNS)


def tokens(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their ids (packed little-endian, 32 bits) and the text decoded from these."""
    coded = byte_bpe.round_trip(docs.select(*COLUMNS))
    return coded.select(
        "doc_id", F.col("decoded").cast("string").alias("text"), "lang", "source", "n_chars",
        F.expr("bigint(length(ids) / 4)").alias("n_tokens"), "ids",
    )


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("byte-level BPE", tokens),
]

# The stages hold learned models, similarity classes and byte-level merges: no SQL says them.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage's rows are written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = written(docs, f"stage-{place}-{name.replace(' ', '-')}")
    return docs
