"""From raw documents to packed training sequences, in stages.

Each stage gets the documents that the one before it kept, as written and read again, and
its decisions take effect. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staymark.llm import language, near_documents, near_lines, packing, secrets
from staymark.llm.common import carried, table, uncarried
from staymark.session import shuffles_deleted, small_batches, try_out
from staymark.sinks.locations import delete_folder, new_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# Learning, line and component searches and the packing plan are not SQL.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told go on; null and letterless texts do not."""
    small_batches(try_out(spark))
    return language.identified(docs, language.learn(docs))


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents of which nothing else is left."""
    small_batches(try_out(spark))
    cleaned = near_lines.remove_repeated_lines(carried(docs))
    some = cleaned.where("n_removed = 0 OR n_removed < n_lines")
    columns = uncarried(docs.columns)
    shorter = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long"))
    columns["n_chars"] = F.coalesce(shorter, columns["n_chars"])
    return some.select(*[c.alias(name) for name, c in columns.items()])


def remove_near_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest doc_id.

    Rows of equal doc_id and text are one document. Rows without doc_id cannot be told
    apart by it and stay.
    """
    small_batches(try_out(spark))
    found = near_documents.near_documents(docs).where("kept AND doc_id IS NOT NULL")
    staying = found.select("doc_id").distinct()
    named = docs.join(staying, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; every document stays."""
    small_batches(try_out(spark))
    redacted = secrets.redact(carried(docs))
    columns = uncarried(docs.columns)
    columns["n_chars"] = F.coalesce(F.char_length("text").cast("long"), columns["n_chars"])
    return redacted.select(*[c.alias(name) for name, c in columns.items()])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as token sequences: a row for each piece with its place."""
    small_batches(try_out(spark))
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language", identify_language),
    ("lines", remove_lines),
    ("near_documents", remove_near_documents),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``.

    A stage's table is deleted once the next one is written, its shuffles once it is written.
    """
    try_out(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        made = stage(spark, docs, sf_dir)
        with shuffles_deleted(spark):
            made.write.parquet(path)
        if before is not None:
            delete_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
