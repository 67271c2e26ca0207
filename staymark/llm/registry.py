"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staymark.llm import (
    conversations,
    language,
    near_documents,
    near_lines,
    near_vectors,
    packing,
    quality,
    repeats,
    secrets,
    sql,
    token_files,
    url_lists,
    vector_codes,
    word_bpe,
)
from staymark.llm.byte_bpe import id_type
from staymark.llm.common import table
from staymark.sinks.locations import new_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_pack(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack(table(spark, directory, "documents"), BYTE_BPE)


def op2_language(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents")
    model = language.learn(documents.where(~language.held_out()))
    return language.identify(documents, model).withColumn("held_out", language.held_out())


def op3_near_documents(spark: SparkSession, directory: str) -> DataFrame:
    return near_documents.near_documents(table(spark, directory, "documents"))


def op4_near_vectors(spark: SparkSession, directory: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, directory, "embeddings"))


def op5_token_files(spark: SparkSession, directory: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    places = token_files.write(table(spark, directory, "documents"), folder, BYTE_BPE)
    return token_files.read_all(places, folder, id_type(50_257))


def op6_quality(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents")
    model = quality.fit(documents, table(spark, directory, "labels"))
    return quality.judge(documents, model)


def url_events(pages: DataFrame) -> DataFrame:
    """A dated list of the pages' own domains, hosts and path prefixes of every depth, with
    days and verdicts drawn from their digests."""
    url = F.col("url")
    named = F.filter(url_lists.keys(url), lambda k: F.contains(k, F.lit(".")) | F.contains(k, F.lit("/")))
    entries = pages.select(F.explode(named).alias("entry")).distinct()

    def digits(first: int):
        return F.conv(F.substring(F.md5(F.col("entry").cast("binary")), first, 4), 16, 10).cast("int")

    start = F.lit("2024-01-01").cast("date")
    drawn = entries.select("entry", digits(1).alias("a"), digits(5).alias("b"))
    added = F.date_add(start, F.floor(F.col("a") / 3).cast("int") % 200)
    removed = F.date_add(added, 30 + F.col("b") % 90)
    verdict = F.when(F.col("b") % 4 != 0, "block").otherwise("allow")
    nothing = F.lit(None).cast("string")
    first = drawn.select("entry", added.alias("day"), verdict.alias("verdict"))
    gone = drawn.where("b % 5 <> 0").select("entry", removed.alias("day"), nothing.alias("verdict"))
    again = drawn.where("b % 7 = 0").select(
        "entry", F.date_add(removed, 20).alias("day"), F.lit("block").alias("verdict")
    )
    return first.unionByName(gone).unionByName(again)


def op7_url_lists(spark: SparkSession, directory: str) -> DataFrame:
    pages = table(spark, directory, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int"))
    captures = pages.withColumn("fetched", fetched)
    return url_lists.judge(captures, url_events(pages))


def op8_secrets(spark: SparkSession, directory: str) -> DataFrame:
    return secrets.report(table(spark, directory, "documents"))


def op9_word_bpe(spark: SparkSession, directory: str) -> DataFrame:
    return word_bpe.encode_decode(table(spark, directory, "documents"), WORD_BPE)


def op10_near_lines(spark: SparkSession, directory: str) -> DataFrame:
    cleaned = near_lines.remove_repeated_lines(table(spark, directory, "documents"))
    return cleaned.select(
        "doc_id", "n_lines", "n_removed", "n_near", F.sha2("text", 256).alias("text_sha256")
    )


def op11_vector_codes(spark: SparkSession, directory: str) -> DataFrame:
    return vector_codes.compress(table(spark, directory, "embeddings"))


def op12_repeats(spark: SparkSession, directory: str) -> DataFrame:
    return repeats.report(table(spark, directory, "documents"))


def op13_conversations(spark: SparkSession, directory: str) -> DataFrame:
    given = table(spark, directory, "conversations")
    return conversations.repair(given, conversations.damage(given))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pack, op2_language, op3_near_documents, op4_near_vectors, op5_token_files, op6_quality, op7_url_lists, op8_secrets, op9_word_bpe, op10_near_lines, op11_vector_codes, op12_repeats, op13_conversations)}


def oracle_sql() -> dict[str, str]:
    return {"op7_url_lists": sql.URL_LISTS, "op8_secrets": sql.SECRETS, "op11_vector_codes": sql.VECTOR_CODES}
