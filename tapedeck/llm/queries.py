"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapedeck.llm import ann, chat, chat_repair, filter_audit, html_text, langid, license_scan, packing, pieces, pii, quality, secret_scan, simhash
from tapedeck.llm.common import Workspace, table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), Workspace(spark))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.fit(license_scan.plain_paragraphs(docs)), Workspace(spark))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), Workspace(spark))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return chat.parse(chat.as_transcript(turns), chat.learn(turns), Workspace(spark))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"), Workspace(spark))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, Workspace(spark))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_rules(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Workspace(spark))


def op12_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair_damaged(table(spark, sf_dir, "conversations"), Workspace(spark))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.learn(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_licenses, op3_language, op4_sentencepiece, op5_packing,
        op6_chat, op7_main_text, op8_secrets, op9_neighbours, op10_quality,
        op11_filter_audit, op12_chat_repair, op13_personal_data,
    )
}

#: The other operators' methods can't be said in SQL; tests hold them against brute force.
ORACLES: dict[str, str] = {"op11_filter_audit": filter_audit.SQL, "op12_chat_repair": chat_repair.SQL}
