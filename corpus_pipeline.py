"""From raw documents to packed sequences: five stages, each writing what the next one reads.

Language and quality reject documents, near duplicates keep one document of each group, secrets are replaced in
the texts, and what is left is packed. A stage takes (spark, docs, sf_dir); all but the last return the
columns of documents. Rows with a null doc_id pass like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapedeck.llm import langid, packing, quality, secret_scan, simhash
from tapedeck.llm.common import Workspace, table


#: A prediction at least as sure as this rejects a document whose label names another language.
SURE = 0.9


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter, hence no language, and those in surely another language than their label says."""
    samples = langid.learn(table(spark, sf_dir, "documents"))
    told = docs.withColumn("__told", langid.language_column(F.col("text"), samples))
    mistaken = (F.col("lang") != F.col("__told.lang_pred")) & (F.col("__told.score") >= SURE)
    return told.where((F.col("__told.lang_pred") != langid.UNKNOWN) & ~F.coalesce(mistaken, F.lit(False))).select(*docs.columns)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules don't keep go."""
    trees = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.withColumn("__judged", quality.judged(F.col("text"), trees)).where("__judged.kept").select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: the smallest doc_id (nulls last), of rows that share it the smallest digest of the text."""
    return simhash.one_of_each(docs, Workspace(spark))


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a mark; n_chars follows the text."""
    kept, steps = secret_scan.scanned(docs, Workspace(spark))
    out = kept.withColumn("text", secret_scan.redacted(F.col("text"), F.col("__scan"), steps))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), Workspace(spark))


STAGES = [
    ("language_id", keep_known_languages),
    ("quality_rules", keep_good_quality),
    ("near_duplicates", keep_one_of_each_group),
    ("secrets", replace_secrets),
    ("packing", pack_sequences),
]

#: Trained models decide in most stages, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, work = table(spark, sf_dir, "documents"), Workspace(spark)
    for _, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
