"""From raw documents to packed sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All
but the last return the columns of documents; whoever runs them may store each stage's
rows and read them again. Nulls, empty tables and repeated rows are handled as the
operators say; other columns of ``docs`` pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import decontam, langid, packing, secret_scan, simhash
from broadsheet.llm.common import fresh, table
from broadsheet.llm.queries import taught, tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts that no learned language can code."""
    (found,) = fresh(docs, "found")
    marked = langid.judge_languages(docs, taught(docs), found)
    return marked.filter(~F.col(f"{found}.rejected")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of every SimHash component."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a word inside an occurrence of a benchmark window."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret and keeps ``n_chars`` true; no row goes."""
    masked = secret_scan.mask_secrets(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of what is left, each a sequence of a power of two."""
    return packing.pack_power_of_two(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packed),
]

# Code lengths, XXH64 and BPE ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
