"""The stages end to end: collect, preprocess, analyse, and the labelled corpus."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.operators.answers import BATCH_SIZE, analysis_report
from broadsheet.operators.corpus import STOP_WORDS, corpus_tokens, processed_text
from broadsheet.operators.dataset import limit_articles, preprocess_articles
from broadsheet.operators.tfidf import fit_vocab, tfidf
from broadsheet.schema import article_columns
from broadsheet.sources.landing import read_landing
from broadsheet.sources.raw_json import scan_raw_articles
from broadsheet.sources.tables import (
    labelled_corpus,
    load_dataset,
    load_vocab,
    save_dataset,
    save_vocab,
    write_corpus,
    write_reports,
)
from broadsheet.streaming.collect import collect_batch


def collect(
    spark: SparkSession,
    landing: str,
    table: str,
    descriptors: DataFrame,
    newsapi_key_set: bool = True,
    after: str | None = None,
    before: str | None = None,
) -> DataFrame:
    """Everything that has landed, or in a range of time, into the daily table; returns the articles, each url once."""
    return collect_batch(read_landing(spark, landing, after, before), descriptors, table, newsapi_key_set)


def preprocess(articles: DataFrame, dataset: str) -> bool:
    """Clean articles and overwrite the dataset. One narrow stage, no shuffle."""
    return save_dataset(article_columns(articles).transform(preprocess_articles), dataset)


def preprocess_raw_files(spark: SparkSession, raw: str, dataset: str) -> bool:
    """Import daily JSON files; what cannot be read is written to ``<dataset>_rejects``."""
    articles, rejects = scan_raw_articles(spark, raw)
    rejects.write.mode("overwrite").parquet(f"{dataset.rstrip('/')}_rejects")
    return preprocess(articles, dataset)


def analyze(
    spark: SparkSession,
    dataset: str,
    reports: str,
    model_factory: Callable,
    tasks: Sequence[str] | None = None,
    limit: int | None = None,
    batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
    **options,
) -> None:
    """Run the model over the dataset, in ``partitions`` tasks if given, and append the reports."""
    articles = limit_articles(load_dataset(spark, dataset), limit)
    write_reports(analysis_report(articles, model_factory, tasks, batch_size, partitions=partitions, **options), reports)


def prepare_corpus(
    spark: SparkSession,
    csv: str,
    out: str,
    max_features: int = 5000,
    stop_words: Iterable[str] = STOP_WORDS,
    lemma: DataFrame | None = None,
    label_type: str | None = None,
    multi_line: bool = True,
) -> None:
    """Labelled CSV to tables below ``out``: tokens, cleaned CSV, vocabulary, weights.

    Rows get an id when they are first written, and every later step reads it from
    that table: ids stay the same and the text is tokenised once. ``multi_line=False``
    reads files without quoted line breaks in splits.
    """
    rows = labelled_corpus(spark, csv, label_type, multi_line).withColumn("doc_id", F.monotonically_increasing_id())
    rows.write.mode("overwrite").parquet(f"{out}/rows")
    numbered = spark.read.parquet(f"{out}/rows")
    corpus_tokens(numbered, stop_words, lemma).write.mode("overwrite").parquet(f"{out}/tokens")

    tokens = spark.read.parquet(f"{out}/tokens")
    write_corpus(tokens.select(processed_text().alias("text"), "label"), f"{out}/corpus")
    save_vocab(fit_vocab(tokens, max_features), f"{out}/vocabulary")
    tfidf(tokens, load_vocab(spark, f"{out}/vocabulary")).write.mode("overwrite").parquet(f"{out}/weights")
