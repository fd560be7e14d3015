"""Incremental collecting: new payload files into the daily table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet.operators.collect import batch_days, collect_union, dedup_url, merge_daily
from broadsheet.session import shared_dir
from broadsheet.sources.descriptors import enabled_sources
from broadsheet.sources.feeds import rss_articles
from broadsheet.sources.landing import stream_landing
from broadsheet.sources.newsapi import newsapi_articles


def payload_articles(payloads: DataFrame, descriptors: DataFrame, newsapi_key_set: bool = True) -> DataFrame:
    """Articles of all enabled payloads, each with its place in the fetch order."""
    used = enabled_sources(payloads, descriptors, newsapi_key_set)
    return collect_union(
        newsapi_articles(used.filter(F.col("source_type") == "newsapi")),
        rss_articles(used.filter(F.col("source_type") == "rss")),
    )


def collect_batch(payloads: DataFrame, descriptors: DataFrame, table: str, newsapi_key_set: bool = True) -> DataFrame:
    """One round of collecting: payloads to articles, merged into the daily table.

    Returns the round's articles, each url once; the frame is not computed yet.
    """
    articles = payload_articles(payloads, descriptors, newsapi_key_set)
    merge_daily(articles, table, batch_days(payloads))
    return dedup_url(articles)


def start_collect(
    spark: SparkSession,
    landing: str,
    table: str,
    descriptors: DataFrame,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    newsapi_key_set: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Collect whatever lands. ``trigger`` is ``writeStream.trigger``'s argument, hourly by default.

    A round that is replayed after a failure adds nothing twice, because the merge
    leaves out urls the day already has.
    """

    def collect(batch: DataFrame, _: int) -> None:
        collect_batch(batch, descriptors, table, newsapi_key_set)

    return (
        stream_landing(spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(collect)
        .option("checkpointLocation", checkpoint or shared_dir(spark, "collect"))
        .trigger(**(trigger or {"processingTime": "1 hour"}))
        .start()
    )
