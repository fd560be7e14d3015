"""Headline responses of the REST source, as landed JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.fields import json_field, truthy
from broadsheet.operators.collect import valid_articles
from broadsheet.schema import ARTICLE_COLUMNS
from broadsheet.sources.descriptors import MAX_PAGE_SIZE

_ENVELOPE = "status string, articles array<variant>"
_CARRIED = ["source_ord", "feed_ord"]


def page_capped(items: DataFrame, page_size: Column | int = 50) -> DataFrame:
    """The first ``page_size`` items of each response, never more than 100."""
    size = page_size if isinstance(page_size, Column) else F.lit(page_size)
    return items.filter(F.col("pos") < F.least(size, F.lit(MAX_PAGE_SIZE)))


def payload_items(payloads: DataFrame) -> DataFrame:
    """One row per item of every response whose status is ok."""
    return (
        payloads.withColumn("envelope", F.from_json("value", _ENVELOPE))
        .filter(F.col("envelope.status") == "ok")
        .select(*[c for c in payloads.columns if c != "value"], F.posexplode("envelope.articles").alias("pos", "item"))
    )


def newsapi_articles(payloads: DataFrame, page_size: Column | int | None = None) -> DataFrame:
    """Articles of landed responses; ``source_key`` is the request's category.

    The page size belongs to the request: what a response holds is taken whole,
    unless a caller gives ``page_size`` here.
    """
    item = F.col("item")
    origin = F.try_variant_get(item, "$.source", "variant")
    fields = {
        "title": json_field(item, "title", ""),
        "body": truthy(json_field(item, "content", ""), json_field(item, "description", "")),
        "url": json_field(item, "url", ""),
        # no source at all, or a null one, is unknown like one without a name
        "source": F.when(F.is_variant_null(origin), "unknown").otherwise(json_field(item, "source.name", "unknown")),
        "published_at": json_field(item, "publishedAt", ""),
        "author": json_field(item, "author", ""),
        "metadata": F.create_map(
            F.lit("category"), F.col("source_key"), F.lit("provider"), F.lit("newsapi")
        ),
    }
    carried = [c for c in _CARRIED if c in payloads.columns]
    items = payload_items(payloads)
    if page_size is not None:
        items = page_capped(items, page_size)
    articles = items.select("fetched_at", *carried, "pos", *[c.alias(name) for name, c in fields.items()])
    return valid_articles(articles.select(*ARTICLE_COLUMNS, *carried, "pos"))
