"""RSS and Atom feeds, as landed XML."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.fields import truthy
from broadsheet.operators.collect import valid_articles
from broadsheet.schema import ARTICLE_COLUMNS
from broadsheet.sources.feed_reader import feed_of

_CARRIED = ["source_ord", "feed_ord"]


def _article(item):
    return F.struct(
        item["title"].alias("title"),
        truthy(item["link"], item["guid"]).alias("url"),
        truthy(item["whole"], item["short"]).alias("body"),
        truthy(item["published"], item["updated"]).alias("published_at"),
        F.coalesce(item["author"], item["creator"], F.lit("")).alias("author"),
    )


def rss_articles(payloads: DataFrame) -> DataFrame:
    """Articles of landed feeds; ``source_key`` is the feed's url.

    A feed is read once, whatever faults it has: every whole item is kept, and one without any
    yields no rows. Other feeds are left alone.
    """
    carried = [c for c in _CARRIED if c in payloads.columns]
    return (
        payloads.withColumn("feed", feed_of("value"))
        .select(
            "fetched_at",
            *carried,
            "source_key",
            F.coalesce("feed.title", "source_key").alias("source"),
            F.posexplode(F.transform("feed.items", _article)).alias("pos", "entry"),
        )
        .select(
            "fetched_at",
            *carried,
            "pos",
            "source",
            "entry.*",
            F.create_map(F.lit("feed_url"), F.col("source_key"), F.lit("provider"), F.lit("rss")).alias("metadata"),
        )
        .transform(valid_articles)
        .select(*ARTICLE_COLUMNS, *carried, "pos")
    )
