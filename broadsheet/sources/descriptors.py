"""Which sources are switched on, and which payloads belong to them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DESCRIPTOR_SCHEMA = (
    "source_ord int, type string, enabled boolean, categories array<string>, "
    "country string, page_size int, feeds array<string>"
)

# What a descriptor says when it does not say.
DEFAULTS = {
    "type": "newsapi",
    "enabled": True,
    "categories": ["technology", "business"],
    "country": "us",
    "page_size": 50,
    "feeds": [],
}
MAX_PAGE_SIZE = 100


def descriptor_frame(spark: SparkSession, descriptors: Iterable[Mapping]) -> DataFrame:
    """Source descriptors as a table; the list position is the source order."""
    names = list(DEFAULTS)
    rows = [
        (ord_, *[given.get(name, DEFAULTS[name]) for name in names]) for ord_, given in enumerate(descriptors)
    ]
    return spark.createDataFrame(rows, DESCRIPTOR_SCHEMA)


def source_keys(descriptors: DataFrame, newsapi_key_set: bool = True) -> DataFrame:
    """One row per category or feed of every usable source, in fetch order."""
    usable = F.col("enabled") & ((F.col("type") == "rss") | ((F.col("type") == "newsapi") & F.lit(newsapi_key_set)))
    default_categories = F.array(*[F.lit(c) for c in DEFAULTS["categories"]])
    categories = F.when(F.size("categories") > 0, F.col("categories")).otherwise(default_categories)
    keys = F.when(F.col("type") == "newsapi", categories).otherwise(F.col("feeds"))
    return descriptors.filter(usable).select(
        F.col("type").alias("source_type"),
        "source_ord",
        F.least("page_size", F.lit(MAX_PAGE_SIZE)).alias("page_size"),
        F.posexplode(keys).alias("feed_ord", "source_key"),
    )


def enabled_sources(payloads: DataFrame, descriptors: DataFrame, newsapi_key_set: bool = True) -> DataFrame:
    """Payloads of the enabled sources, with their place in the fetch order.

    Disabled sources, unknown types and the REST source without a key drop out.
    """
    return payloads.join(source_keys(descriptors, newsapi_key_set), ["source_type", "source_key"])
